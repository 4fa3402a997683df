"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import drop, numbered, running_totals, shared_dir, working, written

__all__ = [
    "UPPER", "WORD", "ascii_lower", "drop", "fresh", "numbered", "running_totals", "shared_dir", "slices", "table", "utf8", "working", "written",
]

#: White space that separates words in every operator here: U+0020 and U+0009 to U+000D.
WORD = "[^\\x20\\x09-\\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """Lower-cases A-Z alone, whatever the locale."""
    return F.translate(c, UPPER, UPPER.lower())


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Each name, with underscores put before it until df has no such column."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def utf8(column: pa.Array | pa.ChunkedArray) -> list[bytes | None]:
    """A string column as UTF-8 bytes, without decoding."""
    return column.cast(pa.binary()).to_pylist()


def slices(batch: pa.RecordBatch, column: str, most_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in parts whose texts hold at most most_bytes (or one row), to bound what Python objects take."""
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for k, n in enumerate(size):
        if k > start and held + n > most_bytes:
            yield batch.slice(start, k - start)
            start, held = k, 0
        held += n
    if start < batch.num_rows:
        yield batch.slice(start)
