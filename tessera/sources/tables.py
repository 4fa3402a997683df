"""Checkpoints, per-clip scores, metadata files and published generations."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import index_of


def resolved(path: str, root: str, is_input: bool = False) -> str:
    """Where a path of a setting leads: absolute ones and those with a scheme stay, others lie under root, or its inputs."""
    if path.startswith("/") or "://" in path:
        return path
    return "/".join([root.rstrip("/"), *(["inputs"] if is_input else []), path])


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A Parquet table, or an empty one where there is none yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_scores(spark: SparkSession, path: str) -> DataFrame:
    """(idx, per, per_pitch, ref_phonemes, hyp_phonemes) from pipe-separated files with a header.

    Rows whose idx is no number are left out. Empty scores are 0; one that can't be read makes both 0. Of several rows
    of an idx, the last by file and place in it counts.
    """
    columns = "idx string, per string, per_pitch string, ref_phonemes string, hyp_phonemes string"
    rows = spark.read.csv(path, sep="|", header=True, schema=columns).withColumns(
        {"file_": F.col("_metadata.file_path"), "block_": F.col("_metadata.file_block_start"), "at_": F.monotonically_increasing_id()}
    )
    return clean_scores(rows, ["file_", "block_", "at_"])


def clean_scores(rows: DataFrame, order: list[str]) -> DataFrame:
    number = lambda c: F.when(F.coalesce(F.trim(c), F.lit("")) == "", 0.0).otherwise(F.col(c).try_cast("double"))
    good = number("per").isNotNull() & number("per_pitch").isNotNull()
    made = rows.withColumn("idx", F.trim("idx").try_cast("int")).filter("idx IS NOT NULL")
    made = made.withColumns({c: F.when(good, number(c)).otherwise(0.0) for c in ("per", "per_pitch")})
    last = F.struct(*order)
    names = ["per", "per_pitch", "ref_phonemes", "hyp_phonemes"]
    return made.groupBy("idx").agg(F.max_by(F.struct(*names), last).alias("r")).select("idx", "r.*")


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """(idx, path, text) from pipe-separated metadata without a header; raises on a row that isn't two fields, or whose
    file name is no number."""
    rows = spark.read.csv(path, sep="|", quote='"', escape='"', schema="path string, text string", mode="FAILFAST")
    idx = index_of(F.col("path"))
    checked = F.when(idx.isNotNull(), idx).otherwise(F.raise_error(F.concat(F.lit("no clip: "), "path")).cast("int"))
    return rows.select(checked.alias("idx"), "path", "text")


def next_generation(names: DataFrame, name: str = "name") -> DataFrame:
    """One row: the number after the largest of names like gen7 or gen012; 1 where there is none."""
    number = F.regexp_extract(name, "^gen([0-9]+)$", 1).try_cast("int")
    return names.agg((F.coalesce(F.max(number), F.lit(0)) + 1).alias("next_gen"))


def generations(names: DataFrame, name: str = "name") -> DataFrame:
    """(gen, name) of three-digit generations, the ones that archives are merged from."""
    number = F.regexp_extract(name, "^gen([0-9]{3})$", 1).try_cast("int")
    return names.select(number.alias("gen"), F.col(name)).filter("gen IS NOT NULL")


def latest(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row of each key that comes last in order; a key of very many rows is reduced before it is shuffled."""
    rest = [c for c in rows.columns if c not in keys]
    last = F.max_by(F.struct(*rest), F.struct(*order)).alias("row_")
    return rows.groupBy(*keys).agg(last).select(*keys, "row_.*").select(*rows.columns)
