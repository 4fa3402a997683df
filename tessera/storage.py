"""Intermediate tables in the folder that driver and executors share, and global numbering."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager, suppress
from contextvars import ContextVar
from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Folders made here because the session named none: by application.
_own: dict[str, str] = {}
#: Where written tables are.
_paths: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()
#: The tables of the innermost working() block of this thread, and of those around it.
_working: ContextVar[tuple[list[str], ...]] = ContextVar("working", default=())


def shared_dir(spark: SparkSession) -> str:
    """This application's folder in that which spark.checkpoint.dir names. A local session without one gets a folder of
    its own; elsewhere that would be on one machine alone, so it raises."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir() or _own.get(sc.applicationId)
    if named is None:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir has to name a folder that driver and executors share")
        named = _own[sc.applicationId] = tempfile.mkdtemp(prefix="tessera-")
    path = f"{named.rstrip('/')}/tessera-{sc.applicationId}"
    if path not in _known:
        _known.add(path)
        atexit.register(_left, spark)
    return path


_known: set[str] = set()


def _left(spark: SparkSession) -> None:
    with suppress(Exception):  # the session may have ended
        clear(spark)


def _remove(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def clear(spark: SparkSession) -> None:
    """Removes all tables that this application wrote here. Results not read yet are lost with them."""
    _remove(spark, shared_dir(spark))


def drop(df: DataFrame) -> None:
    """Removes the table that df, as written() gave it, reads."""
    if path := _paths.pop(df, None):
        _remove(df.sparkSession, path)


def written(df: DataFrame, name: str) -> DataFrame:
    """Writes df as Parquet to the shared folder and reads it back: lineage ends here and each row is computed once.

    The table stays until drop() or clear(), the end of the working() block around it, or of the application.
    """
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    if blocks := _working.get():
        blocks[-1].append(path)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    _paths[out] = path
    return out


@contextmanager
def working(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Tables written within are removed at its end, but those written by the function that it gives (like written)."""
    blocks = _working.get()
    mine: list[str] = []
    token = _working.set((*blocks, mine))

    def keep(df: DataFrame, name: str) -> DataFrame:
        inner = _working.set(blocks)
        try:
            return written(df, name)
        finally:
            _working.reset(inner)

    try:
        yield keep
    finally:
        _working.reset(token)
        for path in mine:
            _remove(spark, path)


def running_totals(df: DataFrame, order: list[str], values: dict[str, Column]) -> DataFrame:
    """df with, for each name, the sum of its value over all rows before each one, in the total order of the given columns.

    No window over the whole table: rows are range-partitioned, partitions are summed, and each partition starts from
    the sums of those before it. Only one row per partition is ever brought together. The order has to be total.
    """
    kinds = {f.name: f.dataType for f in df.schema.fields}
    ranged = df.repartitionByRange(*order) if df.columns else df
    ranged = ranged.withColumn("part_", F.spark_partition_id()).withColumns({f"value_{n}": v for n, v in values.items()})
    ranged = written(ranged, "ranged")
    sums = ranged.groupBy("part_").agg(*(F.sum(f"value_{n}").alias(f"sum_{n}") for n in values))
    before_part = Window.orderBy("part_").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("part_", *(F.coalesce(F.sum(f"sum_{n}").over(before_part), F.lit(0)).alias(f"start_{n}") for n in values))
    within = Window.partitionBy("part_").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    totals = {n: F.col(f"start_{n}") + F.coalesce(F.sum(f"value_{n}").over(within), F.lit(0)) for n in values}
    return ranged.join(F.broadcast(starts), "part_").withColumns(totals).select(*kinds, *values)


def running_total(df: DataFrame, order: list[str], value: Column, name: str) -> DataFrame:
    """running_totals of one value."""
    return running_totals(df, order, {name: value})


def numbered(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """df with each row's position from 0 in the total order of the given columns."""
    return running_total(df, order, F.lit(1).cast("long"), name)


def percent_ranked(df: DataFrame, names: dict[str, str], key: str | None = None) -> DataFrame:
    """df with percent_rank() over all rows of each value named, as the column that names gives it: (rows with a smaller
    value) / (rows - 1), 0 for a single row.

    The distinct values of all signals are counted in one long table and numbered together by one running total, so ties
    and hot values cost one row, and more signals no more passes. Ranks come back by a join for each signal, or, where key
    names a unique column of df, by one join of all.
    """
    signals = list(names)
    if not signals:
        return df
    kind = df.select(*(F.coalesce(*(F.col(s) for s in signals)).alias("v"),)).schema["v"].dataType
    long = F.explode(F.array(*(F.struct(F.lit(k).alias("k"), F.col(s).cast(kind).alias("v")) for k, s in enumerate(signals))))
    keys = [F.col(key)] if key else []
    cells = df.select(*keys, long.alias("c")).select(*keys, "c.k", "c.v")
    counts = cells.groupBy("k", "v").agg(F.count("*").alias("n_"))
    below = running_total(counts, ["k", "v"], F.col("n_"), "below_")
    below = written(below, "below")
    rows = below.filter(F.col("k") == 0).agg(F.sum("n_")).first()[0] or 0
    # each signal has a count for every row, so those before it in the long table weigh rows each
    rank = ((F.col("below_") - F.col("k") * F.lit(rows)) / F.lit(float(max(1, rows - 1)))).alias("rank_")
    ranks = below.select("k", F.col("v").alias("v_"), rank)
    if key:
        found = cells.join(ranks.withColumnRenamed("k", "k_"), (F.col("k") == F.col("k_")) & F.col("v").eqNullSafe(F.col("v_")))
        wide = found.groupBy(F.col(key).alias("key_")).agg(
            *(F.max(F.when(F.col("k") == k, F.col("rank_"))).alias(names[s]) for k, s in enumerate(signals))
        )
        return df.join(wide, df[key].eqNullSafe(wide["key_"])).drop("key_")
    for k, s in enumerate(signals):
        mine = ranks.filter(F.col("k") == k).select(F.col("v_"), F.col("rank_").alias(names[s]))
        df = df.join(mine, df[s].cast(kind).eqNullSafe(mine["v_"])).drop("v_")
    return df
