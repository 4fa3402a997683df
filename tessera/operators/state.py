"""The state of clips as a log of events: sets of finished work, decisions, and what is left."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import latest
from ..storage import numbered


def pending(work: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Work that isn't done; the join comes before whatever is to be done."""
    return work.join(done.select(key), key, "left_anti")


def only(work: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    return work.join(wanted.select(key), key, "left_semi")


def merge_done(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    return old.select(key).union(new.select(key)).distinct()


def upsert(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rows of new, and those of old whose key new doesn't have."""
    return pending(old, new, key).unionByName(new)


def incomplete(wanted: DataFrame, have: DataFrame, key: str, n: int = 10) -> DataFrame:
    """A report of the first n keys that are wanted and missing, in order; empty where all is there."""
    return wanted.join(have.select(key), key, "left_anti").select(key).orderBy(key).limit(n)


def check_complete(wanted: DataFrame, have: DataFrame, key: str) -> None:
    """Raises, naming the first ten, where wanted keys are missing."""
    missing = [r[0] for r in incomplete(wanted, have, key).collect()]
    if missing:
        raise ValueError(f"missing {key}: {', '.join(map(str, missing))}")


def state(events: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last event of each key: which directory a clip would lie in."""
    return latest(events, keys, order)


def progress(queue: DataFrame, decided: DataFrame, key: str, order: list[str], action: str, bad: str) -> DataFrame:
    """One row: queue length, decided, kept and bad clips, and the position of the first that is undecided (null: none)."""
    rows = numbered(queue.select(*dict.fromkeys([key, *order])), order, "position").join(
        decided.select(key, action), key, "left"
    )
    return rows.agg(
        F.count("*").alias("total"),
        F.count(action).alias("decided"),
        F.count_if(F.col(action) != bad).alias("keep"),
        F.count_if(F.col(action) == bad).alias("bad"),
        F.min(F.when(F.col(action).isNull(), F.col("position"))).alias("first_pending"),
    )
