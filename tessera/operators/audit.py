"""Suspect scores and review queues."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import percent_ranked

# The weight of each signal's percent rank in a score.
COMPOSITE = {"per_pitch": 0.40, "per": 0.20, "lf_burst": 0.25, "crest": 0.15}
AUDIO = {"crest": 0.40, "lf_burst": 0.60}


def audit_rows(features: DataFrame, scores: DataFrame, texts: DataFrame, key: str = "idx") -> DataFrame:
    """Features of readable clips with scores (0 where there are none) and text (empty where there is none)."""
    out = features.join(scores, key, "left").join(texts, key, "left")
    return out.withColumns(
        {c: F.coalesce(c, F.lit(0.0)) for c in ("per", "per_pitch")} | {"text": F.coalesce("text", F.lit(""))}
    )


def ranked(rows: DataFrame, signals: list[str], key: str = "idx") -> DataFrame:
    """rows with rank_<signal>, its percent rank over all rows: the share of the others with a smaller value. Keys are
    unique."""
    return percent_ranked(rows, {s: f"rank_{s}" for s in signals}, key)


def scored(rows: DataFrame, weights: dict[str, float], name: str = "suspect_score", key: str = "idx") -> DataFrame:
    total = reduce(lambda a, b: a + b, (F.lit(w) * F.col(f"rank_{s}") for s, w in weights.items()))
    return ranked(rows, list(weights), key).withColumn(name, total).drop(*(f"rank_{s}" for s in weights))


def queue(rows: DataFrame, by: str = "composite", n: int | None = 500, key: str = "idx") -> DataFrame:
    """Rows with their sort value, most suspect first, ties by key; n is the length of the report (None: all)."""
    if by in ("composite", "audio"):
        out = scored(rows, COMPOSITE if by == "composite" else AUDIO, "sort_value", key)
    else:
        out = rows.withColumn("sort_value", F.col({"per": "per", "pitch": "per_pitch"}[by]))
    out = out.orderBy(F.desc("sort_value"), key)
    return out if n is None else out.limit(n)
