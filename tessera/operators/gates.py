"""Accept or reject by a metric, and summaries of metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.align import error_rate
from ..functions.text import normalize_basic, phonemes
from ..storage import running_total

QUANTILES = {"p25": 0.25, "median": 0.5, "p75": 0.75, "p90": 0.9}


def gate(df: DataFrame, metric: str, threshold: float, name: str) -> DataFrame:
    """df with accepted and reason. A metric at the threshold is accepted; a null one is rejected as asr_error."""
    value = F.col(metric)
    accepted = F.coalesce(value <= threshold, F.lit(False))
    over = F.format_string(f"{name}=%.3f > {threshold:.3f}", value)
    return df.withColumns(
        {
            "accepted": accepted,
            "reason": F.when(accepted, "").when(value.isNull(), "asr_error").otherwise(over),
        }
    )


def word_errors(df: DataFrame, ref: str, hyp: str, name: str = "wer") -> DataFrame:
    return df.withColumn(name, error_rate(normalize_basic(F.col(ref)), normalize_basic(F.col(hyp))))


def phoneme_errors(df: DataFrame, ref: str, hyp: str, name: str = "per") -> DataFrame:
    return df.withColumn(name, error_rate(phonemes(F.col(ref)), phonemes(F.col(hyp))))


def evaluate(refs: DataFrame, hyps: DataFrame, threshold: float, key: str = "idx") -> DataFrame:
    """(key, per, accepted, reason) of references (key, ref) with recognitions (key, hyp; none is empty).

    Clips without a reference are left out.
    """
    joined = refs.join(hyps, key, "left").withColumn("hyp", F.coalesce("hyp", F.lit("")))
    scored = phoneme_errors(joined.filter(phonemes(F.col("ref")) != ""), "ref", "hyp")
    return gate(scored, "per", threshold, "per").select(key, "per", "accepted", "reason")


def mean_or_zero(c: Column | str) -> Column:
    return F.coalesce(F.avg(c), F.lit(0.0))


def nearest_rank(values: Column, p: float) -> Column:
    """Percentile of an array without interpolation: the element at round(p * (n - 1)), halves to even; 0 if empty."""
    place = F.bround(F.lit(p) * (F.size(values) - 1)).cast("int")
    return F.coalesce(F.get(F.array_sort(values), place), F.lit(0.0))


def calibration(df: DataFrame, value: str, threshold: float) -> DataFrame:
    """One row on all values: count, min, p25, median, p75, p90, max, mean, threshold; 0 where there are none.

    Quantiles are looked up among counted distinct values in order, so no task sees all of them.
    """
    rows = df.filter(F.col(value).isNotNull()).select(F.col(value).cast("double").alias("v"))
    counted = running_total(rows.groupBy("v").agg(F.count("*").alias("n")), ["v"], F.col("n"), "before")
    basics = rows.agg(
        F.count("*").alias("count"),
        F.coalesce(F.min("v"), F.lit(0.0)).alias("min"),
        F.coalesce(F.max("v"), F.lit(0.0)).alias("max"),
        mean_or_zero("v").alias("mean"),
    ).withColumn("threshold", F.lit(float(threshold)))
    at = {k: F.bround(F.lit(p) * (F.col("count") - 1)) for k, p in QUANTILES.items()}
    # basics is one row
    spread = counted.join(F.broadcast(basics.select("count")), F.lit(True))
    quantiles = spread.agg(
        *(
            F.coalesce(
                F.max(F.when((F.col("before") <= place) & (place < F.col("before") + F.col("n")), F.col("v"))), F.lit(0.0)
            ).alias(k)
            for k, place in at.items()
        )
    )
    out = basics.join(F.broadcast(quantiles), F.lit(True))
    return out.select("count", "min", "p25", "median", "p75", "p90", "max", "mean", "threshold")
