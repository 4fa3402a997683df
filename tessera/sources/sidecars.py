"""JSON beside rejected clips, written by several steps, and decision maps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The fields that any step writes; which of them a file has tells who wrote it.
SIDECAR = (
    "index int, file string, expected string, reason string, transcription string, wer double, ref_phonemes string,"
    " hyp_phonemes string, audited boolean, audit_signals struct<per: double, per_pitch: double, crest: double,"
    " lf_burst: double, clf_ratio: double, dur: double, suspect_score: double>"
)


def read_sidecars(spark: SparkSession, path: str) -> DataFrame:
    """All side files under path as SIDECAR; unreadable ones, and those without an index, are left out."""
    return spark.read.schema(SIDECAR).option("multiLine", "true").json(path).filter("index IS NOT NULL")


def parse_sidecars(rows: DataFrame, text: str) -> DataFrame:
    """rows whose JSON in column text has an index, with its fields instead of the text."""
    parsed = rows.withColumn("side_", F.from_json(text, SIDECAR)).filter("side_.index IS NOT NULL")
    return parsed.select(*(c for c in rows.columns if c != text), "side_.*")


def kind() -> Column:
    """The step that wrote a side file."""
    return (
        F.when(F.col("audited"), "audit")
        .when(F.col("ref_phonemes").isNotNull() | F.col("hyp_phonemes").isNotNull(), "pronunciation")
        .otherwise("validate")
    )


def named(sidecars: DataFrame) -> DataFrame:
    """sidecars whose file, where it is missing, is named after the index."""
    return sidecars.withColumn("file", F.coalesce("file", F.format_string("%06d.wav", "index")))


def review_records(sidecars: DataFrame) -> DataFrame:
    """What a reviewer sees: missing strings empty, the file named after the index."""
    text = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    return named(sidecars).select(
        "index",
        "file",
        *map(text, ("expected", "transcription", "reason", "ref_phonemes", "hyp_phonemes")),
    )


def log_records(sidecars: DataFrame) -> DataFrame:
    """One JSON line for each side file; fields that are null are left out."""
    return sidecars.select(
        F.to_json(F.struct("index", "file", F.coalesce("reason", F.lit("")).alias("reason"), "wer", "transcription")).alias(
            "line"
        )
    )


def write_log(sidecars: DataFrame, path: str) -> None:
    """The log of rejected clips, one JSON line each, built anew from their side files."""
    log_records(sidecars).write.mode("overwrite").text(path)


def decisions(rows: DataFrame, text: str) -> DataFrame:
    """(idx, action, reason, ts) from {"decisions": {"<idx>": {...}}}; text that is no such map gives none."""
    shape = "struct<decisions: map<string, struct<action: string, reason: string, ts: string>>>"
    out = rows.select(F.explode(F.from_json(text, shape)["decisions"]).alias("idx", "d"))
    return out.select(F.col("idx").try_cast("int").alias("idx"), "d.*").filter("idx IS NOT NULL")
