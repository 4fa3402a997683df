"""A training corpus from raw documents, in five stages.

Each stage takes (spark, docs, sf_dir) and returns the documents it keeps, with the columns
of documents; the last returns the mix. A stage works on what the one before it kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import decontaminate, mixing, pii, quality, simhash
from tessera.llm.common import drop, table, working


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the line model accept (nulls and empty texts go)."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that with the least doc_id."""
    return simhash.deduplicate(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with tags for personal data in their texts."""
    return pii.redact(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words the mix takes of each document: doc_id, size, source_size, target, taken."""
    return mixing.mix(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal data", personal_data),
    ("source mixing", source_mixing),
]

#: The line model, fingerprints and draws are beyond SQL: tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what each keeps is written to the shared folder and read again.

    A stage's working tables go when it has been written, and what it read when it is the next one's turn.
    """
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        with working(spark) as keep:
            out = keep(stage(spark, docs, sf_dir), "stage")
        drop(docs)  # the table of the stage before, if it is one
        docs = out
    return docs
