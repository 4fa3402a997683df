"""Corpora: one sentence a line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import strip
from ..storage import numbered

#: Line ends, in any script and control.
LINE_END = r"\R|[\x1c-\x1e]"


def sentences(text: Column) -> Column:
    """The sentences of a text: stripped lines that aren't empty, but for those that start with #.

    A line with white space before its # is a sentence.
    """
    lines = F.filter(F.split(text, LINE_END), lambda s: (strip(s) != "") & ~s.startswith("#"))
    return F.transform(lines, strip)


def explode_sentences(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, line, text): the sentences of each row, numbered from 0 within it."""
    return docs.select(F.col(key), F.posexplode(sentences(F.col(text))).alias("line", "text"))


def read_corpus(spark: SparkSession, path: str) -> DataFrame:
    """(idx, text) of the sentences in files under path, by file name, then line, numbered from 0.

    Files are read line by line, and large ones in several tasks: a line's place is its block's start in the file and its
    number among the task's rows, which grows through a block.
    """
    lines = spark.read.text(path).select(
        F.struct(
            F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        ).alias("at"),
        "value",
    )
    return numbered(explode_sentences(lines, "at", "value"), ["at", "line"], "idx").select("idx", "text")
