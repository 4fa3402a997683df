"""Error rates by word."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import running_total, written


def with_tokens(rows: DataFrame, n_tokens: str = "n_tokens") -> DataFrame:
    """Aligned words that have tokens; the others have no error rate."""
    return rows.filter(F.col(n_tokens) > 0)


def word_stats(rows: DataFrame, word: str = "word", per: str = "per") -> DataFrame:
    """(word, occurrences, mean_per, min_per, max_per, median_per) by word as it is written; values to 4 places.

    rows have a word and its error rate; those without tokens are filtered before (with_tokens). The median is the element
    at round((n - 1) / 2), halves to even. It is found by running totals over the distinct (word, value) in order, so
    neither a very common word nor one with very many values comes to one task.
    """
    pairs = rows.groupBy(F.col(word).alias("word"), F.col(per).cast("double").alias("v")).agg(F.count("*").alias("n"))
    placed = written(running_total(pairs, ["word", "v"], F.col("n"), "before"), "placed")
    stats = placed.groupBy("word").agg(
        F.sum("n").alias("occurrences"),
        (F.sum(F.col("v") * F.col("n")) / F.sum("n")).alias("mean"),
        F.min("v").alias("min"),
        F.max("v").alias("max"),
        F.min("before").alias("first"),
    )
    middle = F.col("first") + F.bround((F.col("occurrences") - 1) * F.lit(0.5))
    here = (F.col("before") <= middle) & (middle < F.col("before") + F.col("n"))
    return placed.join(stats, "word").filter(here).select(
        "word",
        "occurrences",
        F.round("mean", 4).alias("mean_per"),
        F.round("min", 4).alias("min_per"),
        F.round("max", 4).alias("max_per"),
        F.round("v", 4).alias("median_per"),
    )


def worst_words(stats: DataFrame, least: int = 2, n: int = 20, positive: bool = True) -> DataFrame:
    """The n words of at least so many occurrences with the highest mean; positive leaves out those without errors."""
    rows = stats.filter(F.col("occurrences") >= least)
    if positive:
        rows = rows.filter("mean_per > 0")
    return rows.orderBy(F.desc("mean_per"), "word").limit(n)


def one_off_words(stats: DataFrame, n: int = 5) -> DataFrame:
    return stats.filter("occurrences = 1 AND mean_per > 0").orderBy(F.desc("mean_per"), "word").limit(n)


def word_summary(stats: DataFrame, least: int = 2) -> DataFrame:
    """One row: unique words, perfect ones, those with errors that occur often enough, and one-offs with errors."""
    wrong = F.col("mean_per") > 0
    return stats.agg(
        F.count("*").alias("unique_words"),
        F.count_if(F.col("mean_per") == 0).alias("perfect"),
        F.count_if(wrong & (F.col("occurrences") >= least)).alias("systemic"),
        F.count_if(wrong & (F.col("occurrences") == 1)).alias("one_off"),
    )


def word_report(stats: DataFrame, path: str) -> None:
    """Writes word statistics as pipe-separated files with a header, worst first, rates with 4 places."""
    rates = [F.format_string("%.4f", c).alias(c) for c in ("mean_per", "min_per", "max_per", "median_per")]
    out = stats.orderBy(F.desc("mean_per"), "word").select("word", "occurrences", *rates)
    out.write.mode("overwrite").csv(path, sep="|", header=True, quote='"', escape='"')


def text_report(stats: DataFrame, summary: DataFrame, n: int = 20) -> str:
    """A report for reading: the summary, the n worst words and a few one-offs, in columns. Only those rows are fetched."""
    total = summary.first()
    lines = [f"{name:<16}{total[name]:>10}" for name in summary.columns]
    for title, rows in (("worst words", worst_words(stats, n=n)), ("one-off words", one_off_words(stats))):
        lines += ["", title, f"{'word':<24}{'times':>8}{'mean':>9}{'max':>9}"]
        lines += [f"{r.word:<24}{r.occurrences:>8}{r.mean_per:>9.4f}{r.max_per:>9.4f}" for r in rows.collect()]
    return "\n".join(lines) + "\n"
