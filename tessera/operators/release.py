"""Dataset releases: splits, layout, publication and merging."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import bucket_path, hhmmss
from ..storage import numbered, written

WAVS_PER_DIR = 9000


def validation_size(n: int, ratio: float) -> int:
    return max(1, round(n * ratio)) if n > 1 else 0


def split(clips: DataFrame, seed: int, ratio: float, key: str = "idx") -> DataFrame:
    """clips with split, train or val: those whose MD5 of seed and key comes first, an exact number, are val."""
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    size = validation_size(clips.count(), ratio)
    placed = numbered(clips.withColumn("hash_", order), ["hash_", key], "place_")
    return placed.withColumn("split", F.when(F.col("place_") < size, "val").otherwise("train")).drop("hash_", "place_")


def shuffled_positions(n: int, seed: int, ratio: float) -> list[int]:
    """Positions of the validation set when positions are shuffled by Python's generator; for small releases."""
    places = list(range(n))
    random.Random(seed).shuffle(places)
    return sorted(places[: validation_size(n, ratio)])


def split_shuffled(clips: DataFrame, seed: int, ratio: float, key: str = "idx") -> DataFrame:
    """As split, with the validation set that a seeded shuffle of positions by key gives."""
    chosen = shuffled_positions(clips.count(), seed, ratio)
    spark = clips.sparkSession
    val = spark.createDataFrame([(p,) for p in chosen], "place_ long").withColumn("split", F.lit("val"))
    placed = numbered(clips, [key], "place_").join(val, "place_", "left")
    return placed.withColumn("split", F.coalesce("split", F.lit("train"))).drop("place_")


def laid_out(clips: DataFrame, per_dir: int = WAVS_PER_DIR, key: str = "idx") -> DataFrame:
    """clips with the path that each is published at."""
    top = clips.agg(F.max(key)).first()[0]
    return clips.withColumn("path", bucket_path(F.col(key), per_dir, F.lit(top)))


def representatives(paths: DataFrame, path: str = "path") -> DataFrame:
    """The first path of each directory, and the last path of all."""
    folder = F.regexp_extract(path, "^(.*/)?[^/]*$", 1)
    first = paths.groupBy(folder.alias("folder")).agg(F.min(path).alias("path")).select("path")
    return first.union(paths.agg(F.max(path).alias("path")).filter("path IS NOT NULL")).distinct()


def publish(clips: DataFrame, path: str, gen: int, per_dir: int = WAVS_PER_DIR) -> None:
    """Writes metadata and, where clips have content, their bytes, by split and bucket, as generation gen."""
    rows = laid_out(clips, per_dir).withColumn("bucket", F.regexp_extract("path", "wavs/([^/]+)/", 1))
    rows.write.mode("overwrite").partitionBy("split", "bucket").parquet(f"{path}/gen={gen:03d}")


def write_manifest(rows: DataFrame, path: str) -> None:
    """(path, text) as pipe-separated lines, quoted only where needed."""
    rows.select("path", "text").write.mode("overwrite").csv(path, sep="|", quote='"', escape='"')


def integrity(metadata: DataFrame, clips: DataFrame, key: str = "idx") -> DataFrame:
    """One row: rows and repeated keys of metadata and clips, and the keys that only one of them has."""
    a = metadata.groupBy(key).agg(F.count("*").alias("a"))
    b = clips.groupBy(key).agg(F.count("*").alias("b"))
    return a.join(b, key, "full").agg(
        F.coalesce(F.sum("a"), F.lit(0)).alias("n_metadata"),
        F.coalesce(F.sum("b"), F.lit(0)).alias("n_clips"),
        F.count_if(F.col("a") > 1).alias("repeated_metadata"),
        F.count_if(F.col("b") > 1).alias("repeated_clips"),
        F.count_if(F.col("b").isNull()).alias("only_metadata"),
        F.count_if(F.col("a").isNull()).alias("only_clips"),
    )


def overlap(a: DataFrame, b: DataFrame, text: str = "text") -> DataFrame:
    """Texts that both archives have."""
    return a.select(text).intersect(b.select(text))


def reindexed(primary: DataFrame, secondary: DataFrame, key: str = "idx") -> DataFrame:
    """secondary with new_idx: dense numbers, by old key, from the one after primary's largest."""
    top = primary.agg(F.max(key)).first()[0]
    offset = 0 if top is None else top + 1
    return numbered(secondary, [key], "new_idx").withColumn("new_idx", F.col("new_idx") + F.lit(offset))


def merged(primary: DataFrame, secondary: DataFrame, key: str = "idx", per_dir: int = WAVS_PER_DIR) -> DataFrame:
    """Both archives as one: (key, text, split, path). The second gets new keys and goes to train."""
    more = reindexed(primary, secondary, key).select(
        F.col("new_idx").alias(key), "text", F.lit("train").alias("split")
    )
    return laid_out(primary.select(F.col(key).cast("long").alias(key), "text", "split").unionByName(more), per_dir, key)


def check_archive(metadata: DataFrame, clips: DataFrame, key: str = "idx") -> None:
    """Raises unless metadata and clips have the same keys, once each."""
    found = integrity(metadata, clips, key).first().asDict()
    wrong = {k: n for k, n in found.items() if n and not k.startswith("n_")}
    if wrong:
        raise ValueError(f"archive is not whole: {wrong}")


def merge(
    primary: DataFrame, secondary: DataFrame, path: str, clips: tuple[DataFrame, DataFrame] | None = None, allow_overlap: bool = False,
    key: str = "idx", per_dir: int = WAVS_PER_DIR,
) -> DataFrame:
    """Merges two archives (key, text, split) and writes the result under path: (key, text, split, path), read back.

    Refuses archives whose keys repeat or, where clips are given, don't match those of their clips; texts that both have,
    unless they are allowed; and a result that doesn't come back as it was written.
    """
    for metadata, its in zip((primary, secondary), clips or (primary, secondary), strict=True):
        check_archive(metadata, its, key)
    if not allow_overlap and not (both := overlap(primary, secondary).limit(1)).isEmpty():
        raise ValueError(f"both archives have: {both.first()[0]!r}")
    out = written(merged(primary, secondary, key, per_dir), "merged")
    out.write.mode("overwrite").parquet(path)
    back = out.sparkSession.read.parquet(path)
    print_of = [F.count("*"), F.count_distinct(key), F.sum(F.xxhash64(*out.columns).cast("decimal(38,0)"))]
    made, read = out.agg(*print_of).first(), back.agg(*print_of).first()
    if tuple(made) != tuple(read) or made[0] != made[1]:
        raise ValueError(f"merged archive under {path} differs from what was written: {tuple(made)}, {tuple(read)}")
    return back


def totals(clips: DataFrame, by: list[str]) -> DataFrame:
    """Clips and their time by group."""
    return clips.groupBy(*by).agg(F.count("*").alias("clips"), F.coalesce(F.sum("seconds"), F.lit(0.0)).alias("seconds"))


def merged_report(reports: DataFrame) -> DataFrame:
    """One report of several: counts and times are added, the rest is the first one's. Columns: rank, accepted,
    rejected, seconds, generation_seconds, model."""
    return reports.agg(
        *(F.sum(c).alias(c) for c in ("accepted", "rejected", "seconds", "generation_seconds")),
        F.min_by("model", "rank").alias("model"),
    ).withColumn("hhmmss", hhmmss(F.col("seconds")))


def report(states: DataFrame, metric: DataFrame, clips: DataFrame, manifest: DataFrame, threshold: float) -> DataFrame:
    """One row, one JSON document: totals by state, mean metric, audio time, sizes of both splits.

    states (state), metric (value), clips (seconds), manifest (split).
    """
    total = states.agg(
        F.struct(
            F.count("*").alias("input_sentences"),
            *(F.count_if(F.col("state") == s).alias(s) for s in ("accepted", "rejected", "skipped")),
        ).alias("totals")
    )
    quality = metric.agg(
        F.struct(
            F.round(F.coalesce(F.avg("value"), F.lit(0.0)), 4).alias("mean"), F.lit(threshold).alias("threshold")
        ).alias("quality")
    )
    time = F.round(F.coalesce(F.sum("seconds"), F.lit(0.0)), 3)
    audio = clips.agg(F.struct(time.alias("total_duration_seconds"), hhmmss(time).alias("total_duration_hhmmss")).alias("audio"))
    sizes = manifest.agg(
        F.struct(
            F.count_if(F.col("split") == "train").alias("train"),
            F.count_if(F.col("split") == "val").alias("val"),
            F.count("*").alias("total"),
        ).alias("manifest")
    )
    one = total
    for part in (quality, audio, sizes):  # each is one row
        one = one.join(F.broadcast(part), F.lit(True))
    return one.select("totals", "quality", "audio", "manifest", F.to_json(F.struct("*")).alias("document"))


def batched(rows: DataFrame, order: list[str], size: int) -> DataFrame:
    """rows with batch, numbers of runs of size rows in order."""
    out = numbered(rows, order, "place_")
    return out.withColumn("batch", F.floor(F.col("place_") / size)).drop("place_")
