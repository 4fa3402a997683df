"""Directories of WAV clips and of voices."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import audio
from ..functions.audio import wav_header
from ..functions.text import index_of, same_name

_FILES = "path string, modificationTime timestamp, length long, content binary"


def scan_clips(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    """(idx, path, modified, content): the clips under path; idx is null where a name is no number.

    content is read only by plans that use it.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.wav")
    if recursive:
        files = files.option("recursiveFileLookup", "true")
    rows = files.load(path)
    return rows.select(index_of(F.col("path")).alias("idx"), "path", F.col("modificationTime").alias("modified"), "content")


def with_header(clips: DataFrame) -> DataFrame:
    """clips with sample_rate, channels, bits, frames and seconds (0 where a header can't be read), without content."""
    return clips.withColumn("header", wav_header(F.col("content"))).select(
        *(c for c in clips.columns if c != "content"), "header.*"
    )


def voices(spark: SparkSession, path: str) -> DataFrame:
    """(voice, path) of the reference recordings in a directory, whatever the case of their suffix."""
    rows = spark.read.format("binaryFile").load(path).select("path")
    name = F.regexp_extract("path", r"(?i)([^/]+)\.wav$", 1)
    return rows.select(name.alias("voice"), "path").filter("voice <> ''")


def voice_paths(known: DataFrame, wanted: list[str]) -> dict[str, str]:
    """The recording of each wanted voice, whatever the case of its name; raises on an empty name or a missing one."""
    if not wanted or any(not w.strip() for w in wanted):
        raise ValueError("a voice has to be named")
    found = {r.voice.lower(): r.path for r in known.filter(F.lower("voice").isin([w.lower() for w in wanted])).collect()}
    missing = [w for w in wanted if w.lower() not in found]
    if missing:
        raise FileNotFoundError(f"no recording of {', '.join(missing)}")
    return {w: found[w.lower()] for w in wanted}


def sweep(known: DataFrame, phrases: list[str], only: str | None = None) -> DataFrame:
    """(voice, path, phrase, text): every phrase by every voice, or by the one that only names in whatever case. Phrases
    are the few that a test file has; each voice is a row that they are exploded from, not a join."""
    texts = F.array(*(F.lit(p) for p in phrases)).cast("array<string>")
    rows = known if only is None else known.filter(same_name(F.col("voice"), F.lit(only)))
    return rows.select("voice", "path", F.posexplode(texts).alias("phrase", "text"))


def _folder(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def write_clips(clips: DataFrame, path: str) -> DataFrame:
    """Writes (idx, samples, rate) as 16-bit files named after idx, when the result, (idx, file), is read. Written anew by
    a task that is run again. Clips without samples are left out."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        disk, folder = _folder(path)
        disk.create_dir(folder, recursive=True)
        for batch in batches:
            made = []
            for idx, samples, rate in zip(batch["idx"], batch["samples"], batch["rate"], strict=True):
                if samples is not None and len(samples):
                    made.append((idx, f"{idx:06d}.wav"))
                    with disk.open_output_stream(f"{folder}/{made[-1][1]}") as out:
                        out.write(audio.write_wav(np.asarray(samples, np.float64), int(rate)))
            yield pd.DataFrame(made, columns=["idx", "file"])

    return clips.select("idx", "samples", "rate").mapInPandas(run, "idx long, file string")


def normalize_clips(clips: DataFrame, path: str, rate: int = 22050, force: bool = False, **options) -> DataFrame:
    """(idx, outcome, reason, seconds) of clips (idx, content): each is made mono, resampled, trimmed, brought to a
    loudness and a peak (options: see audio.normalize), and written under path when the result is read.

    Outcomes are ok, skipped (written before, unless forced: those are never read) and failed, with the reason read_error
    or empty_audio; a clip that fails stops no other. Null contents are read errors.
    """
    spark = clips.sparkSession
    done = spark.createDataFrame([], "idx int")
    if not force:
        try:
            done = scan_clips(spark, path).select("idx").filter("idx IS NOT NULL")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise

    def one(content: bytes | None) -> tuple[np.ndarray | None, str | None]:
        try:
            x, was = audio.read_wav(content or b"")
        except Exception:  # whatever a broken file does to its reader
            return None, "read_error"
        y = audio.normalize(x, was, rate, **options) if len(x) and np.abs(x).max() > 0 else x[:0]
        return (y, None) if len(y) else (None, "empty_audio")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        disk, folder = _folder(path)
        disk.create_dir(folder, recursive=True)
        for batch in batches:
            rows = []
            for idx, content in zip(batch["idx"], batch["content"], strict=True):
                y, reason = one(content)
                if y is not None:
                    with disk.open_output_stream(f"{folder}/{idx:06d}.wav") as out:
                        out.write(audio.write_wav(y, rate))
                rows.append((idx, "ok" if y is not None else "failed", reason, len(y) / rate if y is not None else 0.0))
            yield pd.DataFrame(rows, columns=["idx", "outcome", "reason", "seconds"])

    schema = "idx long, outcome string, reason string, seconds double"
    todo = clips.join(done, "idx", "left_anti").select("idx", "content").mapInPandas(run, schema)
    skipped = clips.join(done, "idx", "left_semi").select(
        F.col("idx").cast("long").alias("idx"), F.lit("skipped").alias("outcome"), F.lit(None).cast("string").alias("reason"),
        F.lit(0.0).alias("seconds"),
    )
    return todo.unionByName(skipped)


def is_stale(made: DataFrame, clips: DataFrame, made_at: str = "modified", clip_at: str = "modified") -> bool:
    """Whether a clip is newer than everything in made."""
    newest = clips.agg(F.max(clip_at)).first()[0]
    last = made.agg(F.max(made_at)).first()[0]
    return newest is not None and (last is None or newest > last)
