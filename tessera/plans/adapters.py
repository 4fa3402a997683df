"""Model steps as pluggable adapters over partitions, with replays that need no model."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import normalize_basic, words


class Adapter(Protocol):
    """A model: loaded once a partition, called with batches."""

    output: str

    def load(self) -> None: ...

    def run(self, batch: pd.DataFrame) -> pd.DataFrame: ...


def apply(df: DataFrame, adapter: Adapter) -> DataFrame:
    """The adapter over each partition; nothing is loaded for an empty one."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ready = False
        for batch in batches:
            if not len(batch):
                continue
            if not ready:
                adapter.load()
                ready = True
            yield adapter.run(batch)

    return df.mapInPandas(run, adapter.output)


class ToneSpeech:
    """Speech synthesis for tests: a tone whose length follows the text. Gives (idx, samples, rate); empty texts none."""

    output = "idx long, samples array<float>, rate int"

    def __init__(self, rate: int = 8000, seconds_a_word: float = 0.05):
        self.rate, self.seconds = rate, seconds_a_word

    def load(self) -> None:
        pass

    def run(self, batch: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for idx, text in zip(batch["idx"], batch["text"], strict=True):
            n = int(self.rate * self.seconds * len((text or "").split()))
            if n:
                wave = 0.3 * np.sin(2 * np.pi * 220 * np.arange(n) / self.rate)
                rows.append((idx, wave.astype(np.float32), self.rate))
        return pd.DataFrame(rows, columns=["idx", "samples", "rate"])


def replay(clips: DataFrame, said: DataFrame, key: str = "idx", column: str = "transcription") -> DataFrame:
    """Recognition from a table of what was recognized before; null where it failed."""
    return clips.join(said.select(key, F.col(column)), key, "left")


def lexicon_phonemes(texts: DataFrame, lexicon: DataFrame, key: str = "idx", text: str = "text") -> DataFrame:
    """(key, ref): the phonemes of each text's words between U+001F, from a lexicon (word, phonemes) instead of a model.

    Words are looked up as normalize_basic writes them; one that the lexicon lacks has none and keeps its place. A text
    without words is left out, as one that a model gives nothing for. Of a word that the lexicon has twice, the least counts.
    """
    known = lexicon.groupBy(F.col("word").alias("known_")).agg(F.min("phonemes").alias("phonemes_"))
    each = texts.select(F.col(key), F.posexplode(words(normalize_basic(F.col(text)))).alias("place_", "word_"))
    found = each.join(known, F.col("word_") == F.col("known_"), "left")
    # as many rows as a text has words
    chunks = F.array_sort(F.collect_list(F.struct("place_", F.coalesce("phonemes_", F.lit("")).alias("p"))))
    return found.groupBy(key).agg(F.array_join(F.transform(chunks, lambda c: c["p"]), "\x1f").alias("ref"))
