"""Quality rules: base counts of a text, and Viterbi decoding of its lines by a linear-chain CRF.

The CRF has two labels, boilerplate (0) and content (1). It is trained here on lines of
labelled documents. Their own labels are latent: told from their documents' under the
constraint that a bad one has some boilerplate and a good one mostly content, and told anew
after each fit by gradient ascent on the conditional likelihood. Words in lines decoded as
content, as a share of all words, decide whether a text is kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, slices, utf8

_SPACE = b" \t\n\r\x0b\x0c"
_SYMBOLS = b"#*$%&|<>"
_CAPITALS = bytes(range(65, 91))
_SMALL = bytes(range(97, 123))
REPEAT_WORDS = 5
MIN_WORDS, MAX_REPEAT_PERCENT = 10, 20


def repeated_words(words: list[bytes]) -> int:
    """Words that stand in a window of 5 words found twice or more, its first occurrence included."""
    windows = list(zip(*(words[k:] for k in range(REPEAT_WORDS)), strict=False))
    seen, twice = set(), set()
    if len(set(windows)) == len(windows):
        return 0
    for w in windows:
        (twice if w in seen else seen).add(w)
    end, n = 0, 0
    for at, w in enumerate(windows):
        if w in twice:
            n += at + REPEAT_WORDS - max(at, end)
            end = at + REPEAT_WORDS
    return n


def base_fails(words: list[bytes]) -> tuple[int, bool]:
    """The repeated words and whether the base rules reject the text."""
    repeats = repeated_words(words)
    return repeats, len(words) < MIN_WORDS or 100 * repeats > MAX_REPEAT_PERCENT * len(words)


#: Upper ends of the steps into which each measure of a line is cut.
STEPS = {
    "symbols": (0.0, 0.02, 0.08),  # share of bytes among # * $ % & | < >
    "capitals": (0.0, 0.15, 0.5),  # share of A-Z among A-Z and a-z
    "words": (0.0, 2.0, 8.0, 40.0),  # of the line
    "length": (2.5, 9.0, 15.0),  # bytes a word
    "again": (0.0,),  # 1 if the line stands earlier in the text
    "bars": (0.0, 0.1, 0.3),  # share of words that are one symbol or a dash
}
WIDTH = sum(len(s) + 1 for s in STEPS.values())


def measures(line: bytes, words: list[bytes], again: bool) -> tuple[float, ...]:
    n = len(line) or 1
    bare = len(line.translate(None, _SYMBOLS))
    capitals = len(line) - len(line.translate(None, _CAPITALS))
    small = len(line) - len(line.translate(None, _SMALL))
    lone = sum(line.count(b) for b in (b" | ", b" - ", b" * ")) if bare < len(line) or b" - " in line else 0
    size = len(words) or 1
    return (
        (len(line) - bare) / n,
        capitals / ((capitals + small) or 1),
        len(words),
        len(line) / size,
        again,
        lone / size,
    )


def steps(rows: list[tuple[float, ...]]) -> np.ndarray:
    """One column of feature numbers for each measure: the step that its value falls in."""
    x, out, at = np.array(rows, float).reshape(-1, len(STEPS)), [], 0
    for k, ends in enumerate(STEPS.values()):
        out.append(at + np.searchsorted(ends, x[:, k], "left"))
        at += len(ends) + 1
    return np.stack(out, axis=1)


@dataclass(frozen=True)
class LineModel:
    """weights[feature, label], moves[from, to] and start[label], all log potentials."""

    weights: np.ndarray
    moves: np.ndarray
    start: np.ndarray

    def decode(self, scores: np.ndarray) -> list[int]:
        """The best labels of one text's lines (Viterbi); ties go to content."""
        (stay0, go1), (go0, stay1) = self.moves.tolist()
        a, b, back = 0.0, 0.0, []
        for k, (s0, s1) in enumerate(scores.tolist()):
            if not k:
                a, b = self.start[0] + s0, self.start[1] + s1
                continue
            from0 = a + stay0 > b + go0
            from1 = a + go1 > b + stay1
            a, b = (a + stay0 if from0 else b + go0) + s0, (a + go1 if from1 else b + stay1) + s1
            back.append((0 if from0 else 1, 0 if from1 else 1))
        label = 0 if a > b else 1
        out = [label]
        for step in reversed(back):
            label = step[label]
            out.append(label)
        return out[::-1] if len(scores) else []


#: Keeps every text; the model where there are no labelled texts of both kinds.
NEUTRAL = LineModel(np.tile([0.0, 1.0], (WIDTH, 1)), np.zeros((2, 2)), np.zeros(2))


def _lines(text: bytes) -> list[tuple[bytes, list[bytes]]]:
    return [(line, w) for line in text.split(b"\n") if (w := line.split())]


def _features(lines: list[tuple[bytes, list[bytes]]]) -> list[tuple[float, ...]]:
    seen: set[bytes] = set()
    out = []
    for line, w in lines:
        out.append(measures(line, w, line in seen))
        seen.add(line)
    return out


@dataclass(frozen=True)
class Chunk:
    """Consecutive lines of one labelled text: their features (see steps), and the text's number and quality."""

    lines: np.ndarray
    text: int
    quality: int


def chunks_of(text: bytes, number: int, quality: int, lines: int = 32, most: int = 12) -> list[Chunk]:
    """At most ``most`` stretches of so many lines each, evenly spread over the text; none of a text that the base rules
    reject anyway."""
    split = _lines(text)
    if not split or base_fails([w for _, ws in split for w in ws])[1]:
        return []
    feats = steps(_features(split))
    starts = list(range(0, len(feats), lines))
    chosen = [starts[k * len(starts) // most] for k in range(most)] if len(starts) > most else starts
    return [Chunk(feats[at : at + lines], number, quality) for at in chosen]


def _logsum(x: np.ndarray) -> np.ndarray:
    top = x.max(axis=-1, keepdims=True)
    return top[..., 0] + np.log(np.exp(x - top).sum(axis=-1))


class _Fit:
    """Padded chunks, and gradient ascent on the conditional likelihood of their lines' labels."""

    def __init__(self, chunks: list[Chunk], good_share: float):
        self.size = np.array([len(c.lines) for c in chunks])
        longest = self.size.max()
        self.feats = np.full((len(chunks), longest, len(STEPS)), WIDTH)  # feature WIDTH: no line
        for k, c in enumerate(chunks):
            self.feats[k, : len(c.lines)] = c.lines
        self.live = np.arange(longest) < self.size[:, None]
        self.quality = np.array([c.quality for c in chunks])
        self.text = np.unique([c.text for c in chunks], return_inverse=True)[1]
        of_text = np.bincount(self.text, self.size)[self.text]  # a long text doesn't outweigh a short one
        texts = [len(np.unique(self.text[self.quality == q])) for q in (0, 1)]
        self.weight = np.where(self.quality == 1, good_share / texts[1], (1 - good_share) / texts[0]) / of_text

    def messages(self, weights: np.ndarray, moves: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Posteriors of each line's label, and of each pair of neighbours' labels (forward-backward)."""
        score = weights[self.feats].sum(axis=2)
        live = self.live
        ahead, behind = np.zeros((*score.shape,)), np.zeros((*score.shape,))
        ahead[:, 0] = start + score[:, 0]
        for t in range(1, score.shape[1]):
            step = score[:, t] + _logsum((ahead[:, t - 1, :, None] + moves).transpose(0, 2, 1))
            ahead[:, t] = np.where(live[:, t, None], step, ahead[:, t - 1])
        for t in range(score.shape[1] - 2, -1, -1):
            step = _logsum(moves + (score[:, t + 1] + behind[:, t + 1])[:, None, :])
            behind[:, t] = np.where(live[:, t + 1, None], step, behind[:, t + 1])
        total = _logsum(ahead[:, -1])
        one = np.exp(ahead + behind - total[:, None, None]) * live[..., None]
        pair = np.exp(
            ahead[:, :-1, :, None] + moves + (score[:, 1:] + behind[:, 1:])[:, :, None, :] - total[:, None, None, None]
        )
        return one, pair * live[:, 1:, None, None]

    def ascend(
        self, model: tuple[np.ndarray, np.ndarray, np.ndarray], labels: np.ndarray, rounds: int, rate: float, decay: float
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """model (weights, moves, start) after so many more rounds on lines of these labels."""
        weights, moves, start = (x.copy() for x in model)
        real = (np.arange(2) == labels[..., None]) * self.live[..., None].astype(float)
        both = real[:, :-1, :, None] * real[:, 1:, None, :]
        for _ in range(rounds):
            one, pair = self.messages(weights, moves, start)
            off = (real - one) * self.weight[:, None, None]
            step = np.zeros_like(weights)
            for k in range(len(STEPS)):
                for y in range(2):
                    step[:, y] += np.bincount(self.feats[:, :, k].ravel(), off[..., y].ravel(), WIDTH + 1)
            drift = ((both - pair) * self.weight[:, None, None, None]).sum(axis=(0, 1))
            weights += rate * (step - decay * weights)
            moves += rate * (drift - decay * moves)
            start += rate * ((real[:, 0] - one[:, 0]) * self.weight[:, None]).sum(axis=0)
            weights[WIDTH] = 0.0
        return weights, moves, start

    def first_labels(self) -> np.ndarray:
        """Labels to begin with: a line of a bad text is boilerplate if its features are commoner in bad texts."""
        counts = np.ones((2, WIDTH + 1)) * 1e-3
        for q in (0, 1):
            mine = self.quality == q
            each = np.broadcast_to(self.weight[mine, None, None], self.feats[mine].shape)
            counts[q] += np.bincount(self.feats[mine].ravel(), each.ravel(), WIDTH + 1) / self.weight[mine].sum()
        ratio = np.log(counts[0] / counts[1])
        ratio[WIDTH] = 0.0
        return self.allowed(ratio[self.feats].sum(axis=2))

    def allowed(self, doubt: np.ndarray) -> np.ndarray:
        """Labels from log odds for boilerplate: a bad text has at least one such line, a good one only where they are
        high, and less than half of its lines."""
        doubt = np.where(self.live, doubt, -np.inf)
        labels = np.where(doubt > 0, 0, 1)
        worst = np.full(self.text.max() + 1, -np.inf)
        np.maximum.at(worst, self.text, doubt.max(axis=1))
        bad = self.quality == 0
        labels[bad[:, None] & (doubt == worst[self.text][:, None])] = 0
        labels[~bad] = np.where(doubt[~bad] > SURE, 0, 1)
        found = np.bincount(self.text, (labels == 0).sum(axis=1))
        much = ~bad & (2 * found[self.text] >= np.bincount(self.text, self.size)[self.text])
        labels[much] = 1
        return labels


#: Log odds from which a line of a good text is taken for boilerplate in training.
SURE = 3.0


def train(
    chunks: list[Chunk],
    passes: int = 3,
    rounds: int = 40,
    rate: float = 5.0,
    decay: float = 0.002,
    good_share: float = 0.8,
) -> LineModel:
    """Fits the CRF to chunks of labelled texts; good texts weigh good_share of all, so doubt favours keeping.

    Lines have no labels of their own: they are latent. They start from the features that bad texts have and good ones
    lack, and are then told anew, from posteriors of the fitted chain, in each of the passes: most lines of good texts
    are content, and a bad text has at least one line of boilerplate. Without texts of both kinds: NEUTRAL.
    """
    if len({c.quality for c in chunks}) < 2:
        return NEUTRAL
    fit = _Fit(chunks, good_share)
    labels = fit.first_labels()
    model = np.zeros((WIDTH + 1, 2)), np.zeros((2, 2)), np.zeros(2)
    for _ in range(passes):
        model = fit.ascend(model, labels, rounds, rate, decay)
        one, _ = fit.messages(*model)
        labels = fit.allowed(np.log(one[..., 0] + 1e-12) - np.log(one[..., 1] + 1e-12))
    weights, moves, start = model
    return LineModel(weights[:WIDTH], moves, start)


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    size: int = 600,
    id_col: str = "doc_id",
    text_col: str = "text",
    lines: int = 32,
    most: int = 12,
) -> list[Chunk]:
    """Chunks of at most ``size`` labelled texts, half of each quality where there are so many, by hash of the id.

    Texts are cut into chunks (see chunks_of) where they are; the driver gets features alone, six bytes a line: at most
    size * lines * most of them, however long the texts.
    """
    quality = labels.select(F.col(id_col).alias("lid"), F.col("quality").cast("int").alias("quality"))
    chosen = None
    for q in (0, 1):
        some = quality.filter(F.col("quality") == q).orderBy(F.xxhash64("lid"), "lid").limit(size // 2)
        chosen = some if chosen is None else chosen.union(some)
    ids = [(r.lid, r.quality) for r in chosen.distinct().collect()]
    if not ids:
        return []
    wanted = docs.sparkSession.createDataFrame(ids, chosen.schema)
    rows = docs.select(F.col(id_col).alias("did"), F.col(text_col).cast("binary").alias("text"))
    got = rows.join(F.broadcast(wanted), F.col("did") == F.col("lid")).filter("text IS NOT NULL")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "quality", "part", "lines"]
        for batch in batches:
            for key, quality, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                parts = [c.lines.astype(np.uint8).tobytes() for c in chunks_of(text, 0, quality, lines, most)]
                n = len(parts)
                cols = [[key] * n, [quality] * n, range(n), parts]
                kinds = [pa.int64(), pa.int32(), pa.int32(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names)

    got = got.select(F.xxhash64("lid", F.sha2("text", 256)).alias("key"), "quality", "text")
    parts = got.mapInArrow(cut, "key long, quality int, part int, lines binary")
    # repeated ids count once for each text: so many texts and no more
    keys = parts.select("key", "quality").distinct().orderBy("key", "quality").limit(size)
    found = parts.join(F.broadcast(keys), ["key", "quality"]).distinct().orderBy("key", "quality", "part").limit(size * most).collect()
    return [Chunk(np.frombuffer(r.lines, np.uint8).reshape(-1, len(STEPS)).astype(np.int64), r.key, r.quality) for r in found]


NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "content_share")


def judge(texts: list[bytes], model: LineModel, least_content: float) -> list[tuple]:
    """The values of NAMES for each text."""
    split = [_lines(t) for t in texts]
    scores = model.weights[steps([m for lines in split for m in _features(lines)])].sum(axis=1)
    out, at = [], 0
    for text, lines in zip(texts, split, strict=True):
        words = [w for _, ws in lines for w in ws]
        repeats, failed = base_fails(words)
        labels = model.decode(scores[at : at + len(lines)])
        at += len(lines)
        content = sum(len(ws) for (_, ws), y in zip(lines, labels, strict=True) if y)
        share = content / len(words) if words else 0.0
        out.append(
            (
                len(words),
                len(text.translate(None, _SPACE).decode()),
                len(text) - len(text.translate(None, _SYMBOLS)),
                len(lines) - len({line for line, _ in lines}),
                repeats,
                failed,
                not failed and share >= least_content,
                share,
            )
        )
    return out


def assess(
    docs: DataFrame, model: LineModel, text_col: str = "text", least_content: float = 0.5
) -> tuple[DataFrame, list[str]]:
    """Every row of docs with the columns NAMES (underscores before those that docs has), and their names.

    A null or empty text has no words, so it fails the base rules and is not kept. Repeated rows are judged alike;
    an empty table stays empty; whole texts are read. Ties in decoding go to content.
    """
    names = fresh(docs, *NAMES)
    kinds = [T.LongType()] * 5 + [T.BooleanType()] * 2 + [T.DoubleType()]
    arrow = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text_col):
                rows = judge([t or b"" for t in utf8(part.column(text_col))], model, least_content)
                made = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(arrow)]
                yield pa.RecordBatch.from_arrays([*part.columns, *made], [*part.schema.names, *names])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *map(T.StructField, names, kinds)])), names


def line_labels(texts: list[bytes], model: LineModel) -> list[list[tuple[bytes, int]]]:
    """Each text's lines that have words, with their labels: 1 content, 0 boilerplate."""
    out = []
    for text in texts:
        lines = _lines(text)
        labels = model.decode(model.weights[steps(_features(lines))].sum(axis=1))
        out.append([(line, y) for (line, _), y in zip(lines, labels, strict=True)])
    return out


def verdicts(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = 600, **options
) -> DataFrame:
    """One row per row of docs: id and NAMES, under a model trained on at most ``sample`` labelled texts."""
    model = train(labelled_sample(docs, labels, sample, id_col, text_col))
    out, names = assess(docs.select(id_col, text_col), model, text_col, **options)
    return out.select(F.col(id_col), *(F.col(a).alias(b) for a, b in zip(names, NAMES, strict=True)))


BASE = NAMES[:6]


def base_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id and the columns that no model decides."""
    out, names = assess(docs.select(id_col, text_col), NEUTRAL, text_col)
    return out.select(F.col(id_col), *(F.col(a).alias(b) for a, b in zip(names, BASE, strict=False)))


#: base_counts of documents.
SQL = rf"""
WITH w AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
l AS (SELECT doc_id, w, text, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM w),
g AS (SELECT doc_id, i, array_to_string(w[i:i + {REPEAT_WORDS - 1}], ' ') AS win FROM (SELECT doc_id, w, unnest(range(1, len(w) - {REPEAT_WORDS - 2})) AS i FROM w)),
t AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS n FROM g) WHERE n > 1),
r AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words FROM (SELECT doc_id, unnest(range(i, i + {REPEAT_WORDS})) AS p FROM t) GROUP BY doc_id),
c AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
  CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
  CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
  FROM l LEFT JOIN r USING (doc_id))
SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM c
"""


def keep_good(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = 600, **options
) -> DataFrame:
    """The rows of docs, columns unchanged, that are kept."""
    model = train(labelled_sample(docs, labels, sample, id_col, text_col))
    out, names = assess(docs, model, text_col, **options)
    return out.filter(F.col(names[NAMES.index("kept")])).select(*docs.columns)
