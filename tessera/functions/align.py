"""Edit distance over tokens, word alignment and word differences."""

from __future__ import annotations

import difflib
import math
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from . import text as tx

#: Tokens are coded by characters from the first beyond the basic plane, so a pair can have over a million.
_FIRST = 0x10000


def _bind(value: Column, then: Callable[[Column], Column]) -> Column:
    """then(value), with value computed once: a lambda's body would compute it anew for each element."""
    return F.transform(F.array(value), then)[0]


def token_distance(ref: Column, hyp: Column) -> Column:
    """Levenshtein distance between two arrays of tokens, with Spark's own levenshtein over one character per token."""

    def coded(v: Column) -> Column:
        code = lambda words: F.array_join(
            F.transform(
                words,
                lambda w: F.decode(
                    F.unhex(F.lpad(F.hex(_FIRST + F.array_position(v["known"], w)), 8, "0")), "UTF-32"
                ),
            ),
            "",
        )
        return F.levenshtein(code(v["r"]), code(v["h"]))

    known = F.array_distinct(F.concat(ref, hyp))
    return _bind(F.struct(ref.alias("r"), hyp.alias("h"), known.alias("known")), coded)


def error_rate(ref: Column, hyp: Column) -> Column:
    """Edits by reference tokens, of two texts; an empty reference: 1 if the other text has tokens, else 0."""

    def rate(v: Column) -> Column:
        empty = F.when(F.size(v["r"]) == 0, F.when(F.size(v["h"]) > 0, 1.0).otherwise(0.0))
        return F.coalesce(empty, token_distance(v["r"], v["h"]) / F.size(v["r"]))

    return _bind(F.struct(tx.words(ref).alias("r"), tx.words(hyp).alias("h")), rate)


_WORDS = "array<struct<word: string, edits: int, n_tokens: int, per: double>>"
_WORDS_ARROW = pa.list_(
    pa.struct([("word", pa.string()), ("edits", pa.int32()), ("n_tokens", pa.int32()), ("per", pa.float64())])
)
_STEPS = "array<struct<tag: string, a: string, b: string>>"
_STEPS_ARROW = pa.list_(pa.struct([("tag", pa.string()), ("a", pa.string()), ("b", pa.string())]))
#: Structs of a batch that are Python objects at a time, but for those of one row.
_AT_ONCE = 4096


def _in_arrow(rows: Iterable[list | None], kind: pa.DataType) -> pa.Array:
    """Rows of structs as one Arrow array. They are taken to Arrow every _AT_ONCE structs: as Python objects, those of a
    whole batch are over ten times its size."""
    done, held, n = [pa.array([], kind)], [], 0
    for row in rows:
        held.append(row)
        n += 1 + len(row or ())
        if n >= _AT_ONCE:
            done.append(pa.array(held, kind))
            held, n = [], 0
    return pa.concat_arrays([*done, pa.array(held, kind)])


def align(words: list[tuple[str, list[str]]], hyp: list[str]) -> list[tuple[str, int, int, float]]:
    """(word, edits, tokens, edits by token) of each word of a reference.

    Traced back from the end; on ties a pair goes before a deletion before an insertion. An insertion belongs to the
    word that follows it, at the end to the last.
    """
    ref = [t for _, tokens in words for t in tokens]
    owner = [k for k, (_, tokens) in enumerate(words) for _ in tokens]
    n, m = len(ref), len(hyp)
    steps = np.arange(m + 1, dtype=np.int32)
    codes: dict[str, int] = {}
    other = np.array([codes.setdefault(t, len(codes)) for t in hyp], np.int64)

    def rows(first: np.ndarray, start: int, end: int) -> np.ndarray:
        """Costs of prefixes start to end of the reference, given those of the first."""
        out = np.empty((end - start + 1, m + 1), np.int32)
        out[0] = first
        for k in range(1, len(out)):
            differs = other != codes.get(ref[start + k - 1], -1)
            out[k, 0] = start + k
            out[k, 1:] = np.minimum(out[k - 1, 1:] + 1, out[k - 1, :-1] + differs)
            out[k] = np.minimum.accumulate(out[k] - steps) + steps
        return out

    # Every size-th row is kept and the others are computed again on the way back: the root of the memory, twice the time.
    size = max(64, math.isqrt(n))
    kept = [steps]
    for start in range(0, n, size):
        kept.append(rows(kept[-1], start, min(n, start + size))[-1].copy())  # a view would keep its block
    edits = [0] * len(words)
    i, j = n, m
    low, cost = n, None
    while i or j:
        if i and (cost is None or i <= low):
            low = (i - 1) // size * size
            cost = rows(kept[low // size], low, min(n, low + size))
        at = i - low
        if i and j and cost[at, j] == cost[at - 1, j - 1] + (ref[i - 1] != hyp[j - 1]):
            edits[owner[i - 1]] += ref[i - 1] != hyp[j - 1]
            i, j = i - 1, j - 1
        elif i and cost[at, j] == cost[at - 1, j] + 1:
            edits[owner[i - 1]] += 1
            i -= 1
        else:
            if words:
                edits[owner[i] if i < n else -1] += 1
            j -= 1
    return [(w, int(e), len(t), e / len(t) if t else 0.0) for (w, t), e in zip(words, edits, strict=True)]


def _aligned(words: pa.Array, hyp: pa.Array) -> pa.Array:
    def one(pairs: list | None, said: str | None) -> list | None:
        if pairs is None or said is None:
            return None
        made = align([(p["word"], p["phonemes"].split()) for p in pairs], said.split())
        return [dict(zip(("word", "edits", "n_tokens", "per"), row, strict=True)) for row in made]

    return _in_arrow((one(a.as_py(), b.as_py()) for a, b in zip(words, hyp, strict=True)), _WORDS_ARROW)


def align_words(words: Column, hyp: Column) -> Column:
    """Words as {word, phonemes} and a recognized string of tokens, aligned (see align); null if either is."""
    return F.arrow_udf(_aligned, _WORDS)(words, hyp)


def _diffs(expected: pa.Array, said: pa.Array) -> pa.Array:
    def one(a: list | None, b: list | None) -> list | None:
        if a is None or b is None:
            return None
        steps = difflib.SequenceMatcher(a=a, b=b, autojunk=False).get_opcodes()
        return [{"tag": t, "a": " ".join(a[i:j]), "b": " ".join(b[k:n])} for t, i, j, k, n in steps]

    return _in_arrow((one(a.as_py(), b.as_py()) for a, b in zip(expected, said, strict=True)), _STEPS_ARROW)


def word_diff(expected: Column, said: Column) -> Column:
    """Steps (equal, delete, insert, replace) that turn one array of tokens into another; null if either is."""
    return F.arrow_udf(_diffs, _STEPS)(expected, said)
