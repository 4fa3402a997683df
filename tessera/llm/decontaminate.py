"""Benchmark decontamination over suffix arrays of the training text.

Each task turns its documents into word numbers and sorts the suffixes of one shard, a
bounded range of them, at a time (compared over as many words as a window has). Every window
of the benchmark, which is the head of a test suffix, is then found by binary search: the
range it gives holds all its locations. From there the match is followed along the sorted
test suffixes as far as it goes, so the longest verbatim match is known whole. No shuffle:
the benchmark comes in blocks of bounded size, each broadcast, and one pass over the
documents meets them one after the other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, slices, utf8

#: Words are runs of 0-9, a-z (A-Z lowered) and anything beyond ASCII; all else separates.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
#: Bytes of a text that are split at a time.
_PART = 1 << 22


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_FOLD).split() if text else []


def numbers_of(text: bytes | None, get: Callable[[bytes, int], int]) -> np.ndarray:
    """The number of each word of a text, 0 for those that get doesn't know; long texts are split in parts."""
    out, at, size = [], 0, len(text or b"")
    while at < size:
        n = _PART
        while True:
            part = text[at : at + n].translate(_FOLD)
            end = part.rfind(b" ") + 1
            if at + n >= size or end:
                break
            n *= 2  # a word beyond the part
        if at + n < size:
            part = part[:end]
        at += len(part)
        w = part.split()
        out.append(np.fromiter((get(x, 0) for x in w), np.int32, len(w)))
    return np.concatenate(out) if out else np.zeros(0, np.int32)


class Benchmark:
    """The windows of some benchmark items in the order of their suffixes.

    A window is ``window`` consecutive words; an item of fewer words, but not none, is one
    window. ``suffixes`` are the places in ``flat`` at which windows start, sorted by all that
    follows in the item; windows of the same words stand side by side, from ``groups[k]`` on.
    ``owners[starts[k]:starts[k + 1]]`` are the items that have window k.
    """

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        self.window, self.ids, self.vocab = window, [i for i, _ in items], {}
        number = self.vocab.setdefault
        texts = [np.array([number(x, len(self.vocab) + 1) for x in words_of(t)], np.int32) for _, t in items]
        size = np.array([len(t) for t in texts], np.int64)
        self.bits = max(1, len(self.vocab).bit_length())
        # items stand one after the other, each with its own negative number behind it
        self.flat = np.concatenate([np.append(t, -1 - k) for k, t in enumerate(texts)] + [np.zeros(0)]).astype(np.int32)
        first = np.cumsum(size + 1) - size - 1
        item = np.repeat(np.arange(len(size)), size + 1)
        left = np.repeat(first + size, size + 1) - np.arange(len(item))  # words from here to the item's end
        begin = np.flatnonzero((left >= window) | ((np.arange(len(item)) == first[item]) & (left > 0)))
        rank = self._ranks(int(size.max(initial=0)))
        length = np.minimum(left[begin], window)
        rows = np.concatenate([self.flat, np.zeros(window, np.int32)])[begin[:, None] + np.arange(window)].astype(np.int64)
        rows[np.arange(window) >= length[:, None]] = 0
        keys = self.pack(rows)
        order = np.lexsort([rank[begin], *keys[::-1], length])
        self.suffixes, length, item = begin[order], length[order], item[begin[order]]
        keys = [k[order] for k in keys]
        new = np.ones(len(order), bool)
        if len(order):
            new[1:] = np.logical_or.reduce([np.diff(k) != 0 for k in [*keys, length]])
        heads = np.flatnonzero(new)
        self.groups, self.length = np.append(heads, len(order)), length[heads]
        pair = np.unique(np.stack([np.cumsum(new) - 1, item]), axis=1) if len(order) else np.zeros((2, 0), np.int64)
        self.owners = pair[1]
        self.starts = np.searchsorted(pair[0], np.arange(len(heads) + 1))
        low = rows[order][heads]
        high = np.where(np.arange(window) < self.length[:, None], low, (1 << self.bits) - 1)
        self.low, self.high = self.pack(low), self.pack(high)
        self.least = int(self.length.min(initial=window))

    def _ranks(self, longest: int) -> np.ndarray:
        """Each place's position among all suffixes, by prefix doubling."""
        _, rank = np.unique(self.flat, return_inverse=True)
        step = 1
        while step < longest:
            after = np.append(rank[step:] + 1, np.zeros(min(step, len(rank)), rank.dtype))
            _, rank = np.unique(rank * np.int64(len(rank) + 2) + after, return_inverse=True)
            step *= 2
        return rank

    def pack(self, words: np.ndarray) -> list[np.ndarray]:
        """Columns of integers that compare as the rows of words do."""
        per, out = 62 // self.bits, []
        for at in range(0, self.window, per):
            key = np.zeros(len(words), np.int64)
            for k in range(at, min(self.window, at + per)):
                key = (key << self.bits) | words[:, k]
            out.append(key)
        return out

    def extend(self, which: np.ndarray, words: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How many words from each place at on stand so in an item, from its window (``which``) onwards."""
        lo, hi = self.groups[which].copy(), self.groups[which + 1].copy()
        depth = self.length[which].copy()
        live = np.flatnonzero((depth == self.window) & (at + depth < len(words)))
        while len(live):
            word = words[at[live] + depth[live]]
            a = self._within(lo[live], hi[live], depth[live], word, False)
            b = self._within(a, hi[live], depth[live], word, True)
            go = (a < b) & (word > 0)
            live, a, b = live[go], a[go], b[go]
            lo[live], hi[live] = a, b
            depth[live] += 1
            live = live[at[live] + depth[live] < len(words)]
        return depth

    def _within(self, lo: np.ndarray, hi: np.ndarray, depth: np.ndarray, word: np.ndarray, after: bool) -> np.ndarray:
        """Among sorted suffixes lo to hi, which agree so far, the first whose next word is not below (or is above) word."""
        lo, end = lo.copy(), hi.copy()
        while (open_ := lo < end).any():
            mid = np.where(open_, (lo + end) // 2, 0)
            here = self.flat[np.minimum(self.suffixes[mid] + depth, len(self.flat) - 1)]
            go = ((here <= word) if after else (here < word)) & open_
            lo, end = np.where(go, mid + 1, lo), np.where(go | ~open_, end, mid)
        return lo


def _below(a: list[np.ndarray], b: list[np.ndarray], equal: bool) -> np.ndarray:
    """Where row a comes before row b (or equals it)."""
    less = np.zeros(len(a[0]), bool)
    same = np.ones(len(a[0]), bool)
    for x, y in zip(a, b, strict=True):
        less |= same & (x < y)
        same &= x == y
    return less | same if equal else less


def _bound(keys: list[np.ndarray], query: list[np.ndarray], after: bool) -> np.ndarray:
    """Binary search of each query row in the sorted suffixes: the first place not before it (or after it)."""
    lo = np.zeros(len(query[0]), np.int64)
    hi = np.full(len(query[0]), len(keys[0]), np.int64)
    while (open_ := lo < hi).any():
        mid = (lo + hi) // 2
        at = np.minimum(mid, len(keys[0]) - 1)
        go = _below([k[at] for k in keys], query, after) & open_
        lo, hi = np.where(go, mid + 1, lo), np.where(go | ~open_, hi, mid)
    return lo


def search(words: np.ndarray, start: int, end: int, bench: Benchmark) -> tuple[np.ndarray, np.ndarray]:
    """(window, place) of every occurrence of a window that starts in the shard start to end of words; 0 is a word that
    no item has."""
    shard = words[start : end + bench.window - 1]
    none = np.zeros(0, np.int64)
    if len(shard) < bench.least or not len(bench.length):
        return none, none
    gaps = np.append(np.flatnonzero(shard == 0), len(shard))
    run = gaps[np.searchsorted(gaps, np.arange(len(shard)))] - np.arange(len(shard))  # known words from here on
    suffixes = np.flatnonzero(run[: end - start] >= bench.least)
    if not len(suffixes):
        return none, none
    padded = np.concatenate([shard, np.zeros(bench.window, shard.dtype)]).astype(np.int64)
    keys = bench.pack(padded[suffixes[:, None] + np.arange(bench.window)])
    order = np.lexsort(keys[::-1])
    keys, suffixes = [k[order] for k in keys], suffixes[order]
    lo, hi = _bound(keys, bench.low, False), _bound(keys, bench.high, True)
    count = hi - lo
    which = np.repeat(np.arange(len(count)), count)
    place = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(lo, count)
    return which, suffixes[place] + start


class _Found:
    """What one document shares with the benchmark."""

    __slots__ = ("words", "spans", "items", "longest")

    def __init__(self):
        self.words, self.spans, self.items, self.longest = 0, [], set(), 0

    def add(self, spans: list[int]) -> None:
        """Hit intervals; overlapping or touching ones become one."""
        joined: list[int] = []
        for s, e in sorted(zip((self.spans + spans)[::2], (self.spans + spans)[1::2], strict=True)):
            if joined and s <= joined[-1]:
                joined[-1] = max(joined[-1], e)
            else:
                joined += [s, e]
        self.spans = joined


def _match(docs: list[np.ndarray], found: list[_Found], bench: Benchmark, shard_words: int) -> None:
    """Adds to found what the documents, given as word numbers, share with a block of the benchmark."""
    size = np.array([len(d) for d in docs], np.int64)
    first = np.cumsum(size + 1) - size - 1  # a word that no item has stands between documents
    words = np.zeros(int((size + 1).sum()), np.int32)
    for at, d in zip(first, docs, strict=True):
        words[at : at + len(d)] = d
    shards = [search(words, at, min(at + shard_words, len(words)), bench) for at in range(0, len(words), shard_words)]
    which, pos = (np.concatenate(x) for x in zip(*shards, strict=True))
    if not len(which):
        return
    order = np.lexsort((which, pos))
    which, pos = which[order], pos[order]
    edge = np.bincount(pos, minlength=len(words) + 1) - np.bincount(pos + bench.length[which], minlength=len(words) + 1)
    hit = np.concatenate([[0], np.cumsum(edge) > 0, [0]]).astype(np.int8)
    starts, ends = np.flatnonzero(np.diff(hit) == 1), np.flatnonzero(np.diff(hit) == -1)
    spans: dict[int, list[int]] = {}
    for doc, s, e in zip(np.searchsorted(first, starts, "right") - 1, starts, ends, strict=True):
        spans.setdefault(int(doc), []).extend((int(s - first[doc]), int(e - first[doc])))
    for doc, flat in spans.items():
        found[doc].add(flat)
    doc = np.searchsorted(first, pos, "right") - 1
    for d, w in np.unique(np.stack([doc, which]), axis=1).T:
        found[d].items.update(bench.ids[i] for i in bench.owners[bench.starts[w] : bench.starts[w + 1]])
    # Matches lie within hit intervals: a place is followed only while the rest of its interval could still be the longest.
    best = np.zeros(len(docs), np.int64)
    np.maximum.at(best, doc, bench.length[which])
    run = np.searchsorted(starts, pos, "right") - 1
    open_ = np.flatnonzero(bench.length[which] == bench.window)
    while len(open_ := open_[ends[run[open_]] - pos[open_] > best[doc[open_]]]):
        front = open_[np.unique(run[open_], return_index=True)[1]]
        np.maximum.at(best, doc[front], bench.extend(which[front], words, pos[front]))
        open_ = np.setdiff1d(open_, front, assume_unique=True)
    for d in np.unique(doc):
        found[d].longest = max(found[d].longest, int(best[d]))


def _scan(blocks: list[Broadcast], text_col: str, names: tuple[str, ...], shard_words: int):
    def loaded(k: int) -> Benchmark:
        if len(blocks) > 1:  # one block in memory at a time
            for other in blocks[:k] + blocks[k + 1 :]:
                other.__dict__.pop("_value", None)
        return blocks[k].value

    def matched(part: pa.RecordBatch) -> list[_Found]:
        texts = utf8(part.column(text_col))
        found = [_Found() for _ in texts]
        for k in range(len(blocks)):
            bench = loaded(k)
            docs = [numbers_of(t, bench.vocab.get) for t in texts]
            _match(docs, found, bench, shard_words)
        for f, d in zip(found, docs, strict=True):
            f.words = len(d)
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text_col):
                found = matched(part)
                made = [
                    pa.array([f.words for f in found], pa.int64()),
                    pa.array([f.spans for f in found], pa.list_(pa.int32())),
                    pa.array([sorted(f.items) for f in found], pa.list_(pa.string())),
                    pa.array([f.longest for f in found], pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays([*part.columns, *made], [*part.schema.names, *names])

    return run


def _blocks(bench: DataFrame, item_col: str, text_col: str, block_bytes: int) -> Iterator[list[tuple[str, bytes]]]:
    """The benchmark in blocks of at most block_bytes of text (or one item)."""
    block, held = [], 0
    for item, text in (
        bench.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")), F.col(text_col).cast("string"))
        .distinct()
        .toLocalIterator()
    ):
        raw = (text or "").encode()
        if block and held + len(raw) > block_bytes:
            yield block
            block, held = [], 0
        block.append((item, raw))
        held += len(raw)
    yield block


def find_matches(
    docs: DataFrame,
    bench: DataFrame,
    *,
    text_col: str = "text",
    item_col: str = "item_id",
    bench_text_col: str = "text",
    window: int = 10,
    shard_words: int = 1 << 20,
    block_bytes: int = 16 << 20,
) -> tuple[DataFrame, list[str]]:
    """Every row of docs with what the benchmark shares with it, and the names of the four added columns.

    Added: words in the text, hit intervals (start, end, start, end ...; word numbers), sorted ids of items with an
    occurring window, words of the longest verbatim match (of one window at least). Names get underscores before them
    where docs has them.

    A null or empty text has no words and no hits; null and empty items have no windows; a null item id is reported as
    the empty string; repeated rows of docs each get their own result and repeated items count once; an empty benchmark
    leaves every document clean. Texts of any length are searched whole, in shards: of a long one a task holds the text,
    four bytes a word, and the sort keys of one shard.
    """
    names = fresh(docs, "n_words", "hits", "items", "longest")
    kinds = [T.LongType(), T.ArrayType(T.IntegerType()), T.ArrayType(T.StringType()), T.LongType()]
    schema = T.StructType([*docs.schema.fields, *map(T.StructField, names, kinds)])
    share = docs.sparkSession.sparkContext.broadcast
    blocks = [share(Benchmark(block, window)) for block in _blocks(bench, item_col, bench_text_col, block_bytes)]
    return docs.mapInArrow(_scan(blocks, text_col, tuple(names), shard_words), schema), names


def digest(ids: list[str]) -> str:
    return hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()


def contamination(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """One row per document: id, n_words, n_hit, n_items, items_sha256, contaminated (see find_matches)."""
    found, (n, hits, items, _) = find_matches(
        docs.select(F.col(id_col), F.col(options.get("text_col", "text"))), bench, **options
    )
    hit = F.aggregate(
        F.sequence(F.lit(0), F.greatest(F.size(hits) / 2 - 1, F.lit(0)).cast("int")),
        F.lit(0).cast("long"),
        lambda a, k: a + F.coalesce(F.get(hits, 2 * k + 1) - F.get(hits, 2 * k), F.lit(0)),
    )
    return found.select(
        F.col(id_col),
        F.col(n).alias("n_words"),
        hit.alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        (F.size(hits) > 0).alias("contaminated"),
    )


def decontaminate(docs: DataFrame, bench: DataFrame, **options) -> DataFrame:
    """The rows of docs, columns unchanged, in which no benchmark window occurs (see find_matches)."""
    found, (_, hits, *_) = find_matches(docs, bench, **options)
    return found.filter(F.size(hits) == 0).select(*docs.columns)
