"""SimHash near duplicates: fingerprints, deletion-variant index, verified links, components.

A 64-bit fingerprint is cut into two segments of 32 bits. Two fingerprints that differ in
at most 3 bits have a segment that differs in at most one, so both carry the same variant
of it with that one bit wild. Each distinct fingerprint is indexed under its 64 variants;
equal variants meet in one bucket and are verified. Copies share a fingerprint and are
represented once, so a group of exact copies costs one fingerprint, however large.

A bucket of more than ``bucket_rows`` fingerprints is cut further instead of being compared
whole: by the variants of 16-bit, then of 8-bit segments of the other half. Those of the
last level fix 53 bits, so a bucket there holds 2,048 fingerprints at most.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import drop, fresh, slices, utf8, working, written

SHINGLE, SEED, BITS_APART = 3, 42, 3
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_U = np.uint64


def fingerprint(text: bytes | None) -> int:
    """SimHash of a UTF-8 text over its 3-word shingles, repeats included; 0 where it has no words.

    Fewer than 3 words make one shingle of the whole sequence. A bit is 1 if it is set in over half the hashes.
    """
    words = text.translate(_LOWER).split() if text else ()
    if not words:
        return 0
    n = max(1, len(words) - SHINGLE + 1)
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(b" ".join(words[i : i + SHINGLE]), SEED) for i in range(n)), _U, n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        bits = np.unpackbits(hashes[at : at + (1 << 16)].astype(">u8").view(np.uint8)).reshape(-1, 64)
        ones += bits.sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp) of each row; fp holds the 64 bits as a signed long. Null and empty texts have fingerprint 0. Texts of any
    length are read whole: of a long one a task holds the words and 8 bytes for each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                fp = np.array([fingerprint(t) for t in utf8(part.column(1))], _U).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(fp)], ["id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, f"id {kind}, fp long"
    )


def hex_of(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _variants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The 64 one-wildcard variants of each fingerprint: k1 = segment, wild bit and the other 31 bits."""
    which = np.arange(64, dtype=_U)
    shift, wild = (which >> _U(5)) << _U(5), which & _U(31)
    keep = ~(_U(1) << wild)
    for batch in batches:
        for at in range(0, batch.num_rows, 8192):
            fp = batch.column(0)[at : at + 8192].to_numpy().view(_U)
            segment = (fp[:, None] >> shift) & _U(0xFFFFFFFF) & keep
            k1 = (which << _U(32)) | segment
            cols = [k1.ravel().view(np.int64), np.zeros(k1.size, np.int64), np.repeat(fp.view(np.int64), 64)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["k1", "k2", "fp"])


def _narrower(k1: np.ndarray, k2: np.ndarray, fp: np.ndarray) -> list[np.ndarray]:
    """Keys one level down. k2: level, then the choices and bits of the 16-bit and the 8-bit segment."""
    half = (fp >> np.where(k1 >> _U(37), _U(0), _U(32))) & _U(0xFFFFFFFF)  # the one that k1 doesn't hold
    top = k2 >> _U(60)
    out_k1, out_k2, out_fp = [], [], []
    for level, bits in ((0, 16), (1, 8)):
        at = np.flatnonzero(top == _U(level))
        if not len(at):
            continue
        rest = half[at]
        if level:  # the quarter that k2 doesn't hold
            rest = (rest >> np.where((k2[at] >> _U(40)) & _U(1), _U(0), _U(16))) & _U(0xFFFF)
        for part in range(2):
            piece = (rest >> _U(bits * part)) & _U((1 << bits) - 1)
            for wild in range(bits):
                mine = (_U(part) << _U(4 + bits)) | (_U(wild) << _U(bits)) | (piece & ~(_U(1) << _U(wild)))
                # level 1: bits 20-40 (part at 40); level 2 adds bits 0-12
                key = (_U(1) << _U(60)) | (mine << _U(20)) if not level else (_U(2) << _U(60)) | (k2[at] & _U((1 << 60) - 1)) | mine
                out_k1.append(k1[at])
                out_k2.append(np.broadcast_to(key, len(at)))
                out_fp.append(fp[at])
    return [np.concatenate(x).view(np.int64) for x in (out_k1, out_k2, out_fp)]


def _linked(k1: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Whether difference x makes a link that bucket k1 has to tell: each link is told by one bucket alone."""
    seg, wild = k1 >> _U(37), (k1 >> _U(32)) & _U(31)
    low, high = x & _U(0xFFFFFFFF), x >> _U(32)
    own = np.where(seg == 0, low, high)
    here = ((own == 0) & (wild == 0)) | (own == _U(1) << wild)
    return here & (np.bitwise_count(x) <= BITS_APART) & ((seg == 0) | (np.bitwise_count(low) > 1))


_LAST = _U(2) << _U(60)  # k2 of the last level starts here
_PAIRED = 16  # buckets up to this size are compared pair by pair at once, larger ones by search


def _compare(k1: np.ndarray, k2: np.ndarray, fp: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Links within each bucket of sorted rows: all of a small one, a spanning forest of a larger one."""
    new = np.flatnonzero(np.concatenate([[True], (np.diff(k1) != 0) | (np.diff(k2) != 0)]))
    size = np.diff(np.append(new, len(k1)))
    left, right = [], []
    of = np.repeat(size, size)
    small = np.flatnonzero((of > 1) & (of <= _PAIRED))
    s1, s2, sf = k1[small], k2[small], fp[small]
    for d in range(1, _PAIRED):
        if len(s1) <= d:
            break
        same = np.flatnonzero((s1[d:] == s1[:-d]) & (s2[d:] == s2[:-d]))
        if not len(same):
            break
        hit = same[_linked(s1[same], sf[same] ^ sf[same + d])]
        left.append(sf[hit])
        right.append(sf[hit + d])
    for at, n in zip(new[size > _PAIRED], size[size > _PAIRED], strict=True):
        todo, key = fp[at : at + n], k1[at]
        while len(todo):
            front, todo = [todo[0]], todo[1:]
            while front and len(todo):
                one = front.pop()
                near = _linked(key, todo ^ one)
                found = todo[near]
                left.append(np.full(len(found), one, _U))
                right.append(found)
                front.extend(found)
                todo = todo[~near]
    return left, right


def _buckets(bucket_rows: int):
    """Over rows sorted by (k1, k2): links (k1 null) and, of buckets too large to compare, the rows of the next level."""
    names = ["k1", "k2", "a", "b"]

    def links(left: list[np.ndarray], right: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        if left and (n := sum(map(len, left))):
            a, b = (pa.array(np.concatenate(x).view(np.int64)) for x in (left, right))
            yield pa.RecordBatch.from_arrays([pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), a, b], names)

    def deeper(k1: np.ndarray, k2: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(fp), 8192):
            x, y, z = _narrower(k1[at : at + 8192], k2[at : at + 8192], fp[at : at + 8192])
            yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y), pa.array(z), pa.nulls(len(z), pa.int64())], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, _U)] * 3
        hot = None  # the bucket that is being passed on
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [batch.column(k).to_numpy().view(_U) for k in range(3)]
            if hot is not None:
                more = (cols[0] == hot[0]) & (cols[1] == hot[1])
                yield from deeper(*(c[more] for c in cols))
                cols = [c[~more] for c in cols]
                if not len(cols[0]):
                    continue
                hot = None
            k1, k2, fp = held = [np.concatenate(x) for x in zip(held, cols, strict=True)]
            open_ = np.flatnonzero((k1 == k1[-1]) & (k2 == k2[-1]))[0]
            yield from done([c[:open_] for c in held])
            held = [c[open_:] for c in held]
            if len(held[0]) > bucket_rows and held[1][0] < _LAST:
                hot = (held[0][0], held[1][0])
                yield from deeper(*held)
                held = [np.zeros(0, _U)] * 3
        yield from done(held)

    def done(rows: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        k1, k2, fp = rows
        if not len(k1):
            return
        new = np.flatnonzero(np.concatenate([[True], (np.diff(k1) != 0) | (np.diff(k2) != 0)]))
        of = np.diff(np.append(new, len(k1)))
        large = np.repeat(of > bucket_rows, of) & (k2 < _LAST)
        if large.any():
            yield from deeper(*(c[large] for c in rows))
            k1, k2, fp = (c[~large] for c in rows)
        if len(k1):
            yield from links(*_compare(k1, k2, fp))

    return run


def links(distinct: DataFrame, bucket_rows: int = 4096) -> DataFrame:
    """(a, b): links between distinct fingerprints (one column, fp) that join the same ones as all links of 3 or fewer
    differing bits do. At most one link a row of the index is told in large buckets: their size never gets squared."""
    # few bytes become many: dealt out by number, not by size
    tasks = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = distinct.repartition(tasks, "fp").mapInArrow(_variants, "k1 long, k2 long, fp long")
    found = None
    for _ in range(3):
        told = written(
            rows.repartition("k1", "k2")
            .sortWithinPartitions("k1", "k2", "fp")
            .mapInArrow(_buckets(bucket_rows), "k1 long, k2 long, a long, b long"),
            "buckets",
        )
        here = told.filter("k1 IS NULL").select("a", "b")
        found = here if found is None else found.union(here)
        rows = told.filter("k1 IS NOT NULL").select("k1", "k2", F.col("a").alias("fp"))
        if rows.isEmpty():
            break
    return found


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of edges (a, b): root is the least node that can be reached.

    Large and small stars in turn until nothing changes. Each round's nodes and edges are written to the shared folder,
    so a join here reads plain exchanges, which Spark splits where one node has very many edges; they go when the next
    round is written.
    """
    edges = written(
        edges.select(F.least("a", "b").alias("v"), F.greatest("a", "b").alias("u")).filter("u <> v").distinct(), "edges"
    )
    seen = None
    while True:
        both = edges.unionByName(edges.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = written(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
        # large star: each node's larger neighbours go to its least one
        star = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        star = written(star, "large")
        old = [edges, least, star]
        # small star: a node and its smaller neighbours go to the least of them
        least = written(star.groupBy("u").agg(F.min("v").alias("m")), "least")
        joined = star.join(least, "u")
        edges = written(
            joined.filter("v <> m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v")))
            .distinct(),
            "small",
        )
        for df in (*old, least):
            drop(df)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    roots = edges.groupBy("u").agg(F.min("v").alias("root"))
    return roots.select(F.col("u").alias("node"), "root").union(
        roots.select(F.col("root").alias("node"), "root").distinct()
    )


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket_rows: int = 4096
) -> tuple[DataFrame, DataFrame]:
    """(rows, groups): rows has (id, fp) of each row of docs, groups (fp, rep, component, root) of each fingerprint.

    rep is the least id with that fingerprint, component the least id in its group, root the fingerprint that stands for
    the group. Null and empty texts have fingerprint 0 and are linked like any other. Null ids take part but are never
    rep or component unless the group has no other id (then both are null); repeated rows count once each in rows. An
    empty table gives empty results.
    """
    with working(docs.sparkSession) as keep:
        rows = keep(fingerprints(docs, id_col, text_col), "fingerprints")
        return rows, keep(_groups(rows, bucket_rows), "groups")


def _groups(rows: DataFrame, bucket_rows: int) -> DataFrame:
    """groups of near_duplicates, from its rows."""
    reps = written(rows.groupBy("fp").agg(F.min("id").alias("rep")), "reps")
    comp = written(components(links(reps.select("fp"), bucket_rows)), "components")
    linked = comp.join(reps, comp.node == reps.fp).groupBy("root").agg(F.min("rep").alias("component"))
    named = comp.join(linked, "root").select(F.col("node").alias("fp"), "root", "component")
    return reps.join(named, "fp", "left").select(
        "fp",
        "rep",
        F.when(F.col("root").isNull(), F.col("rep")).otherwise(F.col("component")).alias("component"),
        F.coalesce("root", "fp").alias("root"),
    )


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per row of docs: id, fingerprint (16 hex digits), component_id (see near_duplicates)."""
    rows, groups = near_duplicates(docs, id_col, text_col, **options)
    # groups grow with the documents: sorted, never broadcast; AQE splits a fingerprint of very many rows
    return rows.join(groups.select("fp", "component").hint("merge"), "fp").select(
        F.col("id").alias(id_col), hex_of(F.col("fp")).alias("fingerprint"), F.col("component").alias("component_id")
    )


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of docs, columns unchanged, that stand for their group: one of each, that with the least id and, where
    rows of other texts have that id too, the least fingerprint.

    Of repeated rows of that id and fingerprint one stays. A group without any id keeps one row, and null ids of other
    groups go.
    """
    rows, groups = near_duplicates(docs, id_col, text_col, **options)
    chosen = groups.filter("rep = component").groupBy("root").agg(F.min("component").alias("id"), F.min("fp").alias("fp"))
    times = rows.groupBy("id").agg(F.count("*").alias("n"))
    keep = written(chosen.join(times, "id").select("id", "fp", "n"), "keep")
    ident, fp, mine, root = fresh(docs, "keep_id", "keep_fp", "row_fp", "keep_root")
    # keep grows with the documents: sorted at every size, never broadcast
    once = keep.filter("n = 1").select(F.col("id").alias(ident)).hint("merge")
    out = docs.join(once, docs[id_col] == once[ident]).select(*docs.columns)
    again = keep.filter("n > 1").select(F.col("id").alias(ident), hex_of(F.col("fp")).alias(fp))
    if not again.isEmpty():
        ids = again.select(ident).distinct().hint("merge")
        repeated = docs.join(ids, docs[id_col] == ids[ident]).select(*docs.columns)
        repeated = _with_fingerprint(repeated, text_col, mine).join(again, (F.col(id_col) == F.col(ident)) & (F.col(mine) == F.col(fp)))
        out = out.unionByName(repeated.dropDuplicates([id_col, mine]).select(*docs.columns))
    nameless = groups.filter("component IS NULL").select(hex_of(F.col("fp")).alias(fp), F.col("root").alias(root))
    if not nameless.isEmpty():
        unnamed = _with_fingerprint(docs.filter(F.col(id_col).isNull()), text_col, fp).join(nameless, fp)
        out = out.unionByName(unnamed.dropDuplicates([root]).select(*docs.columns))
    return out


def _with_fingerprint(docs: DataFrame, text_col: str, name: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text_col):
                fp = pa.array([f"{fingerprint(t):016x}" for t in utf8(part.column(text_col))], pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns, fp], [*part.schema.names, name])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.StringType())]))
