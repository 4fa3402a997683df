from __future__ import annotations

import random
import re

import pytest

from tessera.llm import mixing


def brute_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: mixing.WEIGHTS[k % 3] for k, s in enumerate(order)}
    total = sum(sizes.values()) * mixing.SHARE
    capped = set()
    while True:
        rest = total - sum(2 * sizes[s] for s in capped)
        open_ = [s for s in order if s not in capped]
        share = {s: rest * weight[s] / sum(weight[o] for o in open_) for s in open_}
        over = {s for s in open_ if share[s] > 2 * sizes[s] + 1e-9}
        if not over:
            return {s: 2.0 * sizes[s] for s in capped} | share
        capped |= over


def rows_of(n, sources, seed=1):
    rng = random.Random(seed)
    return [(k, " ".join(["w"] * rng.randrange(0, 40)), rng.choice(sources), 9) for k in range(n)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string, size int")


def check(spark, rows, **options):
    out = mixing.mix(frame(spark, rows), **options).collect()
    assert len(out) == len(rows)
    sizes, source = {}, {}
    for i, t, s, _ in rows:
        n = len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
        sizes[s] = sizes.get(s, 0) + n
        source[i] = s
    want = brute_targets(sizes)
    taken = dict.fromkeys(sizes, 0)
    partial = dict.fromkeys(sizes, 0)
    for r in out:
        s = source[r.doc_id]
        assert r.source_size == sizes[s] and r.target == pytest.approx(want[s])
        assert 0 <= r.taken <= 2 * r.size
        taken[s] += r.taken
        partial[s] += r.size > 0 and r.taken % r.size > 0
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 0.5 + 1e-6
        assert partial[s] <= 1
    return sorted(map(tuple, out), key=str)


def test_a_share_of_most_or_more_takes_all_there_is(spark):
    rows = rows_of(60, ["a", "b", None])
    for share in (2.0, 2.5, 9.0):
        for r in mixing.mix(frame(spark, rows), share=share).collect():
            assert r.taken == 2 * r.size and r.target == 2.0 * r.source_size


def test_as_many_sources_as_documents(spark):
    rows = [(k, "w " * (k % 7 + 1), f"host{k}", 1) for k in range(90)]
    check(spark, rows)


def test_sources_come_to_their_targets(spark):
    rows = rows_of(700, ["a", "b", "c", "d", "é", None])
    rows += [(5000, None, "a", 1), (5001, "", "b", 1), (5002, " \t", None, 1), (5003, "long " * 20000, "c", 1)]
    assert check(spark, rows) == check(spark, list(reversed(rows)))


def test_a_tree_of_many_levels(spark):
    check(spark, rows_of(300, ["only", "other"]), chunk=4)


def test_hot_source_and_single_documents(spark):
    check(spark, rows_of(200, ["hot"] * 9 + ["x"]) + [(7000, "one two three", "lone", 1), (7001, "", "void", 1)])


def test_repeated_rows_and_null_ids_share_copies(spark):
    rows = [(1, "a b c", "s", 0)] * 10 + [(None, "a b", "s", 0)] * 7 + [(2, "x " * 50, "t", 0)]
    out = mixing.mix(frame(spark, rows)).collect()
    assert len(out) == 18 and all(r.taken <= 2 * r.size for r in out)
    copies = [r.taken for r in out if r.doc_id == 1]
    assert max(copies) - min(copies) <= 3


def test_expected_copies_are_kept(spark):
    """Over many seeds a document is taken as often as its source's target says."""
    rows = [(k, "w " * (k % 5 + 1), s, 0) for k in range(12) for s in ("a", "b", "c") if k % 3 == "abc".index(s)]
    total, times = {}, 3
    for seed in range(times):
        for r in mixing.mix(frame(spark, rows), seed=seed).collect():
            total[r.doc_id] = total.get(r.doc_id, 0) + r.taken / r.size / (r.target / r.source_size)
    assert sum(total.values()) / len(total) / times == pytest.approx(1, abs=0.2)


def test_empty_table(spark):
    assert mixing.mix(frame(spark, [])).count() == 0
