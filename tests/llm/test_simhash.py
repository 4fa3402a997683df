from __future__ import annotations

import re

import numpy as np
import xxhash

from tessera.llm import simhash


def brute_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(values, links):
    parent = {v: v for v in values}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {v: find(v) for v in values}


def brute_groups(fps):
    fps = sorted(set(fps))
    return groups(fps, [(a, b) for i, a in enumerate(fps) for b in fps[i:] if (a ^ b).bit_count() <= 3])


TEXTS = [None, "", " \t\n", "One", "one TWO", "a b c", "A  b\tc d", "é É x y", "x " * 500, "w\x0b\x0cz " * 3]


def test_fingerprint_as_by_hand():
    for t in TEXTS:
        assert simhash.fingerprint(t.encode() if t is not None else None) == brute_fingerprint(t)


def fingerprint_cloud():
    """A dense cloud around one value, chains, and values far from all others."""
    rng = np.random.default_rng(5)
    centre = int(rng.integers(0, 2**63))
    out = [centre]
    for _ in range(400):
        v = centre
        for b in rng.integers(0, 64, rng.integers(1, 6)):
            v ^= 1 << int(b)
        out.append(v)
    v = int(rng.integers(0, 2**63))
    for _ in range(12):
        for b in rng.choice(64, 3, replace=False):
            v ^= 1 << int(b)
        out.append(v)
    return [*out, *map(int, rng.integers(0, 2**63, 60)), 0, 7, 2**64 - 1]


def check_links(spark, fps, **options):
    signed = [(int(np.uint64(f).view(np.int64)),) for f in set(fps)]
    edges = simhash.links(spark.createDataFrame(signed, "fp long"), **options)
    rows = [(a % 2**64, b % 2**64) for a, b in edges.collect()]
    assert all((a ^ b).bit_count() <= 3 for a, b in rows)
    assert groups(set(fps), rows) == brute_groups(fps)
    return len(rows)


def test_links_join_what_all_pairs_join(spark):
    check_links(spark, fingerprint_cloud())


def test_large_buckets_are_cut_further(spark):
    check_links(spark, fingerprint_cloud(), bucket_rows=6)


def test_components_are_those_of_the_graph(spark):
    rng = np.random.default_rng(1)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (180, 2))] + [(k, k + 1) for k in range(1000, 1060)]
    edges += [(2000, 2000 + k) for k in range(1, 200)]
    got = {r.node: r.root for r in simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = {x for a, b in edges for x in (a, b) if a != b}
    assert got == groups(nodes, [e for e in edges if e[0] != e[1]])


LONG = "the quick brown fox jumps over a lazy dog and then it goes on for a while in other words " * 30


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, fp string, root int")


ROWS = [(k, t, "x", k) for k, t in enumerate(TEXTS, 10)] + [
    (5, LONG, None, 1),
    (6, LONG + "end", None, 1),
    (6, LONG + "end", None, 1),
    (7, LONG.upper(), None, None),
    (None, LONG, "n", 2),
    (None, "nobody else says this at all", None, None),
    (None, "nobody else says this at all", None, None),
]


def test_classes_as_by_brute_force(spark):
    got = sorted(map(tuple, simhash.classes(table(spark, ROWS)).collect()), key=str)
    fps = [brute_fingerprint(t) for _, t, *_ in ROWS]
    root = brute_groups(fps)
    ids = {}
    for (i, *_), f in zip(ROWS, fps, strict=True):
        if i is not None:
            ids[root[f]] = min(i, ids.get(root[f], i))
    assert got == sorted(((i, f"{f:016x}", ids.get(root[f])) for (i, *_), f in zip(ROWS, fps, strict=True)), key=str)


def test_one_of_each_group_stays(spark):
    got = simhash.deduplicate(table(spark, ROWS))
    assert got.columns == ["doc_id", "text", "fp", "root"]
    rows = [tuple(r) for r in got.collect()]
    want = {r.component_id for r in simhash.classes(table(spark, ROWS)).collect()}
    assert sorted(r[0] for r in rows if r[0] is not None) == sorted(want - {None})
    assert [r[1] for r in rows if r[0] is None] == ["nobody else says this at all"]


def test_repeated_ids_of_different_texts_each_stand_for_their_group(spark):
    rows = [(3, "a b c d e f g", None, 1), (3, "a b c d e f g", None, 1), (3, "quite another text it is", None, 1), (4, "A b c d e f g", None, 1)]
    got = sorted(r.text for r in simhash.deduplicate(table(spark, rows)).collect())
    assert got == ["a b c d e f g", "quite another text it is"]


def test_repeated_rows_leave_one(spark):
    assert simhash.deduplicate(table(spark, [(3, "a b c d", None, 1)] * 4)).count() == 1


def test_empty_table(spark):
    assert simhash.classes(table(spark, [])).count() == 0
    assert simhash.deduplicate(table(spark, [])).count() == 0
