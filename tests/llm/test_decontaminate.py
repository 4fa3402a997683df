from __future__ import annotations

import hashlib
import random
import re

from tessera.llm import decontaminate as d

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORDS.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def brute(text, items, window=10):
    w, hit, found, longest = words(text), set(), set(), 0
    for item, t in items:
        x = words(t)
        if not x:
            continue
        n = min(window, len(x))
        for i in range(len(x) - n + 1):
            for j in range(len(w) - n + 1):
                if w[j : j + n] == x[i : i + n]:
                    hit.update(range(j, j + n))
                    found.add("" if item is None else str(item))
                    m = n
                    while n == window and i + m < len(x) and j + m < len(w) and x[i + m] == w[j + m]:
                        m += 1
                    longest = max(longest, m)
    ids = ",".join(sorted(found))
    return len(w), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit), longest


def cases():
    rng = random.Random(3)
    vocabulary = ["a", "b", "é", "Zz", "9", "word"]
    text = lambda n: rng.choice([" ", "-", "\n"]).join(rng.choice(vocabulary) for _ in range(n))
    items = [(k, text(n)) for k, n in enumerate([30, 12, 10, 9, 11, 25])] + [(90, "!?"), (91, None), (92, ""), (1, "other words")]
    items += [(93, "Tiny"), (94, items[0][1]), (None, "null item text")]
    docs = [text(rng.randrange(60)) for _ in range(60)] + [None, "", "...", "tiny TINY", "x null item Text y"]
    docs += [f"{text(20)} x {i} y {text(5)}" for _, i in items[:6]] + [items[0][1] * 3, text(3000)]
    return list(enumerate(docs)) + [(None, items[1][1]), (0, docs[0])], items


def frame(spark, docs):
    return spark.createDataFrame([(i, t, 7, "h") for i, t in docs], "doc_id long, text string, n_words int, hits string")


def columns(r):
    return (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated)


def test_all_rows_as_by_brute_force(spark):
    docs, items = cases()
    bench = spark.createDataFrame(items, "item_id long, text string")
    for options in ({}, {"shard_words": 40}, {"block_bytes": 60}):
        got = d.contamination(frame(spark, docs), bench, **options).collect()
        want = [(i, *brute(t, items)[:5]) for i, t in docs]
        assert sorted(((r.doc_id, *columns(r)) for r in got), key=str) == sorted(want, key=str)
        found, names = d.find_matches(frame(spark, docs), bench, **options)
        lengths = sorted(((r.doc_id, r[names[3]]) for r in found.collect()), key=str)
        assert lengths == sorted(((i, brute(t, items)[5]) for i, t in docs), key=str)


def test_five_million_words_and_several_blocks(spark):
    rng = random.Random(5)
    words = [f"w{k}" for k in range(5000)]
    items = [(k, " ".join(rng.choice(words) for _ in range(200))) for k in range(40)]
    body = rng.choices(words, k=5_000_000)
    want = 0
    for n, (k, length) in enumerate(((3, 200), (17, 25), (39, 10), (8, 120))):
        at = (1 << 20) * (n + 1) - 7  # across the ends of shards
        body[at : at + length] = items[k][1].split()[:length]
        want += length
    docs = spark.createDataFrame([(0, " ".join(body)), (1, "x" * (5 << 20) + " " + items[5][1])], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: r for r in d.contamination(docs, bench, block_bytes=10_000).collect()}
    assert (got[0].n_words, got[0].n_hit, got[0].n_items) == (5_000_000, want, 4)
    assert (got[1].n_words, got[1].n_hit, got[1].n_items) == (201, 200, 1)
    found, names = d.find_matches(docs, bench, block_bytes=10_000)
    assert sorted(r[0] for r in found.select(names[3]).collect()) == [200, 200]


def test_longest_match_goes_on_through_repeated_words():
    for text, item in (("a " * 400, "a " * 150), ("x " + "a b " * 60 + "a a", "a b " * 31 + "c"), ("a " * 30, "b " + "a " * 25 + "a")):
        bench = d.Benchmark([("1", item.encode()), ("2", b"a " * 11)], 10)
        found = [d._Found()]
        d._match([d.numbers_of(text.encode(), bench.vocab.get)], found, bench, 64)
        assert found[0].longest == brute(text, [("1", item), ("2", "a " * 11)])[5]


def test_clean_rows_stay_with_their_columns(spark):
    docs, items = cases()
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = d.decontaminate(frame(spark, docs), bench)
    assert got.columns == ["doc_id", "text", "n_words", "hits"]
    want = [(i, t, 7, "h") for i, t in docs if not brute(t, items)[4]]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_empty_tables(spark):
    docs, items = cases()
    none = spark.createDataFrame([], "item_id long, text string")
    assert d.decontaminate(frame(spark, docs), none).count() == len(docs)
    assert d.contamination(frame(spark, []), spark.createDataFrame(items, "item_id long, text string")).count() == 0
