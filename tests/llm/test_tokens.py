from __future__ import annotations

import math
import random

from tessera.llm import tokens


def brute(word, scores, longest):
    w = b" " + word
    best = [(0.0, 0)]
    for end in range(1, len(w) + 1):
        found = [
            (best[k][0] + scores[w[k:end]], best[k][1] - 1)
            for k in range(max(0, end - longest), end)
            if w[k:end] in scores
        ]
        best.append(max(found))
    return -best[-1][1]


TEXTS = [None, "", " \n", "a", "the the THE theme them", "naïve café 😀 x\x0by", "z" * 3000, "una città, 12:30 & more - don't", "é " * 2000]


def test_counts_as_by_brute_force_over_each_word(spark):
    rows = list(enumerate([*TEXTS, TEXTS[4]])) + [(None, "the")]
    df = spark.createDataFrame([(*r, 3) for r in rows], "doc_id long, text string, n_tokens int")
    scores = {p: s for p, s in tokens.pieces(tokens.VOCABULARY).items() if s is not None}
    longest = max(map(len, scores))
    want = []
    for i, t in rows:
        words = (t or "").encode().split()
        want.append((i, len(words), sum(brute(w, scores, longest) for w in words)))
    for held in (1 << 20, 1):
        assert sorted(map(tuple, tokens.counts(df, held_words=held).collect()), key=str) == sorted(want, key=str)


def test_random_words_over_a_small_vocabulary():
    rng = random.Random(6)
    scores = {bytes([b]): -math.log(b + 2) for b in b" ab"} | {b"ab": -5.0, b"aa": -4.5, b"bab": -6.0, b" a": -4.0, b"abab": -9.9}
    words = {"".join(rng.choice("ab") for _ in range(rng.randrange(1, 14))).encode() for _ in range(300)}
    trie = dict.fromkeys(p[:k] for p in scores for k in range(1, len(p))) | scores
    got = tokens.count_words(words, trie)
    assert got == {w: brute(w, scores, 4) for w in words}


def test_empty_table_and_clashing_columns(spark):
    df = spark.createDataFrame([], "doc_id long, text string, n_words int")
    out, names = tokens.token_counts(df)
    assert out.count() == 0 and names == ["_n_words", "n_tokens"]
