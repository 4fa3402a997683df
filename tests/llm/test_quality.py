from __future__ import annotations

import re

import duckdb

from tessera.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    twice = {w for w in windows if windows.count(w) > 1}
    hit = {k for i, w in enumerate(windows) if w in twice for k in range(i, i + 5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(words) < 10 or 100 * len(hit) > 20 * len(words)
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(hit), failed


TEXTS = [
    None, "", " \n\t", "a b c d e f g h i", "a b c d e f g h i j", "x y z v w " * 3, "one\ntwo\none\n one\none\r\n", "é 😀 \x85 \xa0 " * 6,
    "# * $ % & | < >\n" * 4, "a b c d e a b c d e " + " ".join(map(str, range(60))), "w " * 400, " ".join(f"w{k}" for k in range(900)),
]


def labelled(data):
    return duckdb.sql(
        f"SELECT text, quality FROM '{data}/documents.parquet' JOIN '{data}/labels.parquet' USING (doc_id) ORDER BY doc_id"
    ).fetchall()


def test_base_columns_as_by_brute_force(spark, data):
    docs = [*TEXTS, *(t for t, _ in labelled(data)[:40])]
    rows = quality.judge([(t or "").encode() for t in docs], quality.NEUTRAL, 0.5)
    for t, r in zip(docs, rows, strict=True):
        assert r[:6] == brute(t)
        assert r[6] == (not r[5])  # the neutral model keeps what the base rules don't reject


def junk(line):
    """Whether the generator of the tables made a line as symbols, a table or shouting."""
    w = line.split()
    marked = sum(x.endswith((b"***", b"###", b"$$$", b"%%%", b"&&&", b"!!")) for x in w)
    return line.count(b" | ") > 2 or 2 * marked > len(w)


def halves():
    rows = [(t.encode(), q) for t, q in labelled("/root/testdata/sf0.01")]
    chunks = [c for k, (t, q) in enumerate(rows[::2]) for c in quality.chunks_of(t, k, q)]
    return quality.train(chunks), rows[1::2]


def test_held_out_accuracy_of_texts_and_lines():
    model, rows = halves()
    judged = quality.judge([t for t, _ in rows], model, 0.5)
    told = [(q, r[6]) for (_, q), r in zip(rows, judged, strict=True) if not r[5]]
    assert sum(q == kept for q, kept in told) / len(told) > 0.95
    assert all(kept for q, kept in told if q)  # clean texts stay
    passed = [t for (t, _), r in zip(rows, judged, strict=True) if not r[5]]
    lines = quality.line_labels(passed, model)
    right = [y == (not junk(line)) for text in lines for line, y in text]
    assert sum(right) / len(right) > 0.97
    assert any({y for _, y in text} == {0, 1} for text in lines)  # labels are of lines, not of texts


def test_boilerplate_inside_a_good_text_is_marked_and_only_it():
    model, rows = halves()
    good = [t for t, q in rows if q and t.count(b"\n") >= 4][:10]
    menu = [b"Home | News | Sport | Mail | Shop | About | Help | Terms", b"### *** Login *** ### $$$ Register $$$ ### %%% |"]
    for text in good:
        lines = text.split(b"\n")
        (labels,) = quality.line_labels([b"\n".join([*lines[:2], *menu, *lines[2:]])], model)
        assert [line for line, y in labels if not y] == menu
        assert quality.judge([b"\n".join([*lines[:2], *menu, *lines[2:]])], model, 0.5)[0][6]
        (labels,) = quality.line_labels([b"\n".join([*lines[:2], b"Another line of plain words as they are.", *lines[2:]])], model)
        assert all(y for _, y in labels)


def test_long_texts_are_sampled_over_their_length():
    text = b"\n".join(b"line %d of %d %s" % (k, k, b"$$$" if k > 900 else b"words") for k in range(1000))
    chunks = quality.chunks_of(text, 0, 1)
    assert len(chunks) == 12 and all(len(c.lines) == 32 for c in chunks)
    assert len({c.lines.tobytes() for c in chunks}) == 2  # early and late ones
    assert quality.chunks_of(b"too short", 0, 1) == []


def test_sample_is_bounded_and_repeats_itself(spark, data):
    docs, labels = (spark.read.parquet(f"{data}/{t}.parquet") for t in ("documents", "labels"))
    one, two = (quality.labelled_sample(docs.union(docs), labels.union(labels), 20) for _ in range(2))
    assert len({c.text for c in one}) <= 20 and {c.quality for c in one} <= {0, 1}
    assert [(c.text, c.lines.tobytes()) for c in one] == [(c.text, c.lines.tobytes()) for c in two]


def test_base_counts_as_by_sql(spark, data):
    got = quality.base_counts(spark.read.parquet(f"{data}/documents.parquet"))
    documents = duckdb.read_parquet(f"{data}/documents.parquet")  # noqa: F841
    want = duckdb.sql(quality.SQL)
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())


def test_viterbi_finds_the_best_labels():
    import itertools

    import numpy as np

    rng = np.random.default_rng(0)
    for n in range(1, 7):
        model = quality.LineModel(quality.NEUTRAL.weights, rng.normal(size=(2, 2)), rng.normal(size=2))
        scores = rng.normal(size=(n, 2))

        def total(y, model=model, scores=scores):
            moves = sum(model.moves[a, b] for a, b in itertools.pairwise(y))
            return model.start[y[0]] + moves + sum(scores[k, v] for k, v in enumerate(y))

        assert tuple(model.decode(scores)) == max(itertools.product((0, 1), repeat=n), key=total)
    assert model.decode(np.zeros((0, 2))) == []


def test_columns_nulls_repeats_and_no_labels(spark):
    rows = [(k % 5 if k else None, t, "own", True) for k, t in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string, n_words boolean")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = quality.verdicts(docs, none)
    assert got.columns == ["doc_id", *quality.NAMES]
    assert sorted(r.n_words for r in got.collect()) == sorted(brute(t)[0] for t in TEXTS)
    out = quality.keep_good(docs, none)
    assert out.columns == docs.columns and out.count() == sum(not brute(t)[5] for t in TEXTS)
    some = spark.createDataFrame([(1, 1, 0), (2, None, 0), (None, 0, 0), (3, 0, 1)], "doc_id long, quality int, toxic int")
    assert quality.verdicts(docs, some).count() == len(TEXTS)
    assert quality.verdicts(docs.limit(0), some).count() == 0
