from __future__ import annotations

import random
import time
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tessera.functions import align, audio
from tessera.functions import text as tx
from tessera.operators import gates


def one(spark, column, **values):
    row = spark.range(1).select(*(F.lit(v).alias(k) for k, v in values.items())) if values else spark.range(1)
    return row.select(column.alias("x")).first()["x"]


def brute_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, before = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
    return row[-1]


def test_error_rates(spark):
    rng = random.Random(0)
    make = lambda: " ".join(rng.choice("abcdé") for _ in range(rng.randrange(12)))
    pairs = [("a b c", "a x c d"), ("", "a"), ("", ""), ("a", ""), ("a", "b c d")] + [(make(), make()) for _ in range(100)]
    pairs.append((" ".join(f"w{k}" for k in range(400)), " ".join(f"w{k}" for k in range(3, 403))))
    got = spark.createDataFrame(pairs, "r string, h string").select("r", "h", align.error_rate(F.col("r"), F.col("h")).alias("x"))
    for r, h, x in got.collect():
        a, b = r.split(), h.split()
        assert x == pytest.approx(brute_distance(a, b) / len(a) if a else float(bool(b)))
    assert [r.x for r in got.limit(5).collect()] == pytest.approx([2 / 3, 1, 0, 1, 3])


def test_alignment_goldens():
    words = [("w1", ["a", "b"]), ("w2", ["c"])]
    assert align.align(words, "a b x c".split()) == [("w1", 0, 2, 0.0), ("w2", 1, 1, 1.0)]
    assert align.align(words, "a b c x".split()) == [("w1", 0, 2, 0.0), ("w2", 1, 1, 1.0)]
    assert align.align(words, "a c".split()) == [("w1", 1, 2, 0.5), ("w2", 0, 1, 0.0)]
    assert align.align([], ["a"]) == [] and align.align([("w", [])], []) == [("w", 0, 0, 0.0)]


@given(st.lists(st.sampled_from("abc"), max_size=9), st.lists(st.sampled_from("abc"), max_size=9))
@settings(max_examples=200, deadline=None)
def test_aligned_edits_add_up_to_the_distance(a, b):
    words = [(t, [t]) for t in a]
    made = align.align(words, b)
    if words:
        assert sum(e for _, e, _, _ in made) == brute_distance(a, b)


def test_text_goldens(spark):
    assert one(spark, tx.normalize_basic(F.lit("L’oro,  È_1!"))) == "l oro è_1"
    assert one(spark, tx.phonemes(F.lit("ˈaːbˌ̩cˑ"))) == "abc"
    full = lambda s, lang: one(spark, tx.normalize_full(F.lit(s), F.lit(lang)))
    assert full("Il 3 per cento, alle 12:00: 1.000 città", "it") == "il 3 alle 12 1000 citta"
    assert full("Über 5 Prozent", "de") == "uber 5" and full("Über 5", "xx") == "über 5"
    assert tuple(one(spark, tx.parse_reason(F.lit("per=0.420 > 0.300")))) == ("per", 0.42, 0.3)
    assert tuple(one(spark, tx.parse_reason(F.lit("manual_audit")))) == ("wer", 0.0, 0.0)
    assert one(spark, tx.bucket_path(F.lit(29470), 9000, F.lit(29474))) == "wavs/027000-029474/029470.wav"
    assert one(spark, tx.bucket_path(F.lit(7), 0, F.lit(9))) == "wavs/000007.wav"
    assert one(spark, tx.bucket_path(F.lit(1234567), 0, F.lit(9))) == "wavs/1234567.wav"
    assert one(spark, tx.hhmmss(F.lit(3661.5))) == "01:01:01.500" and one(spark, tx.hhmmss(F.lit(59.9996))) == "00:01:00.000"
    assert one(spark, tx.index_list(F.lit("7, 13,"))) == [7, 13]
    assert one(spark, tx.diff_tokens(F.lit("l'oro, sì!"))) == ["l'oro", ",", "sì", "!"]
    zipped = one(spark, tx.zip_phonemes(F.lit("uno due"), F.lit("u n o\x1fd\x1fx")))
    assert [tuple(z) for z in zipped] == [("uno", "u n o"), ("due", "d")]


def test_folding_as_python_does(spark):
    import unicodedata

    texts = [None, "", "plain", "é ﬁn ½ Å ﷺ Ⅷ ｆｕｌｌ 𝒜 ß ø ñ", "a\u0301\u0323b", "漢字 ①②", *map(chr, range(0xA0, 0x250))]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", tx.fold_ascii(F.col("t")).alias("x")).collect()
    for r in rows:
        assert r.x == (r.t and unicodedata.normalize("NFKD", r.t).encode("ascii", "ignore").decode())


def test_folding_of_every_character(spark):
    import unicodedata

    one_, _, several = tx._folds()
    texts = [f"a{c}b" for c in one_ + several] + [several, one_ + "\U0001F600", "x" + several[-1]]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", tx.fold_ascii(F.col("t")).alias("x")).collect()
    assert len(rows) == len(texts) and "\U0001F110" in several
    for r in rows:
        assert r.x == unicodedata.normalize("NFKD", r.t).encode("ascii", "ignore").decode()


def seconds(df, column):
    df.select(column).limit(1).collect()  # compiled, workers started
    began = time.perf_counter()
    df.select(column.alias("x")).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def test_folding_costs_no_more_than_some_looking_up(spark):
    df = spark.range(400, numPartitions=1).select(F.repeat(F.lit("perché città lorem ipsum "), 200).alias("t")).cache()
    df.count()
    one_, to, _ = tx._folds()
    seconds(df, F.translate("t", one_, to))
    assert seconds(df, tx.fold_ascii(F.col("t"))) < 1 + 6 * seconds(df, F.translate("t", one_, to))  # it was over 30 times
    df.unpersist()


def test_spelling_hooks(spark):
    digits = lambda c, lang: F.when(lang == "en", F.regexp_replace(c, "3", " three ")).otherwise(c)
    row = spark.createDataFrame([("Only 3 cats", "en"), ("Solo 3 gatti", "it")], "t string, l string")
    got = [r.x for r in row.select(tx.normalize_full(F.col("t"), F.col("l"), (digits,)).alias("x")).collect()]
    assert got == ["only three cats", "solo 3 gatti"]
    marks = lambda c, lang: F.replace(c, F.lit("3"), F.lit("½ é"))
    got = [r.x for r in row.select(tx.normalize_full(F.col("t"), F.col("l"), (marks,)).alias("x")).collect()]
    assert got == ["only 12 e cats", "solo 12 e gatti"]


def test_labels_and_names(spark):
    assert one(spark, tx.seconds_label(F.lit(1.236))) == "1.24s" and one(spark, tx.seconds_label(F.lit(None).cast("double"))) == ""
    assert one(spark, tx.same_name(F.lit("Anna"), F.lit("aNNa"))) is True
    assert one(spark, tx.utc_now()).endswith("+00:00") and len(one(spark, tx.local_time(F.current_timestamp()))) == 19


def test_null_arrays_give_null(spark):
    df = spark.createDataFrame([(None, None, None), ([0.5] * 600, ["a"], "a")], "x array<float>, w array<string>, t string")
    pairs = F.transform("w", lambda w: F.struct(w.alias("word"), w.alias("phonemes")))
    rows = df.select(
        audio.trim_interval(F.col("x")).alias("i"), align.align_words(pairs, F.col("t")).alias("a"), align.word_diff(F.col("w"), F.col("w")).alias("d"),
        audio.low_band_ratio(F.col("x"), 8000).alias("b"),
    ).collect()
    assert tuple(rows[0].i or (None, None)) == (None, None) and rows[0].a is None and rows[0].d is None and rows[0].b is None
    assert tuple(rows[1].i) == (0, 600) and rows[1].a[0].per == 0.0 and rows[1].d[0].tag == "equal"


def test_alignment_over_many_kept_rows():
    rng = random.Random(8)
    ref, hyp = ([rng.choice("abcdefgh") for _ in range(n)] for n in (700, 650))
    made = align.align([(t, [t]) for t in ref], hyp)
    assert len(made) == 700 and sum(e for _, e, _, _ in made) == brute_distance(ref, hyp)


def peak_mb(f):
    tracemalloc.start()
    try:
        made = f()
        return made, tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_alignment_keeps_no_whole_matrix():
    rng = random.Random(9)
    ref, hyp = ([rng.choice("abcdefgh") for _ in range(2000)] for _ in range(2))
    made, peak = peak_mb(lambda: align.align([(t, [t]) for t in ref], hyp))
    assert len(made) == 2000 and peak < 8  # 2000 x 2000 costs are 16 MB


def test_batches_of_alignments_are_no_python_objects():
    text = " ".join(f"w{k}" for k in range(40))
    words = [{"word": w, "phonemes": w} for w in text.split()]
    batch = pa.array([words] * 1000), pa.array([text] * 998 + [None, ""])
    made, peak = peak_mb(lambda: align._aligned(*batch))
    assert len(made) == 1000 and made[998].as_py() is None and {e["edits"] for e in made[999].as_py()} == {1}
    assert made[0].as_py()[39] == {"word": "w39", "edits": 0, "n_tokens": 1, "per": 0.0}
    assert peak < 6  # 40,000 words as dictionaries are over 10 MB
    tokens = pa.array([text.split()] * 1000)
    made, peak = peak_mb(lambda: align._diffs(tokens, pa.array([text.split()[:-1]] * 999 + [None])))
    assert [s["tag"] for s in made[0].as_py()] == ["equal", "delete"] and made[999].as_py() is None and peak < 6


def test_words_and_chunks_are_split_once_a_row(spark):
    rows = [(None, "a"), ("uno  due", None), ("", "a"), ("uno due tre", "u\x1f\x1ft\x1fx")]
    zipped = tx.zip_phonemes(F.col("t"), F.col("p"))
    got = [r.z and [tuple(e) for e in r.z] for r in spark.createDataFrame(rows, "t string, p string").select(zipped.alias("z")).collect()]
    assert got == [None, [("uno", ""), ("due", "")], [], [("uno", "u"), ("due", ""), ("tre", "t")]]
    line = lambda n, times: spark.range(times, numPartitions=1).select(F.repeat(F.lit("uno "), n).alias("t"))
    flat = tx.flat_phonemes(tx.zip_phonemes(F.col("t"), F.array_join(tx.words(F.col("t")), "\x1f")))
    assert seconds(line(4000, 4), flat) < 2 + 8 * seconds(line(40, 400), flat)  # as many words in longer texts


def test_languages(spark):
    names = ["Italian", " it ", "haw", "Auto", "xx", "ZH", None]
    rows = spark.createDataFrame([(n,) for n in names], "n string").select(tx.language_code(F.col("n")).alias("c")).collect()
    assert [r.c for r in rows] == ["it", "it", None, None, None, "zh", None]
    with pytest.raises(PySparkException):
        one(spark, tx.checked_language_code(F.lit("auto")))


def test_nearest_rank(spark):
    for n, want in ((4, [2, 3, 3, 4]), (6, [2, 3, 5, 5])):
        values = F.array(*(F.lit(float(k)) for k in range(1, n + 1)))
        assert [one(spark, gates.nearest_rank(values, p)) for p in (0.25, 0.5, 0.75, 0.9)] == want
    df = spark.createDataFrame([(float(k % 5),) for k in range(23)] + [(None,)], "v double")
    s = sorted(float(k % 5) for k in range(23))
    row = gates.calibration(df, "v", 0.3).first()
    assert (row["count"], row["min"], row["max"]) == (23, 0.0, 4.0)
    assert [row[q] for q in ("p25", "median", "p75", "p90")] == [s[round(p * 22)] for p in (0.25, 0.5, 0.75, 0.9)]
    empty = gates.calibration(df.limit(0), "v", 0.3).first()
    assert [empty[c] for c in ("count", "min", "p25", "median", "p75", "p90", "max", "mean")] == [0] * 8


def tone(hertz, seconds, rate, level=0.5):
    return level * np.sin(2 * np.pi * hertz * np.arange(int(rate * seconds)) / rate)


def test_waveform_kernels():
    rate = 22050
    assert audio.low_band(tone(200, 0.2, rate), rate) > 0.8 > 0.2 > audio.low_band(tone(2000, 0.2, rate), rate)
    assert audio.low_band(np.zeros(100), rate) == 0 and audio.low_band(np.ones(1), rate) == 0
    x = np.concatenate([np.zeros(8192), tone(440, 0.5, rate), np.zeros(16384)])
    start, end = audio.loud_part(x)
    assert abs(start - 8192) <= 2048 and abs(end - 8192 - 11025) <= 2048
    assert len(audio.trim_silence(x, rate)) == min(len(x), end + 2646) - start + 1764
    assert audio.loud_part(np.zeros(5000)) == (0, 0)
    assert abs(audio.loudness(tone(997, 3, 48000, 1.0), 48000) + 3.01) < 0.1  # the standard's reference level
    assert audio.loudness(np.zeros(48000), 48000) == -np.inf
    y = audio.resample(tone(440, 0.5, 48000).astype(np.float32), 48000, rate)
    want = tone(440, 0.5, rate)
    assert len(y) == len(want) and np.abs(y[200:-200] - want[200:-200]).max() < 0.01
    stereo = np.stack([tone(440, 1, 48000), np.zeros(48000)], axis=1)
    out = audio.normalize(stereo, 48000)
    assert np.abs(out).max() == pytest.approx(0.99)
    back, r = audio.read_wav(audio.write_wav(out, rate))
    assert r == rate and np.abs(back - out).max() < 1e-3


def test_signal_columns(spark):
    row = spark.createDataFrame([([0.5, -1.0, 0.25],), ([],), ([0.0],)], "x array<float>")
    x = F.col("x")
    got = row.select(audio.peak(x), audio.crest(x), audio.clip_fraction(x), audio.duration(x, 2), audio.peak_normalize(x)).collect()
    assert got[0][0] == 1.0 and got[0][1] == pytest.approx(1 / np.sqrt(1.3125 / 3)) and got[0][2] == pytest.approx(1 / 3)
    assert list(got[0][4]) == pytest.approx([0.495, -0.99, 0.2475])
    assert tuple(got[1])[:4] == (0, 0, 0, 0) and list(got[2][4]) == [0.0]
