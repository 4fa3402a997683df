from __future__ import annotations

import os
import random

import numpy as np
import pytest
from pyspark.errors import PySparkException

from tessera.functions import audio
from tessera.operators import audit, gates, release, state, words
from tessera.sources import clips, corpus, sidecars, tables
from tessera import storage
from tessera.storage import numbered, percent_ranked, running_total


def test_numbering_and_ranks(spark):
    rng = random.Random(0)
    values = [rng.randrange(40) for _ in range(500)]
    df = spark.createDataFrame(list(enumerate(values)), "k long, v long")
    got = {r.k: r.n for r in numbered(df, ["v", "k"], "n").collect()}
    order = sorted(range(500), key=lambda k: (values[k], k))
    assert got == {k: n for n, k in enumerate(order)}
    ranks = {r.k: r.r for r in percent_ranked(df, {"v": "r"}).collect()}
    assert ranks == pytest.approx({k: sum(x < v for x in values) / 499 for k, v in enumerate(values)})
    assert percent_ranked(df.limit(1), {"v": "r"}).first().r == 0.0
    small = spark.createDataFrame([(0.1,), (0.2,), (0.2,), (0.5,)], "v double")
    assert sorted(r.r for r in percent_ranked(small, {"v": "r"}).collect()) == pytest.approx([0, 1 / 3, 1 / 3, 1])
    assert running_total(df.limit(0), ["k"], df["v"], "t").count() == 0


def test_ranks_of_several_signals_at_once(spark):
    rng = random.Random(1)
    rows = [(k, rng.choice([None, *map(float, range(9))]), rng.random()) for k in range(300)]
    df = spark.createDataFrame(rows, "idx long, a double, b double")
    low = lambda v: float("-inf") if v is None else v
    for key in (None, "idx"):
        got = {r.idx: (r.ra, r.rb) for r in percent_ranked(df, {"a": "ra", "b": "rb"}, key).collect()}
        for k, a, b in rows:
            want = [sum(low(x[n]) < low(v) for x in rows) / 299 for n, v in ((1, a), (2, b))]
            assert got[k] == pytest.approx(want)
    assert percent_ranked(df.limit(0), {"a": "ra"}).count() == 0


def test_tables_need_a_shared_folder_and_go_when_done(spark):
    class Elsewhere:
        applicationId, master = "app-1", "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)

    class Session:
        sparkContext = Elsewhere()

        class conf:
            get = staticmethod(lambda name, default: default)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        storage.shared_dir(Session())
    folder = storage.shared_dir(spark)
    names = lambda: {f.split("-")[0] for f in os.listdir(folder)}
    storage.clear(spark)
    with storage.working(spark) as keep:
        with storage.working(spark) as inner:
            storage.written(spark.range(3), "lost")
            told = inner(spark.range(4), "told")
        assert names() == {"told"} and told.count() == 4
        kept = keep(told.filter("id > 1"), "kept")
    assert names() == {"kept"} and kept.count() == 2
    storage.drop(kept)
    assert names() == set()
    with pytest.raises(ValueError), storage.working(spark):
        storage.written(spark.range(3), "lost")
        raise ValueError
    assert names() == set()


def test_composite_score():
    ranks = {"per_pitch": 1, "per": 0, "lf_burst": 1, "crest": 0}
    assert sum(audit.COMPOSITE[k] * v for k, v in ranks.items()) == pytest.approx(0.65)


def test_corpus_scan(spark, tmp_path):
    (tmp_path / "c.txt").write_bytes("# c\n\n a \n  # kept\nb\r\nc".encode())
    got = [tuple(r) for r in corpus.read_corpus(spark, str(tmp_path / "c.txt")).orderBy("idx").collect()]
    assert got == [(0, "a"), (1, "# kept"), (2, "b"), (3, "c")]


def test_corpus_of_several_files_and_blocks(spark, tmp_path):
    want = []
    for name, n in (("a.txt", 4000), ("b.txt", 30), ("c.txt", 0)):
        lines = [f"line {k} of {name}" if k % 5 else "# no" for k in range(n)]
        want += [x for x in lines if x[0] != "#"]
        (tmp_path / name).write_text("\n".join(lines))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        got = corpus.read_corpus(spark, str(tmp_path))
        rows = got.orderBy("idx").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r.idx for r in rows] == list(range(len(want))) and [r.text for r in rows] == want


def test_gate_is_inclusive_and_total(spark):
    df = spark.createDataFrame([(1, 0.25), (2, 0.3), (3, None)], "idx long, wer double")
    rows = {r.idx: (r.accepted, r.reason) for r in gates.gate(df, "wer", 0.25, "wer").collect()}
    assert rows == {1: (True, ""), 2: (False, "wer=0.300 > 0.250"), 3: (False, "asr_error")}
    looser = gates.gate(df, "wer", 0.3, "wer").filter("accepted").count()
    assert looser >= 1


def test_splits(spark):
    assert release.shuffled_positions(21, 42, 0.1) == [5, 19]
    assert release.shuffled_positions(5, 42, 0.1) == [3] and release.shuffled_positions(25, 42, 0.1) == [12, 16]
    assert release.shuffled_positions(1, 42, 0.1) == []
    df = spark.range(100).withColumnRenamed("id", "idx")
    one, two = release.split(df, 1, 0.1), release.split(df.repartition(7), 1, 0.1)
    val = lambda x: {r.idx for r in x.filter("split = 'val'").collect()}
    assert val(one) == val(two) and len(val(one)) == 10 and val(one) != val(release.split(df, 2, 0.1))
    assert val(release.split_shuffled(spark.range(21).withColumnRenamed("id", "idx"), 42, 0.1)) == {5, 19}


def test_merge(spark):
    first = spark.createDataFrame([(0, "a", "train"), (2, "b", "val"), (5, "c", "train")], "idx long, text string, split string")
    second = spark.createDataFrame([(1, "x"), (9, "y")], "idx long, text string")
    rows = {r.text: (r.idx, r.split, r.path) for r in release.merged(first, second).collect()}
    assert rows["x"][:2] == (6, "train") and rows["y"][0] == 7 and rows["y"][2] == "wavs/000000-000007/000007.wav"
    check = release.integrity(first, second).first()
    assert (check.n_metadata, check.n_clips, check.only_metadata, check.only_clips) == (3, 2, 3, 2)
    assert release.overlap(first, second.unionByName(spark.createDataFrame([(3, "a")], "idx long, text string"))).count() == 1


def test_checked_merge(spark, tmp_path):
    first = spark.createDataFrame([(0, "a", "train"), (2, "b", "val")], "idx long, text string, split string")
    second = spark.createDataFrame([(1, "x"), (9, "y")], "idx long, text string")
    out = release.merge(first, second, str(tmp_path / "m"))
    assert {(r.idx, r.text) for r in out.collect()} == {(0, "a"), (2, "b"), (3, "x"), (4, "y")}
    shared = spark.createDataFrame([(1, "a")], "idx long, text string")
    with pytest.raises(ValueError, match="both archives"):
        release.merge(first, shared, str(tmp_path / "n"))
    assert release.merge(first, shared, str(tmp_path / "n"), allow_overlap=True).count() == 3
    with pytest.raises(ValueError, match="not whole"):
        release.merge(first, second.unionByName(second), str(tmp_path / "o"))
    with pytest.raises(ValueError, match="only_metadata"):
        release.merge(first, second, str(tmp_path / "o"), clips=(first, second.limit(1)))
    state.check_complete(first, first, "idx")
    with pytest.raises(ValueError, match="missing idx: 1, 9"):
        state.check_complete(second, first, "idx")


def test_state_and_progress(spark):
    queue = spark.createDataFrame([(4, 0), (1, 1), (3, 2)], "idx long, place long")
    decided = spark.createDataFrame([(4, "bad")], "idx long, action string")
    row = state.progress(queue, decided, "idx", ["place"], "action", "bad").first()
    assert (row.total, row.decided, row.bad, row.first_pending) == (3, 1, 1, 1)
    events = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "c", 1)], "k long, x string, seq long")
    now = state.state(events, ["k"], ["seq"])
    again = state.state(now.unionByName(events), ["k"], ["seq"])
    assert sorted(map(tuple, now.collect())) == sorted(map(tuple, again.collect())) == [(1, "b", 2), (2, "c", 1)]
    assert state.pending(queue, queue, "idx").count() == 0
    assert {r.idx for r in state.upsert(queue, queue.filter("idx = 1"), "idx").collect()} == {1, 3, 4}


def test_word_stats(spark):
    rows = spark.createDataFrame([("a", 0.0), ("a", 1.0), ("a", 0.5), ("a", 0.5), ("b", 1.0), ("c", 0.0)], "word string, per double")
    stats = words.word_stats(rows)
    got = {r.word: tuple(r)[1:] for r in stats.collect()}
    assert got["a"] == (4, 0.5, 0.0, 1.0, 0.5) and got["b"] == (1, 1.0, 1.0, 1.0, 1.0)
    assert [r.word for r in words.worst_words(stats, 1).collect()] == ["b", "a"]
    assert tuple(words.word_summary(stats).first()) == (3, 1, 1, 1)
    text = words.text_report(stats, words.word_summary(stats))
    assert "unique_words" in text and "b                              1   1.0000   1.0000" in text
    aligned = spark.createDataFrame([("a", 1), ("b", 0)], "word string, n_tokens int")
    assert [r.word for r in words.with_tokens(aligned).collect()] == ["a"]


def test_word_report_and_medians_of_many_values(spark, tmp_path):
    rng = random.Random(2)
    rows = [(rng.choice("xyz"), rng.random()) for _ in range(3000)] + [("x", 0.5)] * 500
    stats = words.word_stats(spark.createDataFrame(rows, "word string, per double"))
    for r in stats.collect():
        v = sorted(p for w, p in rows if w == r.word)
        assert r.occurrences == len(v) and r.median_per == pytest.approx(v[round((len(v) - 1) / 2)], abs=1e-4)
    words.word_report(stats, str(tmp_path / "r"))
    lines = [r.value for r in spark.read.text(str(tmp_path / "r")).collect()]
    assert "word|occurrences|mean_per|min_per|max_per|median_per" in lines and any(x.startswith("x|") and x.count(".") == 4 for x in lines)


def test_clips_and_scores(spark, tmp_path):
    wav = audio.write_wav(np.zeros(11025), 22050)
    for name, content in (("000003.wav", wav), ("7.wav", b"junk"), ("note.wav", wav), ("x.txt", b"")):
        (tmp_path / name).write_bytes(content)
    got = {r.path.rsplit("/", 1)[1]: r for r in clips.with_header(clips.scan_clips(spark, str(tmp_path))).collect()}
    assert (got["000003.wav"].idx, got["000003.wav"].seconds, got["000003.wav"].sample_rate) == (3, 0.5, 22050)
    assert (got["7.wav"].idx, got["7.wav"].seconds) == (7, 0.0) and got["note.wav"].idx is None
    scores = tmp_path / "s" / "per.csv"
    scores.parent.mkdir()
    scores.write_text("idx|per|per_pitch|ref_phonemes|hyp_phonemes\n1|0.5|0.6|a|b\nx|1|1||\n2||0.25|a|b\n3|bad|0.5|a|b\n1|0.75|0.5|c|d\n")
    rows = {r.idx: (r.per, r.per_pitch) for r in tables.read_scores(spark, str(scores)).collect()}
    assert rows == {1: (0.75, 0.5), 2: (0.0, 0.25), 3: (0.0, 0.0)}


def test_normalized_clips(spark, tmp_path):
    tone = 0.3 * np.sin(np.arange(22050) / 8)
    rows = [(1, audio.write_wav(tone, 22050)), (2, audio.write_wav(np.zeros(5000), 22050)), (3, b"junk"), (4, None), (5, audio.write_wav(tone[:9000], 8000))]
    df = spark.createDataFrame(rows, "idx int, content binary")
    out = str(tmp_path / "out")
    got = {r.idx: (r.outcome, r.reason) for r in clips.normalize_clips(df, out).collect()}
    assert got == {1: ("ok", None), 2: ("failed", "empty_audio"), 3: ("failed", "read_error"), 4: ("failed", "read_error"), 5: ("ok", None)}
    made = {r.idx: r for r in clips.with_header(clips.scan_clips(spark, out)).collect()}
    assert set(made) == {1, 5} and made[5].sample_rate == 22050 and made[5].channels == 1
    again = {r.idx: r.outcome for r in clips.normalize_clips(df, out).collect()}
    assert again == {1: "skipped", 2: "failed", 3: "failed", 4: "failed", 5: "skipped"}
    assert clips.normalize_clips(df, out, force=True).filter("outcome = 'ok'").count() == 2
    assert not clips.is_stale(clips.scan_clips(spark, out), clips.scan_clips(spark, out))


def test_voices_and_sweep(spark, tmp_path):
    for name in ("Anna.wav", "bo.WAV", "x.txt"):
        (tmp_path / name).write_bytes(b"RIFF")
    known = clips.voices(spark, str(tmp_path))
    assert {r.voice for r in known.collect()} == {"Anna", "bo"}
    assert clips.voice_paths(known, ["anna"])["anna"].endswith("Anna.wav")
    with pytest.raises(FileNotFoundError):
        clips.voice_paths(known, ["anna", "carl"])
    with pytest.raises(ValueError):
        clips.voice_paths(known, [" "])
    rows = clips.sweep(known, ["one", "two"]).collect()
    assert {(r.voice, r.phrase, r.text) for r in rows} == {(v, k, t) for v in ("Anna", "bo") for k, t in enumerate(("one", "two"))}
    assert clips.sweep(known, ["one"], only="ANNA").count() == 1 and clips.sweep(known, []).count() == 0


def test_metadata_round_trip(spark, tmp_path):
    rows = [("wavs/000001.wav", 'say "hi" | bye'), ("wavs/000002.wav", "plain")]
    release.write_manifest(spark.createDataFrame(rows, "path string, text string"), str(tmp_path / "m"))
    got = {(r.idx, r.path, r.text) for r in tables.read_metadata(spark, str(tmp_path / "m")).collect()}
    assert got == {(1, *rows[0]), (2, *rows[1])}
    release.write_manifest(spark.createDataFrame([("wavs/none.wav", "t")], "path string, text string"), str(tmp_path / "bad"))
    with pytest.raises(PySparkException):
        tables.read_metadata(spark, str(tmp_path / "bad")).collect()


def test_sidecars_and_decisions(spark, tmp_path):
    (tmp_path / "1.json").write_text('{"index": 1, "reason": "wer=0.5 > 0.2", "wer": 0.5}')
    (tmp_path / "2.json").write_text('{"index": 2,\n "ref_phonemes": "a"}')
    (tmp_path / "3.json").write_text("{broken")
    rows = sidecars.read_sidecars(spark, str(tmp_path))
    assert {r["index"]: r["k"] for r in rows.withColumn("k", sidecars.kind()).collect()} == {1: "validate", 2: "pronunciation"}
    assert sidecars.review_records(rows).filter("index = 2").first().file == "000002.wav"
    assert '"wer":0.5' in sidecars.log_records(rows.filter("index = 1")).first().line
    sidecars.write_log(rows, str(tmp_path / "log"))
    assert spark.read.json(str(tmp_path / "log")).count() == 2
    maps = spark.createDataFrame([('{"decisions": {"4": {"action": "bad"}, "x": {"action": "keep"}}}',), ("[]",)], "t string")
    assert [(r.idx, r.action) for r in sidecars.decisions(maps, "t").collect()] == [(4, "bad")]


def test_paths_of_settings():
    assert tables.resolved("/a/b", "/r") == "/a/b" and tables.resolved("s3://b/c", "/r") == "s3://b/c"
    assert tables.resolved("a.txt", "/r/") == "/r/a.txt" and tables.resolved("a.txt", "hdfs://h/r", True) == "hdfs://h/r/inputs/a.txt"


def test_missing_tables_are_empty_and_generations_count_on(spark, tmp_path):
    assert tables.read_or_empty(spark, str(tmp_path / "none"), "idx int").count() == 0
    names = spark.createDataFrame([("gen001",), ("gen12",), ("other",)], "name string")
    assert tables.next_generation(names).first().next_gen == 13
    assert [r.gen for r in tables.generations(names).collect()] == [1]
