from __future__ import annotations

import json
import os

import duckdb
import pytest
from pyspark.sql import functions as F

from tessera.plans import adapters, curation
from tessera.plans.catalogue import QUERIES
from tessera.plans.catalogue_sql import SQL
from tessera.streaming import validate

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if v is None or v != v:
        return None
    if isinstance(v, float):
        return f"{v:.9g}"
    return str(int(v)) if isinstance(v, int) and not isinstance(v, bool) else str(v)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_has_the_rows_of_its_sql(spark, data, name):
    got = QUERIES[name](spark, data)
    rows = [r.asDict() for r in got.collect()]
    if name not in SQL:
        assert rows
        return
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    made = con.execute(SQL[name])
    names = [d[0] for d in made.description]
    assert sorted(names) == sorted(got.columns)
    want = sorted(str([plain(v) for _, v in sorted(zip(names, r, strict=True))]) for r in made.fetchall())
    assert sorted(str([plain(r[c]) for c in sorted(names)]) for r in rows) == want


def test_plans_of_steps():
    assert curation.plan() == list(curation.STEPS)
    off = curation.Settings(phoneme_check=False)
    assert curation.plan(start="validate", settings=off) == ["validate", "normalize", "publish"]
    with pytest.raises(ValueError, match="unknown step"):
        curation.plan(steps=("nothing",))
    assert curation.resumes(1, 2) and not curation.resumes(0, 2) and not curation.resumes(2, 2)


def test_options_need_their_steps():
    for options in (
        {"steps": ("publish",), "only_rejected": True},
        {"steps": ("validate",), "calibrate": True},
        {"steps": ("validate",), "settings": curation.Settings(wavs_per_dir=10)},
    ):
        with pytest.raises(ValueError):
            curation.plan(**options)
    for wrong in ({"wer_threshold": -1}, {"val_ratio": 1.0}):
        with pytest.raises(ValueError):
            curation.Settings(**wrong)


def test_a_plan_is_run_to_the_release(spark, tmp_path):
    corpus = spark.createDataFrame([(0, "uno due"), (1, "tre"), (2, "")], "idx long, text string")
    calls = []

    def heard(clips):
        calls.append(clips.count())
        return clips.select("idx", F.lit("a b").alias("ref"), F.when(F.col("idx") == 0, "a b").otherwise("x y").alias("hyp"))

    models = {
        "generate": lambda df: adapters.apply(df, adapters.ToneSpeech()),
        "validate": lambda clips: clips.select("idx", F.col("text").alias("transcription")),
        "pronunciation": heard,
        "normalize": lambda work: work.select("idx", F.lit("ok").alias("outcome"), F.lit(None).cast("string").alias("reason")),
    }
    run = curation.Curation(spark, corpus, str(tmp_path / "log"))
    with pytest.raises(ValueError, match="nothing to run for normalize, publish"):
        run.run({k: v for k, v in models.items() if k != "normalize"})
    counts = run.run(models, str(tmp_path / "out"))
    assert counts == {
        "generate": {"accepted": 2, "skipped": 1}, "validate": {"accepted": 2}, "pronunciation": {"accepted": 1, "rejected": 1},
        "normalize": {"ok": 1}, "publish": {"accepted": 1},
    }
    assert calls == [2]  # the model heard each clip once
    again = run.run(models, str(tmp_path / "out"), start="publish")
    assert again == {"publish": {"accepted": 1}} and curation.last_generation(spark, str(tmp_path / "out")) == 2
    assert run.run(models, steps=("pronunciation",), calibrate=True)["pronunciation"]["count"] == 2
    only = run.run(models, steps=("generate", "validate"), only_rejected=True)
    assert only["generate"]["accepted"] == 2 and run.latest("generate").filter("gen = 2").count() == 1


def test_curation_from_corpus_to_release(spark, tmp_path):
    corpus = spark.createDataFrame([(0, "uno due tre"), (1, "quattro cinque sei"), (2, "sette otto"), (3, "")], "idx long, text string")
    said = spark.createDataFrame([(0, "uno due tre"), (1, "altro"), (2, "sette otto")], "idx long, transcription string")
    heard = spark.createDataFrame([(0, "a b", "a b"), (1, "c d", "c d"), (2, "e f", "x y")], "idx long, ref string, hyp string")
    run = curation.Curation(spark, corpus, str(tmp_path / "log"))
    speak = lambda df: adapters.apply(df, adapters.ToneSpeech())
    run.generate(speak)
    run.validate(lambda clips: said)
    ids = lambda df: sorted(r.idx for r in df.select("idx").collect())
    assert ids(run.passed("generate")) == [0, 1, 2] and ids(run.passed("validate")) == [0, 2] and ids(run.rejected()) == [1]
    n = run.events().count()
    assert run.pronunciation(lambda clips: heard, calibrate=True).first()["count"] == 2 and run.events().count() == n
    run.pronunciation(lambda clips: heard)
    assert ids(run.released()) == [0] and ids(run.rejected()) == [1, 2]
    run.generate(speak, only_rejected=True)  # new audio makes all later steps pending again
    assert ids(run.passed("validate")) == [0]
    run.validate(lambda clips: said.withColumn("transcription", F.when(F.col("idx") == 1, "quattro cinque sei").otherwise(F.col("transcription"))))
    run.pronunciation(lambda clips: heard.withColumn("hyp", F.col("ref")))
    assert ids(run.released()) == [0, 1, 2]
    run.decide(spark.createDataFrame([(0, "bad"), (-1, "bad")], "idx long, action string"))
    assert ids(run.passed("validate")) == [1, 2]
    before = run.events().count()
    run.validate(lambda clips: said)
    assert run.events().count() == before  # nothing was pending


def test_phonemes_from_a_lexicon(spark):
    texts = spark.createDataFrame([(1, "Uno, due uno!"), (2, "tre due"), (3, ""), (4, None)], "idx long, text string")
    lexicon = spark.createDataFrame([("uno", "u n o"), ("due", "d u e"), ("uno", "x")], "word string, phonemes string")
    got = {r.idx: r.ref for r in adapters.lexicon_phonemes(texts, lexicon).collect()}
    assert got == {1: "u n o\x1fd u e\x1fu n o", 2: "\x1fd u e"}


def test_streamed_validation(spark, tmp_path):
    (tmp_path / "in").mkdir()
    rows = [(1, "a b", "a b"), (1, "a b", "x"), (2, "a b", "a"), (3, "", "x")]
    for k, (i, text, said) in enumerate(rows):
        line = {"idx": i, "text": text, "transcription": said, "ts": f"2024-01-01T00:0{k}:00Z"}
        (tmp_path / "in" / f"{k}.json").write_text(json.dumps(line))
        os.utime(tmp_path / "in" / f"{k}.json", (1_700_000_000 + k, 1_700_000_000 + k))  # files are read by age
    stream = validate.validated(validate.arriving(spark, str(tmp_path / "in"), 1), 0.4)
    validate.start(stream, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination(120)
    out = {r.idx: (r.wer, r.accepted) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert out == {1: (0.0, True), 2: (0.5, False), 3: (1.0, False)}


def test_entry_without_the_training_data_operators():
    import subprocess
    import sys

    code = (
        "import sys; sys.modules['tessera.llm'] = None; sys.modules['corpus_pipeline'] = None\n"
        "import __spark_entry__ as e; assert 'wer_gate' in e.queries() and 'pipeline' not in e.queries() and 'wer_gate' in e.oracle_sql()"
    )
    subprocess.run([sys.executable, "-c", code], check=True, timeout=60)
