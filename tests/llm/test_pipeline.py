"""Each stage against brute force on what the one before it kept, at the smallest size."""

from __future__ import annotations

import corpus_pipeline
from tessera.llm import quality
from tests.llm.test_decontaminate import brute as leaks
from tests.llm.test_pii import brute as private
from tests.llm.test_simhash import brute_fingerprint, brute_groups


def test_null_ids_odd_texts_and_empty_tables(spark, tmp_path):
    good = "Some plain words that go on in one way, then in another, and end at last where the line does too"
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(1, good, "en", "a", len(good)), (None, good.replace("plain", "other words, odd"), None, None, None), (None, None, None, "a", None), (2, "", "en", "a", 0)]
    for name, docs in (("some", rows), ("none", [])):
        folder = f"{tmp_path}/{name}"
        spark.createDataFrame(docs, schema).write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
        spark.createDataFrame([], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
        got = corpus_pipeline.run(spark, folder).collect()
        assert sorted((r.doc_id for r in got), key=str) == ([1, None] if docs else [])
        assert all(r.taken <= 2 * r.size for r in got)


def test_stages(spark, data, tmp_path):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    kept, columns = [docs.collect()], docs.columns
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, data).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        kept.append(docs.collect())
        if k < 4:
            assert docs.columns == columns
    raw, good, single, clean, safe, mix = kept

    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{data}/labels.parquet").collect()}
    ids = {r.doc_id for r in good}
    base = dict(zip((r.doc_id for r in raw), quality.judge([r.text.encode() for r in raw], quality.NEUTRAL, 0.5), strict=True))
    assert not any(base[i][5] for i in ids)
    assert all(i in ids for i, q in labels.items() if q == 1 and not base[i][5])

    fps = {r.doc_id: brute_fingerprint(r.text) for r in good}
    root = brute_groups(fps.values())
    least = {}
    for i, f in fps.items():
        least[root[f]] = min(i, least.get(root[f], i))
    assert sorted(r.doc_id for r in single) == sorted(least.values())

    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{data}/benchmark.parquet").collect()]
    assert {r.doc_id for r in clean} == {r.doc_id for r in single if not leaks(r.text, items)[4]}

    before = {r.doc_id: r for r in clean}
    assert {r.doc_id for r in safe} == set(before)
    for r in safe:
        assert not private(r.text)
        assert private(before[r.doc_id].text) or r == before[r.doc_id]

    assert {r.doc_id for r in mix} == set(before)
    total = sum(r["size"] for r in mix)
    assert abs(sum(r.taken for r in mix) - 1.5 * total) <= 20
