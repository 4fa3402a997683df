from __future__ import annotations

import gzip

from pyspark.sql import functions as F

from tessera.llm import warc

ROWS = [(k, f"http://a.org/{k}", f"<p>{k}</p>" * (k % 7)) for k in range(2300)] + [
    (None, None, None), (None, "u", "h"), (5, "http://a.org/5", "<p>5</p>" * 5), (3100, "x\ny", ""), (-4, None, "é"),
]


def pages(spark, rows=ROWS):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_offsets_and_digests_are_those_of_the_written_bytes(spark):
    made = pages(spark).select("page_id", warc.record_of(F.col("page_id"), F.col("url"), F.col("html")).alias("r"))
    kept = warc.archive(pages(spark)).filter("file = 0").orderBy("place").collect()
    body = {r.page_id: r.r.encode() for r in made.collect()}
    content = b"".join(body[r.page_id] for r in kept)
    parsed = list(warc.parse(content))
    assert [p[0] for p in parsed] == [r.offset for r in kept]
    assert parsed[7][1]["warc-target-uri"].startswith("http://a.org/") and len(parsed) == 1001
    files = spark.createDataFrame([("f", content), ("none", None)], "path string, content binary")
    back = warc.read_files(files).collect()
    assert [bytes(r.payload) for r in back] == [p[2] for p in parsed]


def test_damaged_compressed_and_odd_files(spark):
    one = b"WARC/1.1\r\nno colon here\r\nwarc-target-uri:http://a.b/\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    told = lambda c: [(at, h.get("warc-target-uri"), body, status) for at, h, body, status in warc.parse(c)]
    whole = (0, "http://a.b/", b"hello", "ok")
    assert told(one * 2) == [whole, (len(one), *whole[1:])]
    assert told(one + one[:-6]) == [whole, (len(one), "http://a.b/", b"hel", "truncated")]
    assert told(one + b"junk") == [whole, (len(one), None, b"junk", "malformed")]
    packed = gzip.compress(one)
    assert told(packed * 2) == [whole, (len(packed), *whole[1:])]
    assert told(packed + packed[:30])[1][3] == "truncated" and told(packed + b"junk")[1][3] == "truncated"
    assert told(one.replace(b" 5", b" x"))[0][3] == "malformed" and told(b"") == []
    files = spark.createDataFrame([("f", one * 50), ("e", b""), ("n", None)], "path string, content binary")
    rows = warc.read_files(files, most_bytes=12).collect()
    assert [r.offset for r in rows] == [len(one) * k for k in range(50)] and {r.status for r in rows} == {"ok"}


def test_ids_of_any_kind_and_very_many_equal_rows(spark):
    rows = [(None, "u", "h")] * 500 + [("77", "u", "h")] * 300 + [("page-x", "u", "h"), ("1e3", None, "x" * 100_000), ("77", "u", "g")]
    got = warc.archive(spark.createDataFrame(rows, "page_id string, url string, html string")).collect()
    assert len(got) == len(rows) and {r.file for r in got if r.page_id == "77"} == {0}
    for file in {r.file for r in got}:
        mine = sorted((r for r in got if r.file == file), key=lambda r: r.place)
        assert [r.place for r in mine] == list(range(len(mine)))
        assert [r.offset for r in mine] == [sum(x.length for x in mine[:k]) for k in range(len(mine))]


def damage(record, digest):
    return F.when(record.contains("urn:page:42>"), None).when(record.contains("urn:page:1777>"), F.concat(record, F.lit("x"))).otherwise(record)


def test_audit_finds_what_is_damaged(spark):
    whole = warc.archive(pages(spark))
    got = warc.audit(whole, warc.archive(pages(spark), damage=damage), fan=4)
    assert got.count() == len(ROWS)
    bad = {(r.page_id, r.status) for r in got.filter("status <> 'intact'").collect()}
    assert bad == {(42, "missing"), (1777, "altered")}


def test_equal_replicas_have_equal_roots_and_nothing_to_descend(spark):
    whole = warc.archive(pages(spark))
    size = warc.height(whole)
    a, b = warc.tree(whole, *size), warc.tree(warc.archive(pages(spark)), *size)
    assert warc.roots(a) == warc.roots(b) and len(warc.roots(a)) == 2  # files with numbers below 0 have a root of their own
    assert warc.compare(a, b).count() == 0


def test_records_of_one_side_alone(spark):
    whole = warc.archive(pages(spark))
    some = whole.filter("file <> 1")
    assert warc.audit(whole, some).filter("status = 'missing'").count() == 1000
    assert warc.audit(some, whole).filter("status <> 'intact'").count() == 0
    assert warc.audit(whole, whole.limit(0)).filter("status = 'missing'").count() == len(ROWS)
    assert warc.audit(whole.limit(0), whole).count() == 0
