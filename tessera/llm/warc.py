"""WARC records and a Merkle audit of replicas.

Records are hashed, ordered by offset within their file, and hashed again in ranges of
``fan`` neighbours, range by range up to one root. Replicas whose roots agree are equal.
Where they differ, only ranges under a node that differs are compared further down, until
the records are found. Ranges that only one replica has differ from nothing and count too.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import working, written

FILE_RECORDS = 1000
FAN = 16
#: Date of every record made here: a record's bytes depend on its page alone.
DATE = "2024-01-01T00:00:00Z"


def record_of(page_id: Column, url: Column, html: Column) -> Column:
    """The bytes of a WARC/1.1 resource record as a string; nulls are empty."""
    body = F.coalesce(html, F.lit(""))
    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:"),
        F.coalesce(page_id.cast("string"), F.lit("")),
        F.lit(">\r\nWARC-Target-URI: "),
        F.regexp_replace(F.coalesce(url, F.lit("")), "[\r\n]", " "),
        F.lit(f"\r\nWARC-Date: {DATE}\r\nContent-Type: text/html\r\nContent-Length: "),
        F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"),
        body,
        F.lit("\r\n\r\n"),
    )


def archive(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    damage: Callable[[Column, Column], Column] | None = None,
) -> DataFrame:
    """One row per page: page_id, file, place in the file from 0, offset, length, digest (SHA-256 of the record).

    Pages go to files of FILE_RECORDS ids; those without an id that is a number to one of 1,024 files by hash of their
    content. Within a file they stand by id, then digest, so repeated rows stand side by side; an empty table gives no
    rows; other columns are left out; pages of any length are hashed whole. With damage,
    a function of record and digest, the digests are those of what it gives, and records that it makes null are left out.
    """
    record = record_of(F.col(id_col), F.col(url_col), F.col(html_col))
    made = pages.select(F.col(id_col).alias("page_id"), record.alias("record")).select(
        "page_id", "record", F.octet_length("record").cast("long").alias("length"), F.sha2("record", 256).alias("digest")
    )
    stored = F.sha2(damage(F.col("record"), F.col("digest")), 256) if damage else F.col("digest")
    made = made.withColumn("stored", stored).drop("record")
    number = F.col("page_id").cast("string").try_cast("decimal(38,0)")
    file = F.coalesce(
        F.floor(number / FILE_RECORDS).cast("long"), -1 - F.pmod(F.xxhash64("digest"), F.lit(1024)).cast("long")
    )
    # equal rows are one until they have their places
    rows = made.groupBy(file.alias("file"), "page_id", "digest", "length", "stored").agg(F.count("*").alias("n"))
    before = Window.partitionBy("file").orderBy("page_id", "digest").rowsBetween(Window.unboundedPreceding, -1)
    sums = {
        "place_": F.coalesce(F.sum("n").over(before), F.lit(0)),
        "offset_": F.coalesce(F.sum(F.col("n") * F.col("length")).over(before), F.lit(0)),
    }
    each = rows.withColumns(sums).withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
    return each.select(
        "page_id",
        "file",
        (F.col("place_") + F.col("k")).alias("place"),
        (F.col("offset_") + F.col("k") * F.col("length")).alias("offset"),
        "length",
        F.col("stored").alias("digest"),
    ).filter("digest IS NOT NULL")


@dataclass(frozen=True)
class Tree:
    """levels[0] has the records; each further level a node per fan neighbours of the one below; the last has the root.

    Columns of a level: file, place, digest. Levels within files come first (the last of them has a row per file), then
    levels over files, whose file is null and whose place numbers ranges of files.
    """

    levels: tuple[DataFrame, ...]
    within: int
    fan: int

    def parent(self, level: int) -> tuple[Column, Column]:
        """(file, place) of the node above a node of this level."""
        if level < self.within:
            return F.col("file"), F.floor(F.col("place") / self.fan).cast("long")
        place = F.col("file") if level == self.within else F.col("place")
        return F.lit(None).cast("long"), F.floor(place / self.fan).cast("long")


def tree(records: DataFrame, within: int, over: int, fan: int = FAN) -> Tree:
    """The Merkle tree over (file, place, digest), with so many levels within files and over them."""
    levels = [written(records.select("file", "place", "digest"), "merkle")]
    shape = Tree((), within, fan)
    for level in range(within + over):
        file, place = shape.parent(level)
        key = F.coalesce("file", "place") if level == within else F.col("place")
        # at most fan children each
        children = F.transform(F.array_sort(F.collect_list(F.struct(key.alias("k"), "digest"))), lambda e: e["digest"])
        up = levels[-1].groupBy(file.alias("up_file"), place.alias("up_place")).agg(
            F.sha2(F.array_join(children, ""), 256).alias("digest")
        )
        levels.append(written(up.toDF("file", "place", "digest"), "merkle"))
    return Tree(tuple(levels), within, fan)


def height(records: DataFrame, fan: int = FAN) -> tuple[int, int]:
    """Levels needed within files and over files, from the largest place and file."""
    top = records.agg(F.max("place"), F.min("file"), F.max("file")).first()

    def levels(n: int) -> int:
        k = 0
        while n > fan**k:
            k += 1
        return k

    if top[0] is None:
        return 1, 1
    # ranges are cut by floor, so those below and above 0 meet only at a level over both
    return max(1, levels(top[0] + 1)), max(1, levels(max(top[2], 0) + 1), levels(max(-top[1], 0)))


def roots(t: Tree) -> list[tuple[int, str]]:
    """(place, digest) at the top: one node, or two where there are files with numbers below 0."""
    return [(r.place, r.digest) for r in t.levels[-1].orderBy("place").collect()]


def compare(a: Tree, b: Tree) -> DataFrame:
    """(file, place, digest_a, digest_b) of the records that differ; a null digest: that replica lacks the record.

    Starts at the top and reads of each lower level only what lies under a node that differs.
    """
    wrong = None
    for level in range(len(a.levels) - 1, -1, -1):
        sides = []
        for t, name in ((a, "digest_a"), (b, "digest_b")):
            here = t.levels[level]
            if wrong is not None:
                file, place = t.parent(level)
                up = wrong.select(F.col("file").alias("up_file"), F.col("place").alias("up_place"))
                here = here.join(up, file.eqNullSafe(F.col("up_file")) & (place == F.col("up_place")), "left_semi")
            sides.append(here.select(F.col("file"), F.col("place"), F.col("digest").alias(name)))
        left, right = sides[0].alias("l"), sides[1].alias("r")
        same = F.col("l.file").eqNullSafe(F.col("r.file")) & (F.col("l.place") == F.col("r.place"))
        wrong = (
            left.join(right, same, "full")
            .filter(~F.col("digest_a").eqNullSafe(F.col("digest_b")))
            .select(
                F.coalesce("l.file", "r.file").alias("file"),
                F.coalesce("l.place", "r.place").alias("place"),
                "digest_a",
                "digest_b",
            )
        )
        wrong = written(wrong, "differs")
        if wrong.isEmpty():
            break
    return wrong if level == 0 else wrong.limit(0)


def audit(original: DataFrame, replica: DataFrame, fan: int = FAN) -> DataFrame:
    """original (as archive gives it) with status: intact, altered, or missing from the replica.

    Both have file, place and digest. Records that only the replica has are not told here (see compare). Empty replicas
    miss every record; an empty original gives no rows.
    """
    original = written(original, "original")
    with working(original.sparkSession) as keep:
        replica = written(replica, "replica")
        within, over = (max(x) for x in zip(height(original, fan), height(replica, fan), strict=True))
        wrong = keep(compare(tree(original, within, over, fan), tree(replica, within, over, fan)), "differs")
    found = wrong.filter("digest_a IS NOT NULL").select(
        F.col("file").alias("f"),
        F.col("place").alias("p"),
        F.when(F.col("digest_b").isNull(), "missing").otherwise("altered").alias("status"),
    )
    out = original.join(found, (original["file"] == found["f"]) & (original["place"] == found["p"]), "left")
    return out.select(*original.columns, F.coalesce("status", F.lit("intact")).alias("status"))


def decay(record: Column, digest: Column) -> Column:
    """Simulated damage, to audit: by digest, records that start with 00 got one more byte, those with ff got lost."""
    return F.when(digest.startswith("00"), F.concat(record, F.lit("!"))).when(~digest.startswith("ff"), record)


def members(content: bytes) -> Iterator[tuple[int, bytes, bool]]:
    """(offset, bytes, whole) of each member of a gzip file; of any other file, all of it."""
    if not content.startswith(b"\x1f\x8b"):
        yield 0, content, True
        return
    at = 0
    while at < len(content):
        unpack = zlib.decompressobj(31)
        try:
            found = unpack.decompress(memoryview(content)[at:])
        except zlib.error:
            yield at, b"", False
            return
        yield at, found, unpack.eof
        if not unpack.eof:
            return
        at = len(content) - len(unpack.unused_data)


def parse(content: bytes) -> Iterator[tuple[int, dict[str, str], bytes, str]]:
    """(offset, headers, payload, status) of each record of a WARC file, plain or gzip; offsets in the file as it is.

    A record that ends too early has the payload that is left and the status truncated; where no record starts, the status
    is malformed and the payload the rest. Nothing after such a place (in its gzip member) is read. Headers are told apart
    at their first colon, whatever their case; lines without one are passed over.
    """
    for start, data, whole in members(content):
        at = 0
        while at < len(data):
            here = start + at if data is content else start
            end = data.find(b"\r\n\r\n", at)
            version, *lines = data[at : end if end >= 0 else at + 16].decode("utf-8", "replace").split("\r\n")
            headers = {k.strip().lower(): v.strip() for k, colon, v in (x.partition(":") for x in lines) if colon}
            size = headers.get("content-length", "")
            if end < 0 or not version.startswith("WARC/") or not size.isdecimal():
                yield here, {}, data[at:], "malformed" if whole else "truncated"
                break
            payload = data[end + 4 : end + 4 + int(size)]
            yield here, headers, payload, "ok" if len(payload) == int(size) else "truncated"
            at = end + 4 + int(size) + 4
        if not whole and not data:
            yield start, {}, b"", "truncated"


def read_files(files: DataFrame, most_bytes: int = 8 << 20) -> DataFrame:
    """(path, offset, uri, payload, status) of every record in files (path, content), such as
    spark.read.format("binaryFile") gives with these columns (see parse). Null and empty files have none; records are
    passed on in blocks of most_bytes, or one."""
    names = ["path", "offset", "uri", "payload", "status"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def block(rows: list[tuple]) -> pa.RecordBatch:
            kinds = [pa.string(), pa.int64(), pa.string(), pa.binary(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

        for batch in batches:
            for k in range(batch.num_rows):
                path, content = (batch.column(c)[k].as_py() for c in range(2))
                rows, held = [], 0
                for at, headers, payload, status in parse(content) if content else ():
                    if rows and held + len(payload) > most_bytes:
                        yield block(rows)
                        rows, held = [], 0
                    rows.append((path, at, headers.get("warc-target-uri"), payload, status))
                    held += len(payload)
                if rows:
                    yield block(rows)

    return files.select("path", "content").mapInArrow(run, "path string, offset long, uri string, payload binary, status string")


_RECORD = (
    "'WARC/1.1' || e || 'WARC-Type: resource' || e || 'WARC-Record-ID: <urn:page:' || coalesce(CAST(page_id AS VARCHAR), '')"
    " || '>' || e || 'WARC-Target-URI: ' || regexp_replace(coalesce(url, ''), '[\r\n]', ' ', 'g') || e || 'WARC-Date: "
    + DATE
    + "' || e || 'Content-Type: text/html' || e || 'Content-Length: ' || strlen(coalesce(html, '')) || e || e"
    " || coalesce(html, '') || e || e"
)
SQL = f"""
WITH r AS (SELECT page_id, {_RECORD} AS record FROM pages, (SELECT chr(13) || chr(10) AS e)),
d AS (SELECT page_id, CAST(floor(page_id / {FILE_RECORDS}.0) AS BIGINT) AS file, CAST(strlen(record) AS BIGINT) AS length, sha256(record) AS digest FROM r)
SELECT page_id, file, row_number() OVER w - 1 AS place,
  CAST(coalesce(sum(length) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset", length, digest,
  CASE WHEN starts_with(digest, '00') THEN 'altered' WHEN starts_with(digest, 'ff') THEN 'missing' ELSE 'intact' END AS status
FROM d WINDOW w AS (PARTITION BY file ORDER BY page_id, digest)
"""
