"""Archives: exact round trip, revisits, assembly through concurrent-to identifiers."""

from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from churnlens.llm import warc
from tests.conftest import SF_SMALL
from tests.llm.helpers import pages, tuples

COLUMNS = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
BIG, OTHER = "<p>" + "x" * 1200, "é" * 600
ROWS = [(1, "http://a.example/x", BIG), (2, "http://b.example/", BIG), (9, None, BIG), (3, "http://c", "small"),
        (4, "http://c", "small"), (5, "no scheme", None), (6, "", ""), (7, "http://d", OTHER), (7, "http://d", OTHER),
        (None, "http://e", BIG), (8, "http://f/\r\nInjected: yes", "a\r\n\r\nWARC/1.1\r\n"), (10, "http://g", "y" * 3_000_000),
        (11, "http://h", "z" * 999), (12, "http://h", "z" * 999), (13, "http://h", "z" * 1000), (14, "http://h", "z" * 1000)]


def expected(rows):
    first, out = {}, []
    data = [(p, (h or "").encode()) for p, _, h in rows]
    for p, b in data:
        if len(b) >= 1000 and p is not None:
            first[b] = max(first.get(b, p), p)
    used = set()
    for p, b in data:
        own = b not in first or (p == first[b] and b not in used)
        if own and b in first:
            used.add(b)
        out.append((p, len(b), hashlib.sha1(b).hexdigest(), "response" if own else "revisit", None if own else first[b]))
    return sorted(out, key=repr)


def test_awkward_pages(spark):
    got = warc.archived_pages(pages(spark, ROWS))
    assert tuples(got, *COLUMNS) == expected(ROWS)
    assert warc.archived_pages(pages(spark, [])).count() == 0


def test_payloads_and_record_kinds_survive(spark):
    table = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    manifest = warc.write_archives(table, file_mb=1)
    records = warc.read_records(manifest).cache()
    n = table.count()
    kinds = {r.record_type: r["count"] for r in records.groupBy("record_type").count().collect()}
    assert kinds["request"] == kinds["metadata"] == n and kinds["response"] + kinds.get("revisit", 0) == n
    nested = warc.assemble(records)
    html = {r.page_id: r.html for r in table.collect()}
    seen = 0
    for r in nested.collect():
        page = int(dict(line.split(": ", 1) for line in r.metadata.fields.split("\r\n") if ": " in line)["page_id"])
        assert r.request.target == r.response.target == r.metadata.target
        if r.response.record_type == "response":
            assert bytes(r.response.payload).decode() == html[page]
        seen += 1
    assert seen == n


def test_records_join_across_files_and_strays_are_left_out(spark):
    schema = warc.RECORDS_DDL
    def record(i, kind, to=None, fields=None):
        return (i, kind, to, "t", None, 1 if kind == "response" else None, None, fields, None)
    rows = [record("a", "response"), record("r1", "request", "a"), record("r0", "request", "a"),
            record("m", "metadata", "a", "page_id: 1\r\n"), record("b", "response"), record("q", "request", "gone"),
            record("x", "metadata", None, "page_id: 2\r\n"), record("w", "warcinfo")]
    got = warc.assemble(spark.createDataFrame(rows, schema).repartition(5))
    assert sorted((r.capture_id, r.request and r.request.record_id, r.metadata and r.metadata.fields) for r in got.collect()) == [
        ("a", "r0", "page_id: 1\r\n"), ("b", None, None)]


def test_a_hot_payload_is_salted(spark):
    rows = [(k, "http://a", BIG) for k in range(500)] + [(1000 + k, "http://b", BIG + str(k)) for k in range(20)]
    got = warc.captures(pages(spark, rows))
    assert got.filter("refers_to = 499").count() == 499 and got.filter("refers_to is null").count() == 21
    assert got.select(F.countDistinct("capture")).first()[0] == 520
