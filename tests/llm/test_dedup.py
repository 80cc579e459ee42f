from __future__ import annotations

import hashlib
import tempfile
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from churnlens.llm import dedup
from tests.llm.helpers import documents

ROWS = [
    (5, "a b"), (3, "ab"), (4, "a\tb"), (9, "a  b "), (8, "a  b "), (1, None), (2, ""), (6, " \n\r\x0b\f"),
    (None, "ab  "), (None, "solo"), (7, "solo"), (10, "A b"), (11, "x" * 300_000), (12, "x" * 300_000 + " "),
    (13, " ab"), (13, "twin"), (13, "twin"), (-2**63, "twin"), (14, "café"), (15, "café"),
]


def plain(rows):
    """doc_id, keep_id, group_size, kept, sha256 by a dictionary; kept of repeated rows is counted only."""
    groups = defaultdict(list)
    for i, t in rows:
        t = t or ""
        groups[t.translate({ord(c): None for c in dedup.WHITE})].append((-len(t), i is None, i))
    out = []
    for norm, members in groups.items():
        members.sort(key=lambda m: (m[0], m[1], m[2] or 0))
        for k, (_, _, i) in enumerate(members):
            out.append((i, members[0][2], len(members), k == 0, hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(out, key=repr)


def result(df):
    return sorted((tuple(r) for r in df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=repr)


def folder(spark, rows, parts=3, path=None):
    path = path or tempfile.mkdtemp(prefix="churnlens-test-", dir="/tmp") + "/documents.parquet"
    df = documents(spark, rows).withColumns({"digest": F.lit("x"), "file": F.lit(1), "kept": F.lit("k")})
    df.repartition(parts).write.mode("append").parquet(path)
    return path


def test_awkward_rows(spark):
    assert result(dedup.deduplicate(spark, folder(spark, ROWS))) == plain(ROWS)


@pytest.mark.parametrize("digest", [lambda t: F.substring(dedup.sha256(t), 1, 1), lambda t: F.lit("same")])
def test_equal_digests_of_different_texts(spark, digest):
    """A digest of one hex digit, or one for all texts: whole texts tell them apart."""
    assert result(dedup.deduplicate(spark, folder(spark, ROWS), digest=digest)) == plain(ROWS)


def test_state_goes_on_with_new_files(spark):
    path, store = folder(spark, ROWS[:9], 4), tempfile.mkdtemp(prefix="churnlens-test-", dir="/tmp")
    assert result(dedup.deduplicate(spark, path, store, max_files_per_trigger=1)) == plain(ROWS[:9])
    batches = spark.read.parquet(f"{store}/arrivals").select("file").distinct().count()
    assert batches > 1
    before = spark.read.parquet(f"{store}/arrivals").count()
    folder(spark, ROWS[9:], 2, path)
    assert result(dedup.deduplicate(spark, path, store, max_files_per_trigger=1)) == plain(ROWS)
    assert spark.read.parquet(f"{store}/arrivals").count() - before == len(ROWS) - 9  # old files were not read again


def test_one_file_and_no_rows(spark):
    path = folder(spark, ROWS[:4], 1)
    one = next(r[0] for r in spark.read.parquet(path).select("_metadata.file_path").distinct().collect())
    assert result(dedup.deduplicate(spark, one)) == plain(ROWS[:4])
    assert result(dedup.deduplicate(spark, folder(spark, [], 1))) == []


def test_kept_rows_are_found_by_their_locators(spark):
    path = folder(spark, ROWS)
    kept = dedup.deduplicate(spark, path).filter("kept").select("text_sha256", "file", "row")
    rows = dedup.contents_of(spark, path, kept)
    assert {r.text_sha256 for r in rows.collect()} == {hashlib.sha256(r.text.encode()).hexdigest() for r in rows.collect()}


def test_plan_has_no_python(spark):
    plan = dedup.deduplicate(spark, folder(spark, ROWS))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
