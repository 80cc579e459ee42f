"""Duplicates by fingerprint and the metric table."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from churnlens import schemas as S
from churnlens.operators import metrics as ME
from churnlens.operators import profile as PR
from churnlens.params import TESTDATA_PARAMS as P
from churnlens.plans.layers import silver_from_raw
from churnlens.session import shared_table
from churnlens.sources import raw_tables_from_testdata
from tests.conftest import SF_SMALL

ROWS = [("a", None, 1), ("a", None, 1), (None, "a", 1), ("a", "b", 2), ("a", "b", 2), ("a", "b", 2), ("c", "d", 3), ("c", "e", 3),
        (None, None, None), (None, None, None)]


def constant(cols):
    return [F.lit(1).cast("long"), F.lit(2).cast("long")]


def by_first_column(cols):
    return [F.xxhash64(cols[0]), F.lit(0).cast("long")]


@pytest.mark.parametrize("prints", [PR.row_print, constant, by_first_column])
def test_full_row_duplicates_with_forced_collisions(spark, prints):
    df = spark.createDataFrame(ROWS, "x string, y string, z int")
    got = PR.full_row_duplicates(df, prints).first()
    want = PR._extra_rows(df, df.columns).first()
    assert tuple(got) == tuple(want) == (10, 4, 6)
    assert tuple(PR.full_row_duplicates(df.limit(0), prints).first()) == (0, 0, 0)


def test_a_hot_row_is_counted_where_it_is_read(spark):
    df = spark.range(20_000, numPartitions=8).select((F.col("id") % 3 == 0).alias("hot"), F.when(
        F.col("id") % 3 != 0, F.col("id")).alias("v"))
    assert tuple(PR.full_row_duplicates(df).first()) == (20_000, 6_666, 13_334)


@pytest.fixture(scope="module")
def tables(spark):
    raw = raw_tables_from_testdata(spark, SF_SMALL)
    return raw, silver_from_raw(raw, P)


@pytest.fixture(scope="module")
def metrics(spark, tables):
    raw, _ = tables
    return shared_table(ME.measure(raw, P).unionByName(ME.duplicate_metrics(raw)).unionByName(
        ME.layout_metrics(raw[S.CUSTOMERS])), "metrics")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_reports_equal_the_single_ones(tables, metrics):
    raw, silver = tables
    assert rows(ME.null_rates_from(metrics)) == rows(PR.null_rates(raw))
    assert rows(ME.remaining_nulls_from(metrics)) == rows(PR.remaining_nulls(silver))
    assert rows(ME.duplicates_from(metrics)) == rows(PR.duplicates(raw))


def test_metrics_of_facts_and_customers(tables, metrics):
    raw, silver = tables
    got = {(r.layer, r.table_name, r.column_name, r.metric): r.value for r in metrics.collect()}
    for t in S.TABLES:
        assert got["raw", t, "", "rows"] == raw[t].count() and got["silver", t, "", "rows"] == silver[t].count()
        for c in PR.data_columns(raw[t]):
            assert got["raw", t, c, "nulls"] == raw[t].where(F.col(c).isNull()).count(), (t, c)
    for t in (S.TICKETS, S.USAGE):
        assert got["silver", t, "", "orphans"] == silver[t].where("orphan_flag").count() > 0
    signs = {r.column_name: r for r in PR.usage_signs(raw[S.USAGE]).collect()}
    for c, r in signs.items():
        assert (got["raw", S.USAGE, c, "negative"], got["raw", S.USAGE, c, "zero"]) == (r.negatives, r.zeros)
    rules = PR.subscription_rules(raw[S.SUBSCRIPTIONS], P).first().asDict()
    assert {k: got["raw", S.SUBSCRIPTIONS, "", k] for k in rules} == rules


def test_empty_tables(spark, tables):
    raw, _ = tables
    none = {t: df.limit(0) for t, df in raw.items()}
    got = ME.measure(none, P)
    assert {r.value for r in got.where("metric = 'rows'").collect()} == {0.0}
    report = {(r.section, r.metric): r.value for r in ME.quality_report_from(got).collect()}
    assert report["customers", "total_rows"] == 0 and report["customers", "null_age_%"] is None
