"""Physical-plan properties that matter at scale."""

from __future__ import annotations

import contextlib
import io
import tempfile

import pytest

from churnlens import schemas as S
from churnlens.operators import features as FE
from churnlens.params import TESTDATA_PARAMS
from churnlens.plans import job
from churnlens.plans.layers import gold_from_silver
from churnlens.sources import raw_tables_from_testdata, read_silver
from tests.conftest import SF_SMALL


def _plan(df) -> str:
    """The physical plan text as ``explain()`` prints it."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def _final_plan(df) -> str:
    """Run the query, then return AQE's final plan (what actually executed)."""
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    text = _plan(df)
    return text.split("== Initial Plan ==")[0]


@pytest.fixture(scope="module")
def silver(spark):
    out = tempfile.mkdtemp(prefix="churnlens-plans-", dir="/tmp")
    raw = raw_tables_from_testdata(spark, SF_SMALL)
    job.run(spark, raw, out, TESTDATA_PARAMS, csv_export=False, profile=False)
    return read_silver(spark, out)


def test_flat_table_plan_no_python_and_one_scan_per_fact(spark, silver):
    gold = gold_from_silver(silver, TESTDATA_PARAMS)
    plan = _final_plan(gold)
    for marker in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert marker not in plan
    assert plan.count(S.FACT_USAGE) == 1
    assert plan.count(S.FACT_TICKETS) == 1


def test_recency_filter_and_pruning_reach_the_scan(spark, silver):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        plan = _plan(FE.recent_logins(silver[S.USAGE], TESTDATA_PARAMS))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(month,2001-03-03)" in plan.split("PushedFilters:")[1].split("]")[0]
    # only the needed columns are read
    assert "ReadSchema: struct<customer_id:string,month:date,logins:bigint,orphan_flag:boolean>" in plan


def test_reports_windows_run_after_aggregation(spark, silver):
    from churnlens.operators.reports import churn_trend_monthly
    plan = _plan(churn_trend_monthly(silver[S.SUBSCRIPTIONS]))
    assert plan.index("Window") < plan.index("HashAggregate")  # window above the aggregate


@contextlib.contextmanager
def _no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        yield
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "64MB")


def test_flat_table_join_with_subscriptions_is_salted(spark, silver):
    with _no_broadcast(spark):
        plan = _plan(gold_from_silver(silver, TESTDATA_PARAMS))
    # customers and subscriptions meet on the key and the salt; the fact aggregates join on the key
    assert plan.count("Exchange hashpartitioning(_jk") >= 4
    assert len([x for x in plan.splitlines() if "Exchange hashpartitioning(_jk" in x and "_salt" in x]) == 2


def test_building_plans_starts_no_job(spark, silver):
    from churnlens.operators import reports as RP
    group = "plans-only"
    spark.sparkContext.setJobGroup(group, group)
    try:
        gold = gold_from_silver(silver, TESTDATA_PARAMS)
        RP.segment_gaps(gold)
        RP.channel_performance(silver[S.CUSTOMERS], silver[S.SUBSCRIPTIONS], TESTDATA_PARAMS)
        RP.churn_by_plan_contract(silver[S.CUSTOMERS], silver[S.SUBSCRIPTIONS], TESTDATA_PARAMS)
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    finally:
        spark.sparkContext._jsc.sc().clearJobGroup()


def test_queries_scan_the_given_tables(spark):
    from churnlens.plans.catalog import QUERIES
    for name in ("clean_tickets", "customer_features", "profile_duplicates"):
        plan = _plan(QUERIES[name](spark, SF_SMALL))
        assert "testdata/sf0.001" in plan and "bronze" not in plan, name


def test_orphan_flag_is_salted(spark):
    from churnlens.operators.clean import clean_tickets
    raw = raw_tables_from_testdata(spark, SF_SMALL)
    with _no_broadcast(spark):
        plan = _plan(clean_tickets(raw[S.TICKETS], raw[S.CUSTOMERS].select("customer_id"), TESTDATA_PARAMS))
    assert len([x for x in plan.splitlines() if "Exchange hashpartitioning(_jk" in x and "_salt" in x]) == 2
    assert "SortAggregate" not in plan


def test_duplicate_check_moves_fingerprints_only(spark):
    """No exchange of the full-row check carries a whole row: the rows that share a fingerprint get the
    shared ones broadcast (their written size is known), the others are counted by 16 bytes."""
    from churnlens.operators.profile import data_columns, full_row_duplicates, shared_prints
    raw = raw_tables_from_testdata(spark, SF_SMALL)
    tickets = raw[S.TICKETS]
    with _no_broadcast(spark):
        prints = _plan(shared_prints(tickets, data_columns(tickets)))
    assert "Join" not in prints and prints.count("Exchange hashpartitioning(") == 2
    assert not [x for x in prints.splitlines() if "Exchange" in x and "category" in x]
    plan = _final_plan(full_row_duplicates(raw[S.CUSTOMERS]))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_flat_table_on_bucketed_silver_has_no_exchange(spark):
    """Written silver, bucketed by customer id: fact aggregates and all joins of the flat table run where
    the rows lie, and give the rows of the plain layout."""
    from churnlens.sources import read_star
    out = tempfile.mkdtemp(prefix="churnlens-star-", dir="/tmp")
    raw = raw_tables_from_testdata(spark, SF_SMALL)
    written = job.run(spark, raw, out, TESTDATA_PARAMS, csv_export=False, profile=False, buckets=6)
    again = spark.newSession()  # a session that has not written the tables
    star = read_star(again, out)
    again.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    again.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    gold = gold_from_silver(star, TESTDATA_PARAMS)
    plan = _final_plan(gold)
    assert "Exchange" not in plan and plan.count("SortMergeJoin") == 3
    want = {tuple(r) for r in gold_from_silver({t: spark.createDataFrame(df.collect(), df.schema) for t, df in
                                                read_silver(spark, out).items()}, TESTDATA_PARAMS).collect()}
    assert {tuple(r) for r in gold.collect()} == want
    assert {tuple(r) for r in spark.read.parquet(written[S.FEATURES]).collect()} == want
    assert not set(read_silver(spark, out)[S.USAGE].columns) & {"_jk", "_jk_null"}


def test_a_hot_customer_keeps_its_table_out_of_buckets(spark):
    from pyspark.sql import functions as F
    from churnlens.sinks import key_fits_buckets
    from churnlens.sources import read_star
    raw = dict(raw_tables_from_testdata(spark, SF_SMALL))
    hot = raw[S.SUBSCRIPTIONS].where("customer_id = 'Customer#000000001'").withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(900))))
    raw[S.SUBSCRIPTIONS] = raw[S.SUBSCRIPTIONS].unionByName(hot.drop("copy"))
    assert not key_fits_buckets(raw[S.SUBSCRIPTIONS], 8) and key_fits_buckets(raw[S.SUBSCRIPTIONS].where("false"), 8)
    out = tempfile.mkdtemp(prefix="churnlens-star-", dir="/tmp")
    written = job.run(spark, raw, out, TESTDATA_PARAMS, csv_export=False, profile=False, buckets=8)
    star = read_star(spark, out)
    assert "_jk" not in star[S.SUBSCRIPTIONS].columns and "_jk" in star[S.CUSTOMERS].columns
    gold = spark.read.parquet(written[S.FEATURES])
    plain = gold_from_silver(read_silver(spark, out), TESTDATA_PARAMS)
    assert gold.exceptAll(plain).count() == 0 and plain.exceptAll(gold).count() == 0


def test_metric_reports_read_each_table_once_or_twice(spark, silver):
    """The metric table reads the facts once and customers twice (rows, ids); reports read only it."""
    from churnlens.operators import metrics as ME
    raw = {t: spark.read.parquet(silver[t].inputFiles()[0].rsplit("/", 2)[0] + f"/bronze/{t}") for t in S.TABLES}
    plan = _final_plan(ME.measure(raw, TESTDATA_PARAMS))
    scans = [x for x in plan.splitlines() if "Scan parquet" in x]
    assert [sum(f"bronze/{t}" in x for x in scans) for t in S.TABLES] == [2, 1, 1, 1]
