"""Churn reports on small tables plus invariants on the test data."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from churnlens import schemas as S
from churnlens.operators import reports as RP
from churnlens.params import TESTDATA_PARAMS
from churnlens.plans.layers import gold_from_testdata, silver_from_testdata
from tests.conftest import SF_SMALL

D = dt.date


def test_trend_lag_and_running_totals(spark):
    subs = spark.createDataFrame([
        ("a", 10.0, D(2024, 1, 5), "Churned"), ("b", 20.0, D(2024, 1, 20), "Churned"),
        ("c", 5.0, D(2024, 3, 1), "Churned"), ("d", 7.0, None, "Churned"), ("e", 9.0, D(2024, 2, 1), "Active"),
    ], "customer_id string, mrr double, churn_date date, status string")
    rows = RP.churn_trend_monthly(subs).collect()
    assert [(r.churn_month, r.churned_count, r.mrr_lost, r.change_vs_prev_month, r.cumulative_churned,
             r.cumulative_mrr_lost) for r in rows] == [
        (D(2024, 1, 1), 2, 30.0, None, 2, 30.0), (D(2024, 3, 1), 1, 5.0, -1, 3, 35.0)]


def test_ticket_buckets_count_orphan_tickets(spark):
    subs = spark.createDataFrame([("a", "Churned"), ("b", "Active"), ("zz", "Active")], "customer_id string, status string")
    tickets = spark.createDataFrame([("a",)] * 3 + [("zz",)], "customer_id string")
    out = {r.ticket_bucket: (r.customers, r.churn_rate_pct) for r in RP.churn_by_ticket_bucket(subs, tickets).collect()}
    assert out == {"3-5 tickets": (1, 100.0), "0 tickets": (1, 0.0), "1-2 tickets": (1, 0.0)}


def test_segment_gap(spark):
    feats = spark.createDataFrame(
        [("Basic", "Monthly", "x", 1), ("Basic", "Monthly", "x", 1), ("Basic", "Annual", "x", 0),
         ("Premium", "Annual", "x", 0), ("Premium", "Monthly", "x", 1), (None, "Annual", "x", 0)],
        "plan_final string, contract_type_final string, acq_channel string, churned int")
    g = RP.segment_gap(feats, ["plan_final"]).collect()[0]
    assert (g.worst_segment, g.best_segment) == ("Basic", "(none)")
    assert abs(g.gap_pp - 200 / 3) < 1e-9 and g.rate_ratio is None  # best rate 0 -> ratio undefined
    inside = {r.scope: r for r in RP.segment_gap(feats, ["contract_type_final"], "plan_final").collect()}
    assert inside["Basic"].worst_segment == "Monthly" and inside["Basic"].gap_pp == 100.0


def test_invariants_on_test_data(spark):
    silver = silver_from_testdata(spark, SF_SMALL, TESTDATA_PARAMS)
    gold = gold_from_testdata(spark, SF_SMALL, TESTDATA_PARAMS)
    n_cust = silver[S.CUSTOMERS].count()
    assert silver[S.CUSTOMERS].select("customer_id").distinct().count() == n_cust
    # a customer has a row per subscription, at least one
    rows = gold.groupBy("customer_id").count()
    assert rows.count() == n_cust and gold.count() > n_cust
    n_gold = gold.count()
    # segment counts add up to the base; churned never exceeds the total
    for df, base in ((RP.churn_by_plan(silver[S.SUBSCRIPTIONS]), silver[S.SUBSCRIPTIONS].count()),
                     (RP.churn_by_tenure(gold), n_gold), (RP.churn_by_engagement(gold), n_gold)):
        cols = df.columns
        total_col = "total_customers" if "total_customers" in cols else "customers"
        agg = df.agg(F.sum(total_col).alias("t"), F.sum("churned_customers").alias("c")).collect()[0]
        assert agg.t == base and agg.c <= agg.t
    # running total's last row equals the total
    trend = RP.churn_trend_monthly(silver[S.SUBSCRIPTIONS]).collect()
    assert trend[-1].cumulative_churned == sum(r.churned_count for r in trend)
    # flag set <=> value nulled
    subs = silver[S.SUBSCRIPTIONS]
    assert subs.where((F.col("sub_flag") != "") & F.col("churn_date").isNotNull()).count() == 0
    cust = silver[S.CUSTOMERS]
    assert cust.where((F.col("age_flag") == "NEGATIVE_AGE") & F.col("age").isNotNull()).count() == 0
    assert cust.where(F.col("age") < 0).count() == 0
    assert silver[S.USAGE].where((F.col("logins") < 0) | (F.col("features_used") < 0)).count() == 0


def test_dense_calendar_fills_months_without_churn(spark):
    subs = spark.createDataFrame([
        ("a", 10.0, D(2024, 1, 5), "Churned"), ("c", 5.0, D(2024, 3, 1), "Churned"),
    ], "customer_id string, mrr double, churn_date date, status string")
    rows = RP.churn_trend_monthly(subs, dense_calendar=True).collect()
    assert [(r.churn_month, r.churned_count, r.change_vs_prev_month, r.cumulative_churned) for r in rows] == [
        (D(2024, 1, 1), 1, None, 1), (D(2024, 2, 1), 0, -1, 1), (D(2024, 3, 1), 1, 1, 2)]


def test_recency_upper_bound(spark):
    from churnlens.operators.features import recent_logins
    from churnlens.params import ChurnParams
    usage = spark.createDataFrame([("a", D(2025, 4, 1), 3, False), ("a", D(2025, 7, 1), 5, False)],
                                  "customer_id string, month date, logins long, orphan_flag boolean")
    open_ended = recent_logins(usage, ChurnParams()).collect()[0].logins_last90d
    bounded = recent_logins(usage, ChurnParams(recency_upper_bound=True)).collect()[0].logins_last90d
    assert (open_ended, bounded) == (8, 3)
