"""Customer features and the flat table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from churnlens.operators.features import FEATURE_COLUMNS, customer_features, summary_kpis
from churnlens.params import ChurnParams

P = ChurnParams(as_of=dt.date(2025, 6, 1))
D = dt.date


def _tables(spark):
    customers = spark.createDataFrame([
        ("a", 30.0, "Asia", D(2024, 1, 1), "Basic", "Social", "Monthly", ""),
        ("b", None, "Europe", D(2023, 1, 1), "Premium", "Organic", "Annual", "NEGATIVE_AGE"),
        ("c", 40.0, None, D(2025, 5, 1), "Standard", "Referral", "Monthly", ""),
        (None, 22.0, "Asia", D(2024, 6, 1), "Basic", "Partner", "Monthly", ""),
    ], "customer_id string, age double, region string, signup_date date, plan string, acq_channel string, "
       "contract_type string, age_flag string")
    subs = spark.createDataFrame([
        ("a", "Standard", 50.0, None, D(2024, 2, 1), D(2025, 1, 1), "Churned", ""),
        ("b", None, 80.0, "Monthly", D(2023, 1, 1), None, "Churned", "CHURN_BEFORE_SIGNUP"),
        (None, "Premium", 99.0, "Annual", D(2024, 6, 1), None, "Active", ""),
    ], "customer_id string, plan string, mrr double, contract_type string, signup_date date, churn_date date, "
       "status string, sub_flag string")
    usage = spark.createDataFrame([
        ("a", D(2025, 3, 1), 10, 1, 5.0, False),    # before the 2025-03-03 cutoff
        ("a", D(2025, 4, 1), 3, None, 7.0, False),
        ("a", D(2025, 5, 1), None, 2, None, False),
        ("c", D(2025, 5, 1), 0, 0, 0.0, False),
        ("zz", D(2025, 5, 1), 99, 9, 9.0, True),     # orphan: ignored
    ], "customer_id string, month date, logins long, features_used long, active_minutes double, orphan_flag boolean")
    tickets = spark.createDataFrame([
        ("1", "a", D(2025, 4, 1), "Critical", "Billing", "No", False),
        ("2", "a", D(2024, 4, 1), "Low", "Billing", "Yes", False),
        ("3", "zz", D(2025, 4, 1), "Critical", "Billing", "No", True),
    ], "ticket_id string, customer_id string, created_date date, priority string, category string, "
       "resolved string, orphan_flag boolean")
    return customers, subs, usage, tickets


def test_flat_table_rules(spark):
    df = customer_features(*_tables(spark), P)
    assert tuple(df.columns) == FEATURE_COLUMNS and len(df.columns) == 32
    rows = {r.customer_id: r for r in df.collect()}
    a, b, c, n = rows["a"], rows["b"], rows["c"], rows[None]
    # subscription first, customer fallback
    assert (a.plan_final, a.contract_type_final) == ("Standard", "Monthly")
    # churned: tenure to churn date from the subscription signup
    assert a.churned == 1 and a.tenure_days == (D(2025, 1, 1) - D(2024, 2, 1)).days and a.tenure_bucket == "6-12m"
    # usage: mean over non-null values, count of months, last month, 90-day logins from 2025-03-03 on
    assert a.avg_monthly_logins == 6.5 and a.avg_features_used == 1.5 and a.avg_active_minutes == 6.0
    assert a.total_months_with_data == 3 and a.last_active_month == D(2025, 5, 1) and a.logins_last90d == 3
    assert a.days_since_last_active == 31 and a.engagement_tier == "Medium"
    assert (a.total_tickets, a.unresolved_tickets, a.critical_tickets, a.tickets_last90d) == (2, 1, 1, 1)
    # churned without a churn date -> tenure NULL, bucket NULL, still churned
    assert b.churned == 1 and b.tenure_days is None and b.tenure_bucket is None and b.plan_final == "Premium"
    # no subscription: not churned, tenure to as_of from the customer signup; zero-filled counts
    assert c.churned == 0 and c.tenure_days == 31 and c.plan_final == "Standard" and c.sub_flag is None
    assert c.engagement_tier == "Inactive" and c.total_tickets == 0 and c.days_since_last_active == 31
    # NULL customer key joins the NULL subscription key (as pandas merge does)
    assert n.plan_sub == "Premium" and n.mrr == 99.0 and n.days_since_last_active is None
    assert n.avg_monthly_logins == 0.0 and n.engagement_tier == "Inactive"


def test_summary_kpis(spark):
    df = customer_features(*_tables(spark), P)
    k = summary_kpis(df).collect()[0]
    assert (k.total_customers, k.churned_customers, k.active_customers) == (4, 2, 2)
    assert k.churn_rate_pct == 50.0


def test_rows_equal_customers_when_subscription_key_unique(spark):
    customers, subs, usage, tickets = _tables(spark)
    df = customer_features(customers, subs, usage, tickets, P)
    assert df.count() == customers.count()
    assert df.where(F.col("customer_id") == "zz").count() == 0


def test_a_customer_with_many_subscriptions(spark):
    customers, subs, usage, tickets = _tables(spark)
    many = subs.where(F.col("customer_id") == "a")
    for _ in range(4):
        many = many.unionByName(many)
    df = customer_features(customers, subs.unionByName(many), usage, tickets, P)
    assert df.count() == (customers.count() - 1) + 17  # "a": 1 + 16 copies
    once = customer_features(customers, subs, usage, tickets, P)
    assert df.exceptAll(once).distinct().count() == 1 and once.exceptAll(df).count() == 0


def test_columns_beyond_the_known_ones_reach_the_flat_table(spark):
    customers, subs, usage, tickets = _tables(spark)
    c = customers.withColumns({"email": F.lit("e"), "note": F.lit("c")})
    s = subs.withColumns({"seats": F.lit(3), "note": F.lit("s")})
    df = customer_features(c, s, usage, tickets, P)
    plain = customer_features(customers, subs, usage, tickets, P)
    assert df.columns == [*plain.columns, "email", "note_cust", "seats", "note_sub"]
    assert df.drop("email", "note_cust", "seats", "note_sub").exceptAll(plain).count() == 0
    assert {r.email for r in df.collect()} == {"e"}


def test_standalone_usage_and_ticket_aggregates(spark):
    from churnlens.operators.features import recent_logins, recent_tickets, ticket_features, usage_features
    _, _, usage, tickets = _tables(spark)
    usage = usage.unionByName(spark.createDataFrame(
        [("c", D(2025, 4, 1), None, None, None, False), (None, D(2025, 4, 1), 5, 5, 5.0, False)],
        usage.schema))
    u = {r.customer_id: r for r in usage_features(usage).collect()}
    assert set(u) == {"a", "c"}                        # orphan and NULL key left out
    assert (u["a"].avg_monthly_logins, u["a"].total_months_with_data, u["a"].last_active_month) == (6.5, 3, D(2025, 5, 1))
    assert (u["c"].avg_monthly_logins, u["c"].total_months_with_data) == (0.0, 2)
    r = {x.customer_id: x.logins_last90d for x in recent_logins(usage, P).collect()}
    assert r == {"a": 3, "c": 0}                       # a NULL-only sum is 0, as in pandas
    t = {x.customer_id: (x.total_tickets, x.unresolved_tickets, x.critical_tickets)
         for x in ticket_features(tickets).collect()}
    assert t == {"a": (2, 1, 1)}
    assert {x.customer_id: x.tickets_last90d for x in recent_tickets(tickets, P).collect()} == {"a": 1}


def test_presence_flagged_join_equals_a_left_join(spark):
    """Hot, NULL, missing and unique keys, any number of salts."""
    from churnlens.operators.joins import left_join_unique
    left = spark.createDataFrame([("hot", False, 1), ("", True, 2), ("none", False, 3), ("one", False, 4)],
                                 "_jk string, _jk_null boolean, a int")
    right = spark.createDataFrame([("hot", False, i) for i in range(500)] + [("", True, i) for i in range(70)]
                                  + [("one", False, 1), ("one", False, 1), ("other", False, 9)], "_jk string, _jk_null boolean, b int")
    want = left.join(right, ["_jk", "_jk_null"], "left")
    for salts in (1, 3, 40):
        got = left_join_unique(left, right, ["_jk", "_jk_null"], salts)
        assert got.columns == want.columns
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert left_join_unique(left, right.limit(0), ["_jk", "_jk_null"]).count() == 4
