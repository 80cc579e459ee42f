"""Cleaning operators on small hand-made tables."""

from __future__ import annotations

import datetime as dt

from churnlens import schemas as S
from churnlens.operators.clean import clean_customers, clean_subscriptions, clean_tickets, clean_usage, dedupe_first
from churnlens.params import ChurnParams

P = ChurnParams()
CUST_SCHEMA = ("customer_id string, age double, region string, signup_date string, plan string, "
               "acq_channel string, contract_type string, _ingest_order struct<seq:int,k:long>")


def _customers(spark, rows):
    return spark.createDataFrame(rows, CUST_SCHEMA)


def test_dedupe_keeps_first_in_ingest_order_including_null_key(spark):
    rows = [
        ("a", 30.0, "x", "2024-01-01", "basic", "Social", "monthly", (1, 5)),
        ("a", 31.0, "y", "2024-01-01", "basic", "Social", "monthly", (0, 9)),
        (None, 40.0, "first-null", "2024-01-01", "basic", "Social", "monthly", (0, 1)),
        (None, 41.0, "second-null", "2024-01-01", "basic", "Social", "monthly", (0, 2)),
        ("b", 50.0, "z", "2024-01-01", "basic", "Social", "monthly", (0, 3)),
    ]
    out = {r.customer_id: r for r in dedupe_first(_customers(spark, rows), "customer_id", S.INGEST_ORDER).collect()}
    assert len(out) == 3
    assert out["a"].region == "y"
    assert out[None].region == "first-null"


def test_clean_customers_flags_negative_age_and_standardises(spark):
    rows = [("c1", -5.0, " middle east ", "03-04-2024", "BASIC", "paid search", "ANNUAL ", (0, 1)),
            ("c2", None, None, "13-04-2024", "pRO-plus", "SOCIAL", "monthly", (0, 2)),
            ("c3", 44.0, "asia", "junk", None, " Organic", "monthly", (0, 3))]
    out = {r.customer_id: r for r in clean_customers(_customers(spark, rows), P).collect()}
    assert out["c1"].age is None and out["c1"].age_flag == "NEGATIVE_AGE"
    assert out["c1"].region == "Middle East" and out["c1"].acq_channel == "Paid Search"
    assert out["c1"].contract_type == "Annual" and out["c1"].signup_date == dt.date(2024, 3, 4)
    assert out["c2"].age is None and out["c2"].age_flag == ""
    assert out["c2"].plan == "Pro-Plus" and out["c2"].signup_date == dt.date(2024, 4, 13)
    assert out["c3"].signup_date is None and out["c3"].plan is None and out["c3"].age == 44.0
    assert S.INGEST_ORDER not in clean_customers(_customers(spark, rows), P).columns


SUB_SCHEMA = ("customer_id string, plan string, mrr double, contract_type string, signup_date string, "
              "churn_date string, status string")


def test_subscription_flags_first_match_wins(spark):
    rows = [
        ("a", "basic", 10.0, "monthly", "2024-05-01", "2024-01-01", " active"),   # active + date (also < signup)
        ("b", "basic", 10.0, "monthly", "2024-05-01", "2024-01-01", "CHURNED"),   # churn before signup
        ("c", "basic", 10.0, "monthly", "2024-05-01", "2024-06-01", "churned"),   # fine
        ("d", "basic", 10.0, "monthly", "2024-05-01", None, "Active"),            # fine
        ("e", "basic", 10.0, "monthly", "2024-05-01", "not a date", "Churned"),   # unparsable -> null, no flag
    ]
    out = {r.customer_id: r for r in clean_subscriptions(spark.createDataFrame(rows, SUB_SCHEMA), P).collect()}
    assert (out["a"].sub_flag, out["a"].churn_date) == ("ACTIVE_WITH_CHURN_DATE", None)
    assert (out["b"].sub_flag, out["b"].churn_date) == ("CHURN_BEFORE_SIGNUP", None)
    assert (out["c"].sub_flag, out["c"].churn_date) == ("", dt.date(2024, 6, 1))
    assert out["d"].sub_flag == "" and out["e"].sub_flag == "" and out["e"].churn_date is None
    assert out["a"].status == "Active" and out["b"].status == "Churned"


def test_orphan_flags_null_safe_and_clip(spark):
    cust = spark.createDataFrame([("a",), (None,)], "customer_id string")
    tix = spark.createDataFrame(
        [("1", "a", "2024-01-01", " critical", "billing", "no"), ("2", "zz", "2024-01-02", "HIGH", "x", "YES "),
         ("3", None, "2024-01-03", "low", "x", "no")],
        "ticket_id string, customer_id string, created_date string, priority string, category string, resolved string")
    t = {r.ticket_id: r for r in clean_tickets(tix, cust, P).collect()}
    assert [t[k].orphan_flag for k in "123"] == [False, True, False]
    assert t["1"].priority == "Critical" and t["1"].resolved == "No" and t["2"].resolved == "Yes"

    usage = spark.createDataFrame(
        [("a", "2024-01-01", -3, None, -1.5), ("b", "2024-02-01", 4, 2, 7.0)],
        "customer_id string, month string, logins long, features_used long, active_minutes double")
    u = {r.customer_id: r for r in clean_usage(usage, cust, P).collect()}
    assert (u["a"].logins, u["a"].features_used, u["a"].active_minutes) == (0, None, 0.0)
    assert u["a"].orphan_flag is False and u["b"].orphan_flag is True
    assert u["b"].month == dt.date(2024, 2, 1)


def test_cleaning_is_idempotent(spark):
    rows = [("c1", 30.0, " middle east ", "2024-03-04", "BASIC", "paid search", "ANNUAL ", (0, 1))]
    once = clean_customers(_customers(spark, rows), P)
    again = clean_customers(once.drop("age_flag").withColumn("signup_date", once.signup_date.cast("string")), P)
    assert once.collect() == again.collect()


def test_full_row_duplicates_exact_with_nulls(spark):
    from churnlens.operators.profile import _extra_rows
    rows = [("a", None, 1), ("a", None, 1), (None, "a", 1), ("a", "b", 2), ("a", "b", 2), ("a", "b", 2), ("c", "d", 3)]
    df = spark.createDataFrame(rows, "x string, y string, z int")
    r = _extra_rows(df, ["x", "y", "z"]).collect()[0]
    assert (r.total, r.extra, r.groups) == (7, 3, 4)
    k = _extra_rows(df, ["x"]).collect()[0]
    assert (k.total, k.extra, k.groups) == (7, 4, 3)


def test_repairs_count_lost_and_day_first_dates(spark):
    from churnlens.operators.profile import _date_losses
    rows = [("c1", 1.0, "x", "03-04-2024", "b", "s", "m", (0, 1)),
            ("c2", 1.0, "x", "13-04-2024", "b", "s", "m", (0, 2)),
            ("c3", 1.0, "x", "junk", "b", "s", "m", (0, 3)),
            ("c4", 1.0, "x", None, "b", "s", "m", (0, 4))]
    subs = spark.createDataFrame([("c1", "b", 1.0, "m", "2024-01-01", "31/12/2024", "Churned")], SUB_SCHEMA)
    empty = {"ticket_id": "string", "customer_id": "string", "created_date": "string"}
    tix = spark.createDataFrame([("1", "c1", "2024-01-01")], ", ".join(f"{k} {v}" for k, v in empty.items()))
    usage = spark.createDataFrame([("c1", "2024-13-01")], "customer_id string, month string")
    raw = {S.CUSTOMERS: _customers(spark, rows), S.SUBSCRIPTIONS: subs, S.TICKETS: tix, S.USAGE: usage}
    got = {(r.section, r.metric): r.value for df in _date_losses(raw, P) for r in df.collect()}
    assert got[("customers", "signup_date_day_first")] == 1 and got[("customers", "signup_date_lost")] == 1
    assert got[("subscriptions", "churn_date_lost")] == 1 and got[("subscriptions", "signup_date_lost")] == 0
    assert got[("tickets", "created_date_lost")] == 0 and got[("usage", "month_lost")] == 1


def test_left_join_unique_equals_left_join(spark):
    from churnlens.operators.joins import left_join_unique
    left = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3), (None, 4)], "k string, l int")
    right_rows = [("a", i) for i in range(50)] + [("a", 1), ("b", 1), ("zz", 7), (None, 8), (None, 9)]
    right = spark.createDataFrame(right_rows, "k string, r int")
    plain = left.join(right, ["k"], "left")
    got = left_join_unique(left, right, ["k"])
    assert got.columns == plain.columns
    assert sorted(got.collect(), key=repr) == sorted(plain.collect(), key=repr)


def test_orphan_flag_on_hot_and_null_ids(spark):
    from churnlens.operators.joins import flag_missing_key
    facts = spark.createDataFrame([(f"t{i}", "gone") for i in range(40)] + [("x", "a"), ("y", None), ("y", None)],
                                  "ticket_id string, customer_id string")
    for keys, null_known in (([("a",), ("a",)], False), ([("a",), (None,)], True)):
        rows = flag_missing_key(facts, spark.createDataFrame(keys, "customer_id string"), "customer_id", "o").collect()
        assert len(rows) == 43
        assert {(r.customer_id, r.o) for r in rows} == {("gone", True), ("a", False), (None, not null_known)}
