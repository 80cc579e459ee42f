"""All segment rates of a run from two passes with grouping sets.

``star_segments`` joins customers and subscriptions (summed per customer, plan and contract) once and
aggregates the plan, plan x contract and channel reports together; ``flat_segments`` does the same for
the tenure, engagement and channel-volume reports of the flat table. Each row is counted for every set it
belongs to in the partial aggregate, so one shuffle of few rows serves all reports. The reports are
read off the written rows and equal those of ``reports.py``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnlens.functions.numeric import pct_half_up
from churnlens.operators.reports import _by_rate, _label_rank, _per_key
from churnlens.params import ENGAGEMENT_LABELS, TENURE_LABELS, ChurnParams

PLAN, PLAN_CONTRACT, CHANNEL, TENURE, ENGAGEMENT = "plan", "plan x contract", "channel", "tenure", "engagement"


def _set_name(sets: dict[str, tuple[str, ...]], columns: list[str]) -> Column:
    """The name of a row's grouping set, by the bits of the columns that it leaves out."""
    out = F.lit(None).cast("string")
    for name, keys in sets.items():
        left_out = sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in keys)
        out = F.when(F.grouping_id() == left_out, F.lit(name)).otherwise(out)
    return out


def star_segments(customers: DataFrame, subscriptions: DataFrame, params: ChurnParams) -> DataFrame:
    """segmentation, plan, contract_type, acq_channel, total, churned, churn_rate_pct, avg_tenure_days,
    avg_mrr. Plans count subscriptions (with or without a customer), the other segments customers with
    their subscriptions; a customer without one counts as one row. NULL ids match nothing, as in SQL."""
    subs = subscriptions.select("customer_id", F.col("plan").alias("s_plan"), F.col("contract_type").alias("s_contract"),
                                "status", "mrr", "signup_date", "churn_date")
    units = _per_key(subs, "customer_id", "s_plan", "s_contract", params=params)
    known = customers.select("customer_id", "plan", "contract_type", "acq_channel", F.lit(True).alias("customer"))
    both = known.join(units, "customer_id", "full").select(
        "s_plan", F.coalesce("s_plan", "plan").alias("plan_final"), F.coalesce("s_contract", "contract_type").alias("contract_final"),
        "acq_channel", "customer", "n", "c", "mrr_sum", "mrr_n", "days_sum", "days_n")
    sets = {PLAN: ("s_plan",), PLAN_CONTRACT: ("plan_final", "contract_final"), CHANNEL: ("acq_channel",)}
    columns = ["s_plan", "plan_final", "contract_final", "acq_channel"]
    of_customer = F.col("customer").isNotNull()
    sums = {k: F.sum(F.when(of_customer, F.col(k))) for k in ("c", "mrr_sum", "mrr_n", "days_sum", "days_n")}
    grouped = both.groupingSets([list(keys) for keys in sets.values()], *columns).agg(
        _set_name(sets, columns).alias("segmentation"),
        F.count(F.col("n")).alias("units"), F.sum("n").alias("sub_n"), F.sum("c").alias("sub_c"),
        F.count_if(of_customer).alias("customers"), F.sum(F.when(of_customer, F.coalesce(F.col("n"), F.lit(1)))).alias("cust_n"),
        *[c.alias(f"cust_{k}") for k, c in sums.items()])
    by_plan = F.col("segmentation") == PLAN
    total = F.when(by_plan, F.col("sub_n")).otherwise(F.col("cust_n"))
    churned = F.coalesce(F.when(by_plan, F.col("sub_c")).otherwise(F.col("cust_c")), F.lit(0))

    def mean(value: str, n: str) -> Column:
        return F.when(~by_plan, F.round(F.try_divide(F.col(value).cast("double"), F.col(n)), 0))
    rows = grouped.where(F.when(by_plan, F.col("units") > 0).otherwise(F.col("customers") > 0))
    return rows.select(
        "segmentation", F.coalesce("s_plan", "plan_final").alias("plan"), F.col("contract_final").alias("contract_type"), "acq_channel",
        total.alias("total"), churned.cast("long").alias("churned"), pct_half_up(churned, total, 1).alias("churn_rate_pct"),
        mean("cust_days_sum", "cust_days_n").alias("avg_tenure_days"), mean("cust_mrr_sum", "cust_mrr_n").alias("avg_mrr"))


def flat_segments(features: DataFrame) -> DataFrame:
    """segmentation, tenure_bucket, engagement_tier, acq_channel, customers, churned_customers,
    churn_rate_pct of the flat table."""
    sets = {TENURE: ("tenure_bucket",), ENGAGEMENT: ("engagement_tier",), CHANNEL: ("acq_channel",)}
    columns = ["tenure_bucket", "engagement_tier", "acq_channel"]
    total, churned = F.count(F.lit(1)), F.sum("churned")
    return features.groupingSets([list(keys) for keys in sets.values()], *columns).agg(
        _set_name(sets, columns).alias("segmentation"), total.alias("customers"), churned.cast("long").alias("churned_customers"),
        pct_half_up(churned, total, 1).alias("churn_rate_pct"))


def _rows(segments: DataFrame, name: str) -> DataFrame:
    return segments.where(F.col("segmentation") == name)


def churn_by_plan_from(segments: DataFrame) -> DataFrame:
    """REP1."""
    out = _rows(segments, PLAN).select("plan", F.col("total").alias("total_customers"), F.col("churned").alias("churned_customers"),
                                       "churn_rate_pct")
    return _by_rate(out, "plan")


def churn_by_plan_contract_from(segments: DataFrame) -> DataFrame:
    """REP3."""
    out = _rows(segments, PLAN_CONTRACT).select(
        F.col("plan").alias("plan_final"), F.col("contract_type").alias("contract_type_final"), F.col("total").alias("total_customers"),
        F.col("churned").alias("churned_customers"), "churn_rate_pct", "avg_mrr")
    return _by_rate(out, "plan_final", "contract_type_final")


def channel_performance_from(segments: DataFrame) -> DataFrame:
    """REP5."""
    out = _rows(segments, CHANNEL).select("acq_channel", F.col("total").alias("total_customers"), "churn_rate_pct",
                                          "avg_tenure_days", "avg_mrr")
    return _by_rate(out, "acq_channel")


def churn_by_tenure_from(segments: DataFrame) -> DataFrame:
    """REP6."""
    return _rows(segments, TENURE).select("tenure_bucket", _label_rank("tenure_bucket", TENURE_LABELS).alias("tenure_bucket_rank"),
                                          *RATES).orderBy("tenure_bucket_rank")


def churn_by_engagement_from(segments: DataFrame) -> DataFrame:
    """REP7."""
    return _rows(segments, ENGAGEMENT).select(
        "engagement_tier", _label_rank("engagement_tier", ENGAGEMENT_LABELS).alias("engagement_tier_rank"), *RATES).orderBy("engagement_tier_rank")


def channel_volume_from(segments: DataFrame) -> DataFrame:
    """REP11."""
    w = Window.orderBy(F.col("customers").desc(), F.col("acq_channel").asc_nulls_first())
    return _rows(segments, CHANNEL).select("acq_channel", *RATES).withColumn(
        "volume_rank", F.row_number().over(w).cast("long")).orderBy("volume_rank")


RATES = ("customers", "churned_customers", "churn_rate_pct")
