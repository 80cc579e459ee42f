"""Churn reports over the star schema (silver) and the flat table (gold).

REP1-5 follow the SQL report definitions (plain SQL equality in joins, NULL groups kept,
ROUND half away from zero); REP6-11 are the findings computed from the flat table.
Every report aggregates first, so windows and orderings only see a handful of rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnlens.functions.buckets import ticket_bucket
from churnlens.functions.numeric import exact_mean, pct_half_up, safe_ratio
from churnlens.params import ENGAGEMENT_LABELS, STATUS_CHURNED, TENURE_LABELS, ChurnParams


def _is_churned():
    return F.when(F.col("status") == STATUS_CHURNED, F.lit(1)).otherwise(F.lit(0))


def _exact(c):
    """A money column as DECIMAL: its sums don't depend on the order rows arrive in."""
    return F.col(c).cast("decimal(20,6)")


def _per_key(subscriptions: DataFrame, *keys: str, params: ChurnParams | None = None) -> DataFrame:
    """Subscriptions reduced to one row per ``keys``: rows ``n``, churned ``c``, and the sums and
    counts behind the means of mrr and tenure (to the churn date or as_of, not clipped)."""
    aggs = [F.count(F.lit(1)).alias("n"), F.sum(_is_churned()).cast("long").alias("c")]
    if "mrr" in subscriptions.columns:
        aggs += [F.sum(_exact("mrr")).alias("mrr_sum"), F.count("mrr").alias("mrr_n")]
    if params is not None:
        tenure = F.datediff(F.coalesce(F.col("churn_date"), F.lit(params.as_of)), F.col("signup_date"))
        aggs += [F.sum(tenure).cast("long").alias("days_sum"), F.count(tenure).alias("days_n")]
    return subscriptions.groupBy(*keys).agg(*aggs)


def _mean(total: str, n: str, alias: str):
    """Mean of rows already summed per key, rounded to a whole number."""
    return F.round(F.try_divide(F.sum(total).cast("double"), F.sum(n)), 0).alias(alias)


def _rate_aggs(total_name: str = "total_customers", churned_name: str | None = "churned_customers"):
    """Rates over rows that stand for ``n`` rows with ``c`` churned; a customer without a
    subscription (n NULL) counts as one row."""
    total = F.sum(F.coalesce(F.col("n"), F.lit(1)))
    churned = F.coalesce(F.sum("c"), F.lit(0))
    aggs = [total.alias(total_name)]
    if churned_name:
        aggs.append(churned.cast("long").alias(churned_name))
    aggs.append(pct_half_up(churned, total, 1).alias("churn_rate_pct"))
    return aggs


def _by_rate(df: DataFrame, *tie_break: str) -> DataFrame:
    return df.orderBy(F.col("churn_rate_pct").desc_nulls_first(), *[F.col(c).asc_nulls_first() for c in tie_break])


def churn_by_plan(subscriptions: DataFrame) -> DataFrame:
    """REP1: customers, churned and churn % per subscription plan."""
    out = _per_key(subscriptions.select("plan", "status"), "plan").groupBy("plan").agg(*_rate_aggs())
    return _by_rate(out, "plan")


def churn_trend_monthly(subscriptions: DataFrame, dense_calendar: bool = False) -> DataFrame:
    """REP2: churned count and MRR lost per churn month, change vs previous month,
    running totals. The window runs over the monthly aggregate (one row per month).

    By default only months with churn appear and "previous month" is the previous such month
    (as in the SQL). With ``dense_calendar`` every month between the first and the last churn
    month is listed, months without churn count 0 and MRR 0.
    """
    monthly = (subscriptions
               .where((F.col("status") == STATUS_CHURNED) & F.col("churn_date").isNotNull())
               .groupBy(F.trunc("churn_date", "MM").alias("churn_month"))
               .agg(F.count(F.lit(1)).alias("churned_count"), F.sum(_exact("mrr")).alias("mrr_lost")))
    if dense_calendar:
        span = monthly.agg(F.min("churn_month").alias("lo"), F.max("churn_month").alias("hi"))
        calendar = span.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 MONTH"))).alias("churn_month"))
        monthly = (calendar.join(monthly, "churn_month", "left")
                   .select("churn_month", F.coalesce("churned_count", F.lit(0)).alias("churned_count"),
                           F.coalesce("mrr_lost", F.lit(0)).cast("decimal(30,6)").alias("mrr_lost")))
    w = Window.orderBy("churn_month")
    running = w.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return (monthly.select(
        "churn_month", "churned_count", F.col("mrr_lost").cast("double").alias("mrr_lost"),
        # NULL for the first month; DOUBLE like the other nullable numeric outputs
        (F.col("churned_count") - F.lag("churned_count", 1).over(w)).cast("double").alias("change_vs_prev_month"),
        F.sum("churned_count").over(running).alias("cumulative_churned"),
        F.sum("mrr_lost").over(running).cast("double").alias("cumulative_mrr_lost"),
    ).orderBy("churn_month"))


def churn_by_plan_contract(customers: DataFrame, subscriptions: DataFrame,
                           params: ChurnParams | None = None) -> DataFrame:
    """REP3: churn % and mean MRR per (plan, contract), subscription values first (SQL equality:
    NULL ids do not match). Subscriptions are summed per customer, plan and contract before the
    join, so a key with many of them is a few rows there."""
    s = _per_key(subscriptions.select("customer_id", F.col("plan").alias("s_plan"),
                                      F.col("contract_type").alias("s_contract_type"), "status", "mrr"),
                 "customer_id", "s_plan", "s_contract_type")
    j = customers.select("customer_id", "plan", "contract_type").join(s, "customer_id", "left")
    out = (j.groupBy(F.coalesce("s_plan", "plan").alias("plan_final"),
                     F.coalesce("s_contract_type", "contract_type").alias("contract_type_final"))
           .agg(*_rate_aggs(), _mean("mrr_sum", "mrr_n", "avg_mrr")))
    return _by_rate(out, "plan_final", "contract_type_final")


def churn_by_ticket_bucket(subscriptions: DataFrame, tickets: DataFrame) -> DataFrame:
    """REP4: churn % per ticket-volume bucket; all tickets count, orphans included. Both tables are
    summed per customer before the join."""
    per_customer = tickets.groupBy("customer_id").agg(F.count(F.lit(1)).alias("total_tickets"))
    subs = _per_key(subscriptions.select("customer_id", "status"), "customer_id")
    j = subs.join(per_customer, "customer_id", "left")
    out = (j.groupBy(ticket_bucket("total_tickets").alias("ticket_bucket"))
           .agg(*_rate_aggs("customers", None)))
    return _by_rate(out, "ticket_bucket")


def channel_performance(customers: DataFrame, subscriptions: DataFrame, params: ChurnParams) -> DataFrame:
    """REP5: per acquisition channel: customers, churn %, mean tenure (to churn date or
    as_of, not clipped) and mean MRR. Subscriptions are summed per customer before the join."""
    s = _per_key(subscriptions.select("customer_id", "status", "mrr", "signup_date", "churn_date"),
                 "customer_id", params=params)
    j = customers.select("customer_id", "acq_channel").join(s, "customer_id", "left")
    out = (j.groupBy("acq_channel")
           .agg(*_rate_aggs(churned_name=None), _mean("days_sum", "days_n", "avg_tenure_days"),
                _mean("mrr_sum", "mrr_n", "avg_mrr")))
    return _by_rate(out, "acq_channel")


# ---------------------------------------------------------------------------
# Findings over the flat table
# ---------------------------------------------------------------------------

def _segment_rates(features: DataFrame, label: str, rank_expr=None) -> DataFrame:
    total = F.count(F.lit(1))
    churned = F.sum("churned")
    keys = [F.col(label)] if rank_expr is None else [F.col(label), rank_expr.alias(f"{label}_rank")]
    return features.groupBy(*keys).agg(
        total.alias("customers"), churned.cast("long").alias("churned_customers"),
        pct_half_up(churned, total, 1).alias("churn_rate_pct"))


def _label_rank(label: str, labels) -> F.Column:
    """Position of the label in its ordered category; a NULL label sorts last."""
    out = None
    for i, v in enumerate(labels):
        out = F.when(F.col(label) == v, F.lit(i)) if out is None else out.when(F.col(label) == v, F.lit(i))
    return out.otherwise(F.lit(len(labels)))


def churn_by_tenure(features: DataFrame) -> DataFrame:
    """REP6: churn % per tenure bucket (NULL bucket kept: churned without a churn date)."""
    out = _segment_rates(features, "tenure_bucket", _label_rank("tenure_bucket", TENURE_LABELS))
    return out.orderBy("tenure_bucket_rank")


def churn_by_engagement(features: DataFrame) -> DataFrame:
    """REP7: churn % per engagement tier."""
    out = _segment_rates(features, "engagement_tier", _label_rank("engagement_tier", ENGAGEMENT_LABELS))
    return out.orderBy("engagement_tier_rank")


def _churned_vs_active(features: DataFrame, column: str, scale: int) -> DataFrame:
    is_c = F.col("churned") == 1
    churned_mean = exact_mean(F.when(is_c, F.col(column)), scale)
    active_mean = exact_mean(F.when(~is_c, F.col(column)), scale)
    return (features.agg(churned_mean.alias("churned_mean"), active_mean.alias("active_mean"))
            .select(F.lit(column).alias("metric"), "churned_mean", "active_mean",
                    (F.try_divide(F.col("churned_mean") - F.col("active_mean"), F.col("active_mean"))
                     * F.lit(100.0)).alias("pct_difference")))


def churned_vs_active_logins(features: DataFrame) -> DataFrame:
    """REP8: mean monthly logins of churned vs active customers and the % difference."""
    return _churned_vs_active(features, "avg_monthly_logins", 2)


def churned_vs_active_tickets(features: DataFrame) -> DataFrame:
    """REP9: mean ticket count of churned vs active customers and the % difference."""
    return _churned_vs_active(features, "total_tickets", 0)


SEGMENTATIONS = (
    ("plan", ("plan_final",), None),
    ("plan x contract", ("plan_final", "contract_type_final"), None),
    ("acquisition channel", ("acq_channel",), None),
    ("contract within plan", ("contract_type_final",), "plan_final"),
)
NO_VALUE = "(none)"


def segment_gaps(features: DataFrame, segmentations=SEGMENTATIONS) -> DataFrame:
    """REP10: per segmentation (and scope), the worst and best churn segment, the gap in
    percentage points and the rate ratio.

    ``segmentations`` are (name, dims, within): segments are the distinct values of ``dims``
    (joined with " + ", NULL shown as "(none)"); with ``within`` the comparison runs inside each
    value of that column. One pass: every row is exploded into its segment of each segmentation
    (a fixed fan-out), aggregated once, and worst / best are picked per scope with row numbers
    (ties go to the alphabetically first segment) and a conditional aggregate, without a join.
    """
    labels = []
    for name, dims, within in segmentations:
        label = F.concat_ws(" + ", *[F.coalesce(F.col(d), F.lit(NO_VALUE)) for d in dims])
        scope = F.coalesce(F.col(within), F.lit(NO_VALUE)) if within else F.lit("all")
        labels.append(F.struct(F.lit(name).alias("segmentation"), scope.alias("scope"), label.alias("segment")))
    rows = features.select(F.explode(F.array(*labels)).alias("s"), "churned").select("s.*", "churned")
    seg = (rows.groupBy("segmentation", "scope", "segment")
           .agg(F.count(F.lit(1)).alias("n"), F.sum("churned").cast("long").alias("c"))
           .withColumn("rate", safe_ratio("c", "n")))
    by_scope = Window.partitionBy("segmentation", "scope")
    worst = (F.row_number().over(by_scope.orderBy(F.col("rate").desc(), F.col("segment"))) == 1)
    best = (F.row_number().over(by_scope.orderBy(F.col("rate").asc(), F.col("segment"))) == 1)
    ends = seg.select("*", worst.alias("is_worst"), best.alias("is_best")).where(F.col("is_worst") | F.col("is_best"))
    picked = ends.groupBy("segmentation", "scope").agg(
        F.max(F.when(F.col("is_worst"), F.col("segment"))).alias("worst_segment"),
        F.max(F.when(F.col("is_worst"), F.col("rate"))).alias("worst_rate"),
        F.max(F.when(F.col("is_best"), F.col("segment"))).alias("best_segment"),
        F.max(F.when(F.col("is_best"), F.col("rate"))).alias("best_rate"))
    return picked.select(
        "segmentation", "scope",
        "worst_segment", (F.col("worst_rate") * F.lit(100.0)).alias("worst_rate_pct"),
        "best_segment", (F.col("best_rate") * F.lit(100.0)).alias("best_rate_pct"),
        ((F.col("worst_rate") - F.col("best_rate")) * F.lit(100.0)).alias("gap_pp"),
        F.try_divide(F.col("worst_rate"), F.col("best_rate")).alias("rate_ratio"),
    )


def segment_gap(features: DataFrame, dims, within: str | None = None, name: str | None = None) -> DataFrame:
    """REP10 for one segmentation."""
    return segment_gaps(features, [(name or " x ".join(dims), tuple(dims), within)])


def channel_volume(features: DataFrame) -> DataFrame:
    """REP11: customers per acquisition channel, ranked by volume, with churn %."""
    seg = _segment_rates(features, "acq_channel")
    w = Window.orderBy(F.col("customers").desc(), F.col("acq_channel").asc_nulls_first())
    return seg.withColumn("volume_rank", F.row_number().over(w).cast("long")).orderBy("volume_rank")
