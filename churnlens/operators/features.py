"""Customer-grain aggregates and the flat analytical table (gold).

Fact tables are reduced to one row per customer *before* any join (no fan-out), each in a
single scan: lifetime and 90-day figures come out of one aggregate with conditional
columns. In the flat table every grouping and join uses the same key columns (``JOIN_KEY``),
so the inputs share one hash partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.functions.buckets import engagement_tier, tenure_bucket
from churnlens.functions.numeric import clip_lower, np_round
from churnlens.operators.joins import JOIN_KEY, left_join_unique, with_join_key
from churnlens.params import PRIORITY_CRITICAL, RESOLVED_NO, STATUS_CHURNED, ChurnParams

USAGE_AVERAGES = {
    "avg_monthly_logins": "logins",
    "avg_features_used": "features_used",
    "avg_active_minutes": "active_minutes",
}
ZERO_FILL = (
    "total_tickets", "unresolved_tickets", "critical_tickets", "tickets_last90d", "logins_last90d",
    "avg_monthly_logins", "avg_features_used", "avg_active_minutes", "total_months_with_data",
)


def _known(df: DataFrame) -> DataFrame:
    """Rows of known customers; groupings ignore a NULL key, as pandas does."""
    return df.where(~F.col("orphan_flag") & F.col("customer_id").isNotNull())


def _keyed(df: DataFrame) -> DataFrame:
    """Rows with a customer key. Used where a later LEFT JOIN from customers drops unknown
    customers anyway, so the orphan flag (a join against customers) need not be evaluated."""
    return df.where(F.col("customer_id").isNotNull())


def in_recency_window(c, params: ChurnParams):
    """``c >= as_of - recency_days`` (inclusive); no upper bound unless ``recency_upper_bound``."""
    col = F.col(c) if isinstance(c, str) else c
    cond = col >= F.lit(params.cutoff)
    if params.recency_upper_bound:
        cond = cond & (col <= F.lit(params.as_of))
    return cond


def _usage_lifetime_aggs():
    return [
        *[np_round(F.avg(src), 2).alias(name) for name, src in USAGE_AVERAGES.items()],
        F.count("month").alias("total_months_with_data"),
        F.max("month").alias("last_active_month"),
    ]


def usage_features(usage: DataFrame) -> DataFrame:
    """Lifetime usage per customer: mean logins / features / minutes (2 dp), months, last month."""
    return _known(usage).groupBy("customer_id").agg(*_usage_lifetime_aggs())


def recent_logins(usage: DataFrame, params: ChurnParams) -> DataFrame:
    """Logins summed over months on or after as_of - recency_days (see ``in_recency_window``)."""
    recent = _known(usage).where(in_recency_window("month", params))
    return recent.groupBy("customer_id").agg(
        F.coalesce(F.sum("logins"), F.lit(0)).cast("long").alias("logins_last90d"))


def usage_customer_agg(usage: DataFrame, params: ChurnParams, known_only: bool = True,
                       by: tuple[str, ...] = ("customer_id",)) -> DataFrame:
    """``usage_features`` and ``recent_logins`` in one pass over the usage facts."""
    in_window = in_recency_window("month", params)
    rows = _known(usage) if known_only else _keyed(usage)
    if by == JOIN_KEY:
        rows = with_join_key(rows)
    return rows.groupBy(*by).agg(
        *_usage_lifetime_aggs(),
        F.sum(F.when(in_window, F.col("logins"))).cast("long").alias("logins_last90d"),
    )


def _ticket_lifetime_aggs():
    return [
        F.count("ticket_id").alias("total_tickets"),
        F.count_if(F.col("resolved") == RESOLVED_NO).alias("unresolved_tickets"),
        F.count_if(F.col("priority") == PRIORITY_CRITICAL).alias("critical_tickets"),
    ]


def ticket_features(tickets: DataFrame) -> DataFrame:
    """Tickets per customer: total, unresolved ("No"), critical."""
    return _known(tickets).groupBy("customer_id").agg(*_ticket_lifetime_aggs())


def recent_tickets(tickets: DataFrame, params: ChurnParams) -> DataFrame:
    """Tickets created on or after the cutoff, per customer."""
    recent = _known(tickets).where(in_recency_window("created_date", params))
    return recent.groupBy("customer_id").agg(F.count(F.lit(1)).alias("tickets_last90d"))


def ticket_customer_agg(tickets: DataFrame, params: ChurnParams, known_only: bool = True,
                        by: tuple[str, ...] = ("customer_id",)) -> DataFrame:
    """``ticket_features`` and ``recent_tickets`` in one pass over the ticket facts."""
    rows = _known(tickets) if known_only else _keyed(tickets)
    if by == JOIN_KEY:
        rows = with_join_key(rows)
    return rows.groupBy(*by).agg(
        *_ticket_lifetime_aggs(),
        F.count_if(in_recency_window("created_date", params)).alias("tickets_last90d"),
    )


SUBSCRIPTION_COLUMNS = ("plan", "mrr", "contract_type", "signup_date", "churn_date", "status", "sub_flag")
CUSTOMER_COLUMNS = ("customer_id", "age", "region", "signup_date", "plan", "acq_channel", "contract_type", "age_flag")
COLLIDING = ("plan", "contract_type", "signup_date")

FEATURE_COLUMNS = (
    "customer_id", "age", "region", "signup_date_cust", "plan_cust", "acq_channel",
    "contract_type_cust", "age_flag", "plan_sub", "mrr", "contract_type_sub", "signup_date_sub",
    "churn_date", "status", "sub_flag", "avg_monthly_logins", "avg_features_used",
    "avg_active_minutes", "total_months_with_data", "last_active_month", "logins_last90d",
    "total_tickets", "unresolved_tickets", "critical_tickets", "tickets_last90d", "plan_final",
    "contract_type_final", "churned", "tenure_days", "tenure_bucket", "engagement_tier",
    "days_since_last_active",
)


def customer_features(customers: DataFrame, subscriptions: DataFrame, usage: DataFrame,
                      tickets: DataFrame, params: ChurnParams) -> DataFrame:
    """One row per customer (per matching subscription row), 32 columns, then the columns of
    customers and subscriptions beyond the known ones (with ``_cust`` / ``_sub`` where both have one).

    customers LEFT JOIN the per-customer usage and ticket aggregates, then LEFT JOIN
    subscriptions (NULL key matches NULL key, like ``merge``), all on ``JOIN_KEY``; the join with
    subscriptions is salted, since a key may hold many of them. Customers are unique per key after
    deduplication, so no join can pair many rows with many. Bucketed tables (``read_star``) are grouped
    and joined without an exchange. Orphan fact rows aggregate under ids no customer
    has, so the LEFT JOIN from customers drops them: the result equals filtering on
    ``orphan_flag`` first, without evaluating that flag's join.
    """
    more_cust = [c for c in customers.columns if c not in (*CUSTOMER_COLUMNS, *JOIN_KEY)]
    more_subs = [c for c in subscriptions.columns if c not in ("customer_id", *SUBSCRIPTION_COLUMNS, *JOIN_KEY)]
    colliding = {*COLLIDING, *(set(more_cust) & set(more_subs))}

    def named(columns, suffix):
        return [F.col(c).alias(f"{c}{suffix}" if c in colliding else c) for c in columns]
    cust = with_join_key(customers).select(*JOIN_KEY, *named(CUSTOMER_COLUMNS, "_cust"), *named(more_cust, "_cust"))
    subs = with_join_key(subscriptions).select(*JOIN_KEY, *named(SUBSCRIPTION_COLUMNS, "_sub"), *named(more_subs, "_sub"))
    more = [f"{c}{suffix}" if c in colliding else c
            for suffix, columns in (("_cust", more_cust), ("_sub", more_subs)) for c in columns]
    keys = list(JOIN_KEY)
    # customer grain first: customers and both fact aggregates are unique per key, so these
    # joins cannot be skewed and run co-partitioned
    cust = (cust
            .join(usage_customer_agg(usage, params, known_only=False, by=JOIN_KEY), keys, "left")
            .join(ticket_customer_agg(tickets, params, known_only=False, by=JOIN_KEY), keys, "left"))

    # the one join whose right side can be skewed (a key with many subscription rows); a table is
    # bucketed only where no key is hot, and then meets its partners where it lies
    colocated = set(JOIN_KEY) <= set(subscriptions.columns)
    df = cust.join(subs, keys, "left") if colocated else left_join_unique(cust, subs, keys, params.salts)

    as_of = F.lit(params.as_of)
    churned = F.coalesce(F.col("status") == STATUS_CHURNED, F.lit(False))
    signup = F.coalesce(F.col("signup_date_sub"), F.col("signup_date_cust"))
    end = F.when(churned, F.col("churn_date")).otherwise(as_of)
    tenure = clip_lower(F.datediff(end, signup), 0)
    df = df.withColumns({
        "plan_final": F.coalesce("plan_sub", "plan_cust"),
        "contract_type_final": F.coalesce("contract_type_sub", "contract_type_cust"),
        "churned": churned.cast("int"),
        # whole days as DOUBLE: the column holds NULLs (pandas makes it float for that reason)
        "tenure_days": tenure.cast("double"),
        "tenure_bucket": tenure_bucket(tenure),
        "engagement_tier": engagement_tier(F.coalesce(F.col("avg_monthly_logins"), F.lit(0.0))),
        "days_since_last_active": F.datediff(as_of, F.col("last_active_month")).cast("double"),
    })
    df = df.withColumns({c: F.coalesce(F.col(c), F.lit(0).cast(df.schema[c].dataType)) for c in ZERO_FILL})
    return df.select(*FEATURE_COLUMNS, *more)


def summary_kpis(features: DataFrame) -> DataFrame:
    """Customers, churned, active and churn rate (percent) over the flat table."""
    n = F.count(F.lit(1))
    churned = F.sum("churned")
    return features.agg(
        n.alias("total_customers"),
        churned.cast("long").alias("churned_customers"),
        F.count_if(F.col("churned") == 0).alias("active_customers"),
        (F.avg("churned") * F.lit(100.0)).alias("churn_rate_pct"),
    )
