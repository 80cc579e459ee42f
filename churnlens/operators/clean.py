"""Cleaning (bronze -> silver). Nothing is silently fixed: each repair sets a flag column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlens import schemas as S
from churnlens.functions.dates import column_layouts, parse_by_layout, parse_date, parse_mixed_date
from churnlens.functions.numeric import clip_lower
from churnlens.functions.text import clean_text
from churnlens.operators.joins import flag_missing_key
from churnlens.params import (
    ACTIVE_WITH_CHURN_DATE, CHURN_BEFORE_SIGNUP, NEGATIVE_AGE, STATUS_ACTIVE, ChurnParams,
)

CUSTOMER_TEXT = ("plan", "region", "acq_channel", "contract_type")
SUBSCRIPTION_TEXT = ("plan", "contract_type", "status")
TICKET_TEXT = ("priority", "category", "resolved")
USAGE_METRICS = ("logins", "features_used", "active_minutes")


def dedupe_first(df: DataFrame, key: str, order: str) -> DataFrame:
    """Keep the first row per key in ``order``; NULL keys form one group.

    An aggregate, not a window: ``min_by`` is combined map-side, so a key that holds a large
    share of the rows is cut to one row per input partition before the shuffle.
    """
    payload = [c for c in df.columns if c != key]
    first = F.min_by(F.struct(*payload), F.col(order)).alias("_first")
    return df.groupBy(key).agg(first).select(key, "_first.*")


def with_layouts(df: DataFrame, table: str, params: ChurnParams) -> DataFrame:
    """``df`` with the layouts of its date columns, where rows have a file order and the layouts aren't named."""
    columns = [c for c in S.SINGLE_LAYOUT_DATES.get(table, ()) if not params.has_date_format(table, c)]
    if not columns or S.INGEST_ORDER not in df.columns or S.LAYOUTS in df.columns:
        return df
    return df.withColumn(S.LAYOUTS, column_layouts(df, columns, S.INGEST_ORDER))


def parsed_date(df: DataFrame, table: str, column: str, params: ChurnParams) -> Column:
    """A single-layout date column: by its named layout; else by the one that ``with_layouts`` found; else ISO."""
    if params.has_date_format(table, column) or S.LAYOUTS not in df.columns:
        return parse_date(column, params.date_format(table, column))
    return parse_by_layout(column, F.col(S.LAYOUTS)[column], params.customer_date_formats)


def clean_customers(raw: DataFrame, params: ChurnParams) -> DataFrame:
    """Dedupe (keep first), parse mixed-format signup dates, flag and null negative ages,
    standardise text."""
    cols = list(raw.columns)
    df = dedupe_first(raw, "customer_id", S.INGEST_ORDER) if S.INGEST_ORDER in cols else raw
    age = F.col("age")
    out = df.withColumns({
        "signup_date": parse_mixed_date("signup_date", params.customer_date_formats,
                                        params.day_first_fallback),
        "age_flag": F.when(age < 0, F.lit(NEGATIVE_AGE)).otherwise(F.lit("")),
        "age": F.when(age < 0, F.lit(None).cast("double")).otherwise(age),
        **{c: clean_text(c) for c in CUSTOMER_TEXT},
    })
    keep = [c for c in cols if c != S.INGEST_ORDER] + ["age_flag"]
    return out.select(*keep)


def clean_subscriptions(raw: DataFrame, params: ChurnParams) -> DataFrame:
    """Parse dates, standardise text, then one rule chain (first match wins):
    Active with a churn date -> date nulled; churn before signup -> date nulled."""
    raw = with_layouts(raw, S.SUBSCRIPTIONS, params)
    df = raw.withColumns({
        "signup_date": parsed_date(raw, S.SUBSCRIPTIONS, "signup_date", params),
        "churn_date": parsed_date(raw, S.SUBSCRIPTIONS, "churn_date", params),
        **{c: clean_text(c) for c in SUBSCRIPTION_TEXT},
    })
    churn, signup = F.col("churn_date"), F.col("signup_date")
    active_dated = (F.col("status") == STATUS_ACTIVE) & churn.isNotNull()
    before_signup = churn.isNotNull() & (churn < signup)
    flag = (F.when(active_dated, F.lit(ACTIVE_WITH_CHURN_DATE))
            .when(before_signup, F.lit(CHURN_BEFORE_SIGNUP))
            .otherwise(F.lit("")))
    return df.withColumns({
        "sub_flag": flag,
        "churn_date": F.when(active_dated | before_signup, F.lit(None).cast("date")).otherwise(churn),
    }).drop(S.INGEST_ORDER, S.LAYOUTS)


def ticket_columns(raw: DataFrame, params: ChurnParams) -> DataFrame:
    """Tickets with created_date parsed and text standardised: the part that needs no other table."""
    raw = with_layouts(raw, S.TICKETS, params)
    return raw.withColumns({
        "created_date": parsed_date(raw, S.TICKETS, "created_date", params),
        **{c: clean_text(c) for c in TICKET_TEXT},
    }).drop(S.LAYOUTS)


def usage_columns(raw: DataFrame, params: ChurnParams) -> DataFrame:
    """Usage with month parsed and negative metrics clipped to 0 (NULL stays NULL)."""
    raw = with_layouts(raw, S.USAGE, params)
    return raw.withColumns({
        "month": parsed_date(raw, S.USAGE, "month", params),
        **{c: clip_lower(c, 0) for c in USAGE_METRICS},
    }).drop(S.LAYOUTS)


def clean_tickets(raw: DataFrame, customers: DataFrame, params: ChurnParams) -> DataFrame:
    """``ticket_columns`` and the flag of tickets of unknown customers."""
    return flag_missing_key(ticket_columns(raw, params), customers.select("customer_id"), "customer_id", "orphan_flag",
                            params.salts).drop(S.INGEST_ORDER)


def clean_usage(raw: DataFrame, customers: DataFrame, params: ChurnParams) -> DataFrame:
    """``usage_columns`` and the flag of usage of unknown customers."""
    return flag_missing_key(usage_columns(raw, params), customers.select("customer_id"), "customer_id", "orphan_flag",
                            params.salts).drop(S.INGEST_ORDER)


def clean_all(raw: dict[str, DataFrame], params: ChurnParams) -> dict[str, DataFrame]:
    """All four silver tables. Orphan flags check against the customer ids, which are the same
    before and after deduplication, so they are taken from the raw table (a cheap distinct)
    rather than from the deduplicated rows."""
    customer_ids = raw[S.CUSTOMERS].select("customer_id")
    return {
        S.CUSTOMERS: clean_customers(raw[S.CUSTOMERS], params),
        S.SUBSCRIPTIONS: clean_subscriptions(raw[S.SUBSCRIPTIONS], params),
        S.TICKETS: clean_tickets(raw[S.TICKETS], customer_ids, params),
        S.USAGE: clean_usage(raw[S.USAGE], customer_ids, params),
    }
