"""Profiling (raw = bronze tables, before cleaning), one report at a time; ``metrics.py`` has those that
draw on several tables.

Each table is profiled with one aggregate (a single scan); per-column results are turned
into rows with ``unpivot``/``stack``; sections are combined with ``unionByName`` into long
(table, metric, value) rows, so no one-row frames are cross-joined and nothing is collected
to the driver. Duplicates use a group-by (partial aggregation before the shuffle); orphans an
anti join.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnlens import schemas as S
from churnlens.functions.dates import parse_mixed_date
from churnlens.functions.numeric import np_round
from churnlens.operators.clean import parsed_date, with_layouts
from churnlens.operators.joins import rows_missing_key
from churnlens.params import (
    ACTIVE_WITH_CHURN_DATE, CHURN_BEFORE_SIGNUP, NULL_RATE_HIGH, NULL_RATE_MEDIUM, STATUS_ACTIVE, STATUS_CHURNED, ChurnParams,
)
from churnlens.session import shared_table

KEYS = {S.CUSTOMERS: "customer_id", S.SUBSCRIPTIONS: "customer_id", S.TICKETS: "ticket_id"}
USAGE_METRICS = ("logins", "features_used", "active_minutes")


def data_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in (S.INGEST_ORDER, S.LAYOUTS)]


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def _stack(pairs: list[tuple[str, Column]], name_col: str, value_col: str, value_type: str) -> list[Column]:
    """Arguments for ``select`` that turn named one-row values into rows (via ``stack``)."""
    args = ", ".join(f"'{n}', CAST(`_v{i}` AS {value_type})" for i, (n, _) in enumerate(pairs))
    return [F.expr(f"stack({len(pairs)}, {args}) AS (`{name_col}`, `{value_col}`)")]


def _one_row(df: DataFrame, pairs: list[tuple[str, Column]]) -> DataFrame:
    return df.agg(*[c.alias(f"_v{i}") for i, (_, c) in enumerate(pairs)])


def long_metrics(df: DataFrame, section: str, pairs: list[tuple[str, Column]]) -> DataFrame:
    """One aggregate over ``df``, returned as rows (section, metric, value double)."""
    row = _one_row(df, pairs)
    return row.select(F.lit(section).alias("section"),
                      *_stack(pairs, "metric", "value", "DOUBLE"))


# ---------------------------------------------------------------------------
# PRF1-2: shape and head
# ---------------------------------------------------------------------------

def table_shapes(raw: dict[str, DataFrame]) -> DataFrame:
    """Rows and columns per table."""
    return _union([df.agg(F.count(F.lit(1)).alias("n_rows"))
                   .select(F.lit(t).alias("table_name"), "n_rows",
                           F.lit(len(data_columns(df))).alias("n_columns"))
                   for t, df in raw.items()])


def column_types(raw: dict[str, DataFrame]) -> DataFrame:
    """Per table and column: the Spark type and the non-null count (one aggregate per table)."""
    frames = []
    for t, df in raw.items():
        cols = data_columns(df)
        counts = df.agg(*[F.count(F.col(c)).alias(c) for c in cols])
        types = F.create_map(*[F.lit(x) for c in cols for x in (c, df.schema[c].dataType.simpleString())])
        frames.append(counts.unpivot([], cols, "column_name", "non_null")
                      .select(F.lit(t).alias("table_name"), "column_name",
                              F.element_at(types, F.col("column_name")).alias("data_type"), "non_null"))
    return _union(frames)


def head_rows(df: DataFrame, n: int = 5) -> DataFrame:
    """First ``n`` rows in ingest order (a distributed top-n, not a sort of the table)."""
    order = S.INGEST_ORDER if S.INGEST_ORDER in df.columns else data_columns(df)[0]
    return df.orderBy(order).limit(n).select(*data_columns(df))


def head_tables(raw: dict[str, DataFrame], n: int = 5) -> DataFrame:
    """The first ``n`` rows of every table as (table_name, position, column_name, value): in ingest
    order where rows carry one, else in the order of all columns."""
    frames = []
    for t, df in raw.items():
        cols = data_columns(df)
        order = [F.col(c).asc_nulls_first() for c in ([S.INGEST_ORDER] if S.INGEST_ORDER in df.columns else cols)]
        first = df.orderBy(*order).limit(n)
        place = F.row_number().over(Window.orderBy(*order)).cast("long").alias("position")  # n rows
        shown = first.select(place, *[F.col(c).cast("string").alias(c) for c in cols])
        frames.append(shown.unpivot("position", cols, "column_name", "value")
                      .select(F.lit(t).alias("table_name"), "position", "column_name", "value"))
    return _union(frames)


# ---------------------------------------------------------------------------
# PRF3-4, 21, 24: null rates
# ---------------------------------------------------------------------------

def null_severity(pct: Column) -> Column:
    return (F.when(pct > F.lit(NULL_RATE_HIGH), F.lit("HIGH"))
            .when(pct > F.lit(NULL_RATE_MEDIUM), F.lit("MEDIUM")).otherwise(F.lit("LOW")))


def _null_counts(df: DataFrame, table: str) -> DataFrame:
    cols = data_columns(df)
    counts = df.agg(F.count(F.lit(1)).alias("n_rows"),
                    *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return (counts.unpivot("n_rows", cols, "column_name", "null_count")
            .select(F.lit(table).alias("table_name"), "column_name", "null_count", "n_rows"))


def null_rates(tables: dict[str, DataFrame]) -> DataFrame:
    """Columns with nulls: count, percent (2 dp, pandas rounding) and severity."""
    out = _union([_null_counts(df, t) for t, df in tables.items()]).where(F.col("null_count") > 0)
    pct = np_round(F.col("null_count") / F.col("n_rows") * F.lit(100), 2)
    return out.select("table_name", "column_name", "null_count", pct.alias("null_pct"),
                      null_severity(pct).alias("severity"))


def remaining_nulls(silver: dict[str, DataFrame]) -> DataFrame:
    """Null counts left after cleaning in customers and subscriptions."""
    tables = {t: silver[t] for t in (S.CUSTOMERS, S.SUBSCRIPTIONS)}
    return (_union([_null_counts(df, t) for t, df in tables.items()])
            .where(F.col("null_count") > 0).select("table_name", "column_name", "null_count"))


# ---------------------------------------------------------------------------
# PRF5-6, 22: duplicates
# ---------------------------------------------------------------------------

def _extra_rows(df: DataFrame, cols: list[str]) -> DataFrame:
    """Group rows with equal ``cols`` (NULLs equal): total rows, rows beyond the first of each
    group, and number of groups. One grouping; partial aggregation runs before the shuffle, so a
    heavily repeated value is reduced per input partition first."""
    groups = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("total"),
                      F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias("extra"),
                      F.count(F.lit(1)).alias("groups"))


def duplicate_key_count(df: DataFrame, key: str) -> int:
    """Rows beyond the first per key (one number to the driver)."""
    return int(_extra_rows(df, [key]).first()["extra"])


def assert_unique_key(df: DataFrame, key: str, what: str) -> None:
    """Strict mode: stop when a table that should hold one row per key does not."""
    n = duplicate_key_count(df, key)
    if n:
        raise ValueError(f"{what}: {n} rows repeat an existing {key}")


PRINT = ("_print1", "_print2")


def row_print(cols: list[str]) -> list[Column]:
    """A 16-byte fingerprint of a row: equal rows (NULLs equal) have equal ones."""
    parts = [x for c in cols for x in (F.col(c), F.col(c).isNull())]
    return [F.xxhash64(*parts), F.xxhash64(F.lit("2"), *parts)]


def shared_prints(df: DataFrame, cols: list[str], prints=row_print) -> DataFrame:
    """Fingerprints that several rows have, with their rows ``n`` and ``groups`` 1, and one row with NULL
    fingerprints for all rows whose fingerprint is their own (``n`` rows, as many ``groups``). Only the
    fingerprints are shuffled."""
    per_print = (df.select(*[p.alias(name) for p, name in zip(prints(cols), PRINT, strict=True)])
                 .groupBy(*PRINT).agg(F.count(F.lit(1)).alias("_n")))
    named = [F.when(F.col("_n") > 1, F.col(name)).alias(name) for name in PRINT]
    return per_print.groupBy(*named).agg(F.sum("_n").alias("n"), F.count(F.lit(1)).alias("groups"))


def full_row_duplicates(df: DataFrame, prints=row_print) -> DataFrame:
    """``_extra_rows`` over all columns by fingerprint, then exact: only rows that share a fingerprint
    with another row are compared whole. The shared fingerprints are written first, so that the planner
    knows their size: it sends them to the rows if they are small and shuffles the rows by fingerprint
    only if not. Copies collapse in the partial aggregate before they are shuffled."""
    cols = data_columns(df)
    shared = shared_table(shared_prints(df, cols, prints), "row-prints")
    alone = shared.where(F.col(PRINT[0]).isNull()).select("n", "groups")
    keyed = df.select(*cols, *[p.alias(name) for p, name in zip(prints(cols), PRINT, strict=True)])
    suspects = keyed.join(shared.where(F.col(PRINT[0]).isNotNull()).select(*PRINT), list(PRINT), "left_semi")
    equal = suspects.groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).select("n", F.lit(1).cast("long").alias("groups"))
    return alone.unionByName(equal).agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("total"),
        F.coalesce(F.sum(F.col("n") - F.col("groups")), F.lit(0)).cast("long").alias("extra"),
        F.coalesce(F.sum("groups"), F.lit(0)).cast("long").alias("groups"))


def duplicates(raw: dict[str, DataFrame]) -> DataFrame:
    """Per table and check (full row, key): rows, duplicate rows, rows left after dedupe."""
    frames = []
    for t, df in raw.items():
        checks = [("full_row", full_row_duplicates(df))]
        if t in KEYS:
            checks.append((f"key:{KEYS[t]}", _extra_rows(df, [KEYS[t]])))
        for name, counts in checks:
            frames.append(counts.select(
                F.lit(t).alias("table_name"), F.lit(name).alias("check_name"),
                F.col("total").alias("total_rows"), F.col("extra").alias("duplicate_rows"),
                F.col("groups").alias("rows_after_dedupe")))
    return _union(frames)


# ---------------------------------------------------------------------------
# PRF7-9, 18: ranges and signs
# ---------------------------------------------------------------------------

def age_profile(customers: DataFrame) -> DataFrame:
    """min / max / mean age, count below 0 and above 100 (raw values)."""
    age = F.col("age")
    return customers.agg(
        F.min(age).alias("min_age"), F.max(age).alias("max_age"), F.avg(age).alias("mean_age"),
        F.count_if(age < 0).alias("negative_age_rows"), F.count_if(age > 100).alias("over_100_rows"))


def negative_age_values(customers: DataFrame) -> DataFrame:
    """Distinct negative ages, sorted, with how often each occurs."""
    return (customers.where(F.col("age") < 0).groupBy("age")
            .agg(F.count(F.lit(1)).alias("n_rows")).orderBy("age"))


def usage_signs(usage: DataFrame) -> DataFrame:
    """Negative and zero counts per usage metric (raw values): one aggregate, stacked."""
    pairs = []
    for c in USAGE_METRICS:
        pairs += [(f"{c}:neg", F.count_if(F.col(c) < 0)), (f"{c}:zero", F.count_if(F.col(c) == 0))]
    row = _one_row(usage, pairs)
    args = ", ".join(f"'{c}', `_v{2 * i}`, `_v{2 * i + 1}`" for i, c in enumerate(USAGE_METRICS))
    return row.select(F.expr(f"stack({len(USAGE_METRICS)}, {args}) AS (column_name, negatives, zeros)"))


# ---------------------------------------------------------------------------
# PRF10-11: date layouts
# ---------------------------------------------------------------------------

def date_shape(c) -> Column:
    """Layout of a date string: every digit becomes 9 (03-04-2024 -> 99-99-9999)."""
    return F.regexp_replace(F.col(c) if isinstance(c, str) else c, "[0-9]", "9")


def date_formats(customers: DataFrame, column: str = "signup_date") -> DataFrame:
    """Rows per date layout; more than one non-null layout means mixed formats."""
    return (customers.groupBy(date_shape(column).alias("date_shape"))
            .agg(F.count(F.lit(1)).alias("n_rows")))


def date_sample(customers: DataFrame, n: int = 20, column: str = "signup_date") -> DataFrame:
    """The first ``n`` non-null raw date strings in ingest order, numbered from 1."""
    first = (customers.where(F.col(column).isNotNull())
             .orderBy(S.INGEST_ORDER).limit(n).select(S.INGEST_ORDER, column))
    return first.select(F.row_number().over(Window.orderBy(S.INGEST_ORDER)).cast("long").alias("position"), column)


# ---------------------------------------------------------------------------
# PRF12-15: subscription rules (on raw text, dates parsed for the check only)
# ---------------------------------------------------------------------------

def subscription_rules(subscriptions: DataFrame, params: ChurnParams) -> DataFrame:
    subscriptions = with_layouts(subscriptions, S.SUBSCRIPTIONS, params)
    churn = parsed_date(subscriptions, S.SUBSCRIPTIONS, "churn_date", params)
    signup = parsed_date(subscriptions, S.SUBSCRIPTIONS, "signup_date", params)
    status = F.col("status")
    return subscriptions.agg(
        F.count_if((status == STATUS_ACTIVE) & churn.isNotNull()).alias("active_with_churn_date"),
        F.count_if((status == STATUS_CHURNED) & churn.isNull()).alias("churned_without_date"),
        F.count_if(churn < signup).alias("churn_before_signup"),
        F.count_if(F.col("mrr") < 0).alias("negative_mrr"),
    )


# ---------------------------------------------------------------------------
# PRF16-17: orphans
# ---------------------------------------------------------------------------

def orphan_rows(facts: DataFrame, customers: DataFrame) -> DataFrame:
    """Fact rows whose customer_id is not a known customer (NULL matches NULL)."""
    return rows_missing_key(facts, customers.select("customer_id"), "customer_id").select(*data_columns(facts))


def orphan_sample(facts: DataFrame, customers: DataFrame, n: int = 5) -> DataFrame:
    """Up to ``n`` distinct unknown customer ids: the first seen in file order when the rows
    carry an ingest order, else the smallest. A distributed top-n over one row per id."""
    orphans = rows_missing_key(facts, customers.select("customer_id"), "customer_id")
    if S.INGEST_ORDER in facts.columns:
        first = orphans.groupBy("customer_id").agg(F.min(S.INGEST_ORDER).alias("_first"))
        return first.orderBy("_first").limit(n).select("customer_id")
    ids = orphans.select("customer_id").distinct()
    return ids.orderBy(F.col("customer_id").asc_nulls_first()).limit(n)


# ---------------------------------------------------------------------------
# PRF19-20: values after cleaning; dates lost by reading them
# ---------------------------------------------------------------------------

DISTINCT_COLUMNS = {
    S.CUSTOMERS: ("plan", "region", "contract_type"),
    S.SUBSCRIPTIONS: ("status", "plan"),
    S.TICKETS: ("priority", "resolved"),
}
VALUE_COUNT_COLUMNS = {S.CUSTOMERS: ("age_flag",), S.SUBSCRIPTIONS: ("sub_flag",)}


def distinct_values(silver: dict[str, DataFrame]) -> DataFrame:
    """Distinct values of the listed text columns: per table one scan, each row exploded into
    (column, value) pairs, then one distinct."""
    frames = []
    for t, cols in DISTINCT_COLUMNS.items():
        pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"))
                          for c in cols])
        frames.append(silver[t].select(F.explode(pairs).alias("p")).select("p.*").distinct()
                      .select(F.lit(t).alias("table_name"), "column_name", "value"))
    return _union(frames)


def value_counts(silver: dict[str, DataFrame]) -> DataFrame:
    """Rows per value of the flag columns, most frequent first within a column."""
    counts = _union([silver[t].where(F.col(c).isNotNull()).groupBy(F.col(c).alias("value"))
                   .agg(F.count(F.lit(1)).alias("n_rows"))
                   .select(F.lit(t).alias("table_name"), F.lit(c).alias("column_name"), "value", "n_rows")
                   for t, cols in VALUE_COUNT_COLUMNS.items() for c in cols])
    return counts.orderBy("table_name", "column_name", F.col("n_rows").desc(), "value")


DATE_COLUMNS = {S.CUSTOMERS: ("signup_date",), **S.SINGLE_LAYOUT_DATES}


def _date_loss_pairs(df: DataFrame, table: str, params: ChurnParams) -> list[tuple[str, Column]]:
    """Per date column of a raw table: values that do not parse (set to NULL), and for customer
    signup dates, values read only through the day-first / timestamp fallback."""
    pairs = []
    for c in DATE_COLUMNS[table]:
        if table == S.CUSTOMERS:
            parsed = parse_mixed_date(c, params.customer_date_formats, params.day_first_fallback)
            strict = parse_mixed_date(c, params.customer_date_formats, False)
            pairs.append((f"{c}_day_first", F.count_if(strict.isNull() & parsed.isNotNull())))
        else:
            parsed = parsed_date(df, table, c, params)
        pairs.append((f"{c}_lost", F.count_if(F.col(c).isNotNull() & parsed.isNull())))
    return pairs


def _date_losses(raw: dict[str, DataFrame], params: ChurnParams) -> list[DataFrame]:
    tables = {t: with_layouts(raw[t], t, params) for t in DATE_COLUMNS}
    return [long_metrics(df, t, _date_loss_pairs(df, t, params)) for t, df in tables.items()]


# Metric behind each finding: (section, metric) in the report / repair rows.
FINDING_METRICS = {
    "duplicate rows": ("customers", "duplicate_customer_ids"),
    "negative ages": ("customers", "negative_age_rows"),
    "mixed date formats": ("customers", "date_formats"),
    "null regions": ("customers", "null_region_rows"),
    "active + churn date": ("subscriptions", ACTIVE_WITH_CHURN_DATE),
    "churn before signup": ("subscriptions", CHURN_BEFORE_SIGNUP),
    "orphan records": ("tickets", "orphan_records"),
}
