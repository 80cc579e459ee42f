"""One metric table for a run's profiling reports.

``measure`` reads each raw table once and returns long rows (layer, table_name, column_name, metric,
value). Raw and cleaned values are judged side by side: every rule of a row becomes a bit of a word, so
the facts are counted per customer id and words, one join finds the orphans among those counts, and the
metrics of all tables are sums of them (mergeable partial sums; no value of a row is shuffled). Customers are
grouped by id once, which gives the first row per id for the cleaned metrics and sums of the raw ones.

The reports below only filter, divide and name rows of that table, so a job that writes it once derives
them all without another scan.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlens import schemas as S
from churnlens.functions.dates import parse_mixed_date
from churnlens.functions.numeric import np_round
from churnlens.operators import profile as PR
from churnlens.operators.clean import (
    clean_customers, clean_subscriptions, parsed_date, ticket_columns, usage_columns, with_layouts,
)
from churnlens.operators.joins import flag_missing_key
from churnlens.params import (
    ACTIVE_WITH_CHURN_DATE, CHURN_BEFORE_SIGNUP, FINDINGS, NEGATIVE_AGE, STATUS_ACTIVE, STATUS_CHURNED, ChurnParams,
)

RAW, SILVER = "raw", "silver"
DUPLICATES = "duplicates:"
Rule = tuple[str, str, Column]  # column_name ('' for the whole row), metric, condition
BITS = 62


def null_rules(df: DataFrame) -> list[Rule]:
    return [(c, "nulls", F.col(c).isNull()) for c in PR.data_columns(df)]


def date_rules(df: DataFrame, table: str, params: ChurnParams) -> list[Rule]:
    """Dates that can't be read, and those of customers that only a day-first layout reads."""
    rules = []
    for c in PR.DATE_COLUMNS[table]:
        if table == S.CUSTOMERS:
            parsed = parse_mixed_date(c, params.customer_date_formats, params.day_first_fallback)
            strict = parse_mixed_date(c, params.customer_date_formats, False)
            rules.append((c, "day_first", strict.isNull() & parsed.isNotNull()))
        else:
            parsed = parsed_date(df, table, c, params)
        rules.append((c, "lost", F.col(c).isNotNull() & parsed.isNull()))
    return rules


def raw_rules(table: str, df: DataFrame, params: ChurnParams) -> list[Rule]:
    rules = null_rules(df) + date_rules(df, table, params)
    if table == S.CUSTOMERS:
        rules += [("age", "negative", F.col("age") < 0), ("age", "over_100", F.col("age") > 100)]
    if table == S.SUBSCRIPTIONS:
        churn, signup = (parsed_date(df, table, c, params) for c in ("churn_date", "signup_date"))
        status = F.col("status")
        rules += [("", "active_with_any_churn_date", (status == STATUS_ACTIVE) & F.col("churn_date").isNotNull()),
                  ("", "active_with_churn_date", (status == STATUS_ACTIVE) & churn.isNotNull()),
                  ("", "churned_without_date", (status == STATUS_CHURNED) & churn.isNull()),
                  ("", "churn_before_signup", churn < signup), ("", "negative_mrr", F.col("mrr") < 0)]
    if table == S.USAGE:
        for c in PR.USAGE_METRICS:
            rules += [(c, "negative", F.col(c) < 0), (c, "zero", F.col(c) == 0)]
    return rules


def silver_rules(table: str, df: DataFrame) -> list[Rule]:
    rules = null_rules(df)
    if table == S.CUSTOMERS:
        rules.append(("", NEGATIVE_AGE, F.col("age_flag") == NEGATIVE_AGE))
    if table == S.SUBSCRIPTIONS:
        rules += [("", flag, F.col("sub_flag") == flag) for flag in (ACTIVE_WITH_CHURN_DATE, CHURN_BEFORE_SIGNUP)]
    return rules


def packed(rules: list[Rule], prefix: str) -> dict[str, Column]:
    """Long columns that hold a bit per rule."""
    words = {}
    for at in range(0, len(rules), BITS):
        bits = [F.when(cond, _bit(k)).otherwise(F.lit(0).cast("long")) for k, (_, _, cond) in enumerate(rules[at:at + BITS])]
        words[f"{prefix}{at // BITS}"] = reduce(lambda a, b: a.bitwiseOR(b), bits)
    return words


def _bit(k: int) -> Column:
    return F.lit(1 << k).cast("long")


def has_bit(prefix: str, k: int) -> Column:
    """Whether rule ``k`` held for the row."""
    return F.col(f"{prefix}{k // BITS}").bitwiseAND(_bit(k % BITS)) != 0


def bit_counts(rules: list[Rule], prefix: str) -> list[Column]:
    """Per rule the rows whose bit is set."""
    return [F.count_if(has_bit(prefix, k)) for k in range(len(rules))]


Sums = list[tuple[str, str, str, Column]]  # layer, column_name, metric, aggregate


def as_rows(df: DataFrame, table: str, sums: Sums) -> DataFrame:
    """One aggregate over ``df`` as metric rows."""
    row = df.agg(*[c.cast("double").alias(f"_v{i}") for i, (_, _, _, c) in enumerate(sums)])
    items = [F.struct(F.lit(layer).alias("layer"), F.lit(table).alias("table_name"), F.lit(column).alias("column_name"),
                      F.lit(metric).alias("metric"), F.col(f"_v{i}").alias("value"))
             for i, (layer, column, metric, _) in enumerate(sums)]
    return row.select(F.explode(F.array(*items)).alias("m")).select("m.*")


def named(layer: str, rules: list[Rule], counts: list[Column]) -> Sums:
    return [(layer, column, metric, n) for (column, metric, _), n in zip(rules, counts, strict=True)]


def customer_metrics(raw: DataFrame, params: ChurnParams) -> DataFrame:
    """Raw and cleaned metrics of customers from one grouping by id."""
    rules = raw_rules(S.CUSTOMERS, raw, params)
    words = packed(rules, "_raw")
    shape = PR.date_shape("signup_date")
    ordered = S.INGEST_ORDER in raw.columns
    if ordered:
        payload = [c for c in raw.columns if c not in ("customer_id", S.INGEST_ORDER)]
        counted = raw.withColumns(words).groupBy("customer_id").agg(
            F.min_by(F.struct(*payload), F.col(S.INGEST_ORDER)).alias("_first"), F.count(F.lit(1)).alias("_rows"),
            F.min(shape).alias("_low"), F.max(shape).alias("_high"),
            *[n.alias(f"_n{k}") for k, n in enumerate(bit_counts(rules, "_raw"))])
        first = counted.select("customer_id", "_first.*", "_rows", "_low", "_high", *[f"_n{k}" for k in range(len(rules))])
        raw_counts = [F.sum(f"_n{k}") for k in range(len(rules))]
    else:
        first = raw.withColumns({**words, "_rows": F.lit(1), "_low": shape, "_high": shape})
        raw_counts = bit_counts(rules, "_raw")
    extra = [c for c in first.columns if c not in raw.columns]
    clean = clean_customers(first, params)
    after = silver_rules(S.CUSTOMERS, clean.drop(*extra))
    mixed = F.coalesce((F.min("_low") < F.max("_high")).cast("int"), F.lit(0))
    return as_rows(clean.withColumns(packed(after, "_silver")), S.CUSTOMERS, [
        (RAW, "", "rows", F.coalesce(F.sum("_rows"), F.lit(0))), (RAW, "signup_date", "mixed_layouts", mixed),
        *[(layer, c, m, F.coalesce(n, F.lit(0))) for layer, c, m, n in named(RAW, rules, raw_counts)],
        (RAW, "customer_id", "repeated", F.coalesce(F.sum("_rows"), F.lit(0)) - F.count(F.lit(1)) if ordered else F.lit(None)),
        (SILVER, "", "rows", F.count(F.lit(1))), *named(SILVER, after, bit_counts(after, "_silver"))])


def fact_metrics(raw: dict[str, DataFrame], params: ChurnParams) -> DataFrame:
    """Raw and cleaned metrics of subscriptions, tickets and usage, orphans among them: each table is
    cut to counts per customer id and words, and one join finds the orphans of all three."""
    clean = {S.SUBSCRIPTIONS: clean_subscriptions, S.TICKETS: ticket_columns, S.USAGE: usage_columns}
    slim, sums = [], {}
    for t, fn in clean.items():
        if t not in raw:
            continue
        known = with_layouts(raw[t], t, params)
        before = raw_rules(t, known, params)
        words = packed(before, "_raw")
        df = fn(known.withColumns(words), params)
        after = silver_rules(t, df.drop(S.INGEST_ORDER, *words))
        df = df.withColumns(packed(after, "_silver"))
        names = [c for c in df.columns if c.startswith(("_raw", "_silver"))]
        slim.append(df.select(F.lit(t).alias("_table"), "customer_id", *names))
        sums[t] = (before, after)
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), slim)
    words = [c for c in rows.columns if c.startswith(("_raw", "_silver"))]
    # rows of a customer with the same words are counted before they are shuffled, so no id is hot in the join
    counted = rows.groupBy("_table", "customer_id", *words).agg(F.count(F.lit(1)).alias("_n"))
    patterns = flag_missing_key(counted, raw[S.CUSTOMERS].select("customer_id"), "customer_id", "orphan_flag", salts=1)
    items = []
    for t, (before, after) in sums.items():
        mine = F.col("_table") == t
        items += [(t, RAW, "", "rows", mine), (t, SILVER, "", "rows", mine),
                  (t, SILVER, "", "orphans", mine & F.col("orphan_flag"))]
        for layer, rules, prefix in ((RAW, before, "_raw"), (SILVER, after, "_silver")):
            items += [(t, layer, c, m, mine & has_bit(prefix, k)) for k, (c, m, _) in enumerate(rules)]
    row = patterns.agg(*[F.coalesce(F.sum(F.when(cond, F.col("_n"))), F.lit(0)).cast("double").alias(f"_v{i}")
                         for i, (*_, cond) in enumerate(items)])
    return row.select(F.explode(F.array(*[
        F.struct(F.lit(layer).alias("layer"), F.lit(t).alias("table_name"), F.lit(c).alias("column_name"),
                 F.lit(m).alias("metric"), F.col(f"_v{i}").alias("value"))
        for i, (t, layer, c, m, _) in enumerate(items)])).alias("m")).select("m.*")


def duplicate_metrics(raw: dict[str, DataFrame]) -> DataFrame:
    """Rows beyond the first of equal ones, per table (``profile.duplicates`` as metric rows)."""
    return PR.duplicates(raw).select(
        F.lit(RAW).alias("layer"), "table_name", F.lit("").alias("column_name"),
        F.concat(F.lit(DUPLICATES), F.col("check_name")).alias("metric"), F.col("duplicate_rows").cast("double").alias("value"))


def layout_metrics(customers: DataFrame) -> DataFrame:
    """The number of layouts of the customers' signup dates."""
    shapes = PR.date_formats(customers).where(F.col("date_shape").isNotNull())
    return as_rows(shapes, S.CUSTOMERS, [(RAW, "signup_date", "layouts", F.count(F.lit(1)))])


def measure(raw: dict[str, DataFrame], params: ChurnParams) -> DataFrame:
    """Metrics of all four raw tables and of what cleaning makes of them."""
    return customer_metrics(raw[S.CUSTOMERS], params).unionByName(fact_metrics(raw, params))


# ---------------------------------------------------------------------------
# Reports from the metric table
# ---------------------------------------------------------------------------

def _pick(metrics: DataFrame, wanted: list[tuple[str, str, str, str, str]], name: str) -> DataFrame:
    """Rows of ``wanted`` (layer, table, column, metric, new name) with the new name as column ``name``."""
    key = F.concat_ws("/", "layer", "table_name", "column_name", "metric")
    names = F.create_map(*[F.lit(x) for layer, t, c, m, new in wanted for x in ("/".join((layer, t, c, m)), new)])
    return metrics.withColumn(name, F.element_at(names, key)).where(F.col(name).isNotNull())


def repairs_from(metrics: DataFrame) -> DataFrame:
    """Rows touched by each cleaning rule (table_name, rule, n_rows)."""
    wanted = [(RAW, S.CUSTOMERS, "", "rows", "rows_before_dedupe"), (SILVER, S.CUSTOMERS, "", "rows", "rows_after_dedupe"),
              (SILVER, S.CUSTOMERS, "", NEGATIVE_AGE, NEGATIVE_AGE),
              (SILVER, S.CUSTOMERS, "signup_date", "nulls", "signup_date_unparsed"),
              (RAW, S.CUSTOMERS, "signup_date", "day_first", "signup_date_day_first")]
    wanted += [(RAW, t, c, "lost", f"{c}_lost") for t, columns in PR.DATE_COLUMNS.items() for c in columns]
    wanted += [(RAW, S.USAGE, c, "negative", f"clip_{c}") for c in PR.USAGE_METRICS]
    wanted += [(SILVER, S.SUBSCRIPTIONS, "", f, f) for f in (ACTIVE_WITH_CHURN_DATE, CHURN_BEFORE_SIGNUP)]
    wanted += [(SILVER, t, "", "orphans", "orphan_flag") for t in (S.TICKETS, S.USAGE)]
    return _pick(metrics, wanted, "rule").select("table_name", "rule", F.col("value").cast("long").alias("n_rows"))


def null_rates_from(metrics: DataFrame) -> DataFrame:
    """Raw columns with nulls: count, percent (2 dp) and severity."""
    raw = metrics.where(F.col("layer") == RAW)
    # one row per table, a fixed handful
    rows = raw.where((F.col("metric") == "rows")).select("table_name", F.col("value").alias("n_rows"))
    nulls = raw.where((F.col("metric") == "nulls") & (F.col("value") > 0)).join(rows, "table_name")
    pct = np_round(F.col("value") / F.col("n_rows") * F.lit(100), 2)
    return nulls.select("table_name", "column_name", F.col("value").cast("long").alias("null_count"), pct.alias("null_pct"),
                        PR.null_severity(pct).alias("severity"))


def duplicates_from(metrics: DataFrame) -> DataFrame:
    """Per table and check: rows, duplicate rows, rows left after dedupe."""
    rows = metrics.where((F.col("layer") == RAW) & (F.col("metric") == "rows")).select("table_name", F.col("value").alias("_rows"))
    extra = metrics.where(F.col("metric").startswith(DUPLICATES)).join(rows, "table_name")
    return extra.select("table_name", F.expr(f"substring(metric, {len(DUPLICATES) + 1})").alias("check_name"),
                        F.col("_rows").cast("long").alias("total_rows"), F.col("value").cast("long").alias("duplicate_rows"),
                        (F.col("_rows") - F.col("value")).cast("long").alias("rows_after_dedupe"))


def remaining_nulls_from(metrics: DataFrame) -> DataFrame:
    """Null counts left after cleaning in customers and subscriptions."""
    left = metrics.where((F.col("layer") == SILVER) & (F.col("metric") == "nulls") & (F.col("value") > 0)
                         & F.col("table_name").isin(S.CUSTOMERS, S.SUBSCRIPTIONS))
    return left.select("table_name", "column_name", F.col("value").cast("long").alias("null_count"))


def quality_report_from(metrics: DataFrame) -> DataFrame:
    """The quality report as (section, metric, value) rows, from the metric table with its duplicates."""
    plain = [(RAW, t, "", "rows", "total_rows") for t in S.TABLES] + [
        (RAW, S.CUSTOMERS, "", "duplicates:full_row", "duplicate_rows"),
        (RAW, S.CUSTOMERS, "age", "negative", "negative_age_rows"),
        (RAW, S.CUSTOMERS, "signup_date", "mixed_layouts", "mixed_date_formats"),
        (RAW, S.SUBSCRIPTIONS, "", "active_with_any_churn_date", "active_with_churn_date"),
        (RAW, S.SUBSCRIPTIONS, "", "churn_before_signup", "churn_before_signup"),
        (SILVER, S.TICKETS, "", "orphans", "orphan_records")]
    shares = [(RAW, S.CUSTOMERS, c, "nulls", f"null_{c}_%") for c in ("region", "age")] + [
        (RAW, S.SUBSCRIPTIONS, "churn_date", "nulls", "null_churn_date_%")]
    rows = metrics.where((F.col("layer") == RAW) & (F.col("metric") == "rows")).select(
        F.col("table_name").alias("section"), F.col("value").alias("_rows"))
    counts = _pick(metrics, plain, "name").select(F.col("table_name").alias("section"), F.col("name").alias("metric"), "value")
    parts = _pick(metrics, shares, "name").select(F.col("table_name").alias("section"), F.col("name").alias("metric"), "value")
    percent = np_round(F.try_divide(F.col("value"), F.col("_rows")) * F.lit(100), 2)
    return counts.unionByName(parts.join(rows, "section").select("section", "metric", percent.alias("value")))


def quality_findings_from(metrics: DataFrame) -> DataFrame:
    """The fixed findings list with the count behind each and its severity, from the metric table with
    its layouts."""
    wanted = [(RAW, S.CUSTOMERS, "customer_id", "repeated", "duplicate rows"),
              (RAW, S.CUSTOMERS, "age", "negative", "negative ages"),
              (RAW, S.CUSTOMERS, "signup_date", "layouts", "mixed date formats"),
              (RAW, S.CUSTOMERS, "region", "nulls", "null regions"),
              (SILVER, S.SUBSCRIPTIONS, "", ACTIVE_WITH_CHURN_DATE, "active + churn date"),
              (SILVER, S.SUBSCRIPTIONS, "", CHURN_BEFORE_SIGNUP, "churn before signup"),
              (SILVER, S.TICKETS, "", "orphans", "orphan records")]
    rows = _pick(metrics, wanted, "issue")

    def lookup(values: dict):
        return F.element_at(F.create_map(*[F.lit(x) for kv in values.items() for x in kv]), F.col("issue"))
    return rows.select(
        lookup({issue: i + 1 for i, (_, issue, _) in enumerate(FINDINGS)}).alias("finding_id"), "table_name", "issue",
        lookup({issue: metric for issue, (_, metric) in PR.FINDING_METRICS.items()}).alias("metric"),
        F.col("value").cast("long").alias("n_rows"), lookup({issue: sev for _, issue, sev in FINDINGS}).alias("severity"))
