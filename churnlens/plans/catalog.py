"""Named queries over a test-data directory: ``name -> (spark, sf_dir) -> DataFrame``.

Every query derives the raw churn tables from the test-data tables while it runs, so its work
grows with the data. Raw, silver and gold are lazy plans; Catalyst prunes what a query does not use.
The read-back queries write the derived tables with the sinks into the shared folder and read them
again.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlens import schemas as S
from churnlens.operators import features as FE
from churnlens.operators import metrics as ME
from churnlens.operators import profile as PR
from churnlens.operators import reports as RP
from churnlens.params import TESTDATA_PARAMS as P
from churnlens.plans import sql_reports
from churnlens.plans.layers import gold_from_testdata, raw_from_testdata, silver_from_testdata
from churnlens.session import shared_folder, shared_table
from churnlens.sinks import write_csv_export, write_quality_json, write_table
from churnlens.sources.csv import null_token_hits, read_raw_csv, read_raw_text

Query = Callable[[SparkSession, str], DataFrame]


def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers written as CSV in another column order with an extra column, read back by name."""
    raw = raw_from_testdata(spark, sf_dir)[S.CUSTOMERS]
    folder = shared_folder(spark, "customers-csv")
    columns = [c for c in reversed(S.RAW_COLUMNS[S.CUSTOMERS])]
    write_csv_export(raw.select(*columns, F.upper("plan").alias("note")), folder)
    return read_raw_csv(spark, folder, S.CUSTOMERS, P).drop(S.INGEST_ORDER)


def parquet_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subscriptions (silver) written partitioned by status and read back."""
    folder = shared_folder(spark, "subscriptions")
    write_table(silver_from_testdata(spark, sf_dir, P)[S.SUBSCRIPTIONS], folder, partition_by=["status"])
    return spark.read.parquet(folder)


def profile_repairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows touched per cleaning rule, from a written metric table."""
    return ME.repairs_from(shared_table(ME.measure(raw_from_testdata(spark, sf_dir), P), "metrics"))


def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality report, from a written metric table and the duplicates of customers."""
    raw = raw_from_testdata(spark, sf_dir)
    metrics = ME.measure(raw, P).unionByName(ME.duplicate_metrics({S.CUSTOMERS: raw[S.CUSTOMERS]}))
    return ME.quality_report_from(shared_table(metrics, "metrics"))


def quality_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The findings list with its counts, from a written metric table and the customers' date layouts."""
    raw = raw_from_testdata(spark, sf_dir)
    metrics = ME.measure(raw, P).unionByName(ME.layout_metrics(raw[S.CUSTOMERS]))
    return ME.quality_findings_from(shared_table(metrics, "metrics"))


def quality_json_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nested quality report written as JSON and read back as (section, metric, value)."""
    folder = shared_folder(spark, "quality-report")
    write_quality_json(quality_report(spark, sf_dir), folder)
    sections = ", ".join(f"{t} map<string,double>" for t in S.TABLES)
    nested = spark.read.schema(sections).json(folder)
    parts = [nested.select(F.lit(t).alias("section"), F.explode(t).alias("metric", "value")) for t in S.TABLES]
    return reduce(DataFrame.unionByName, parts)


def null_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null tokens found per column of the tickets written as CSV with unreadable values as tokens."""
    raw = raw_from_testdata(spark, sf_dir)[S.TICKETS]
    folder = shared_folder(spark, "tickets-csv")
    token = F.when(F.col("created_date").rlike("[0-9]"), F.col("created_date")).otherwise(F.lit("n/a"))
    write_csv_export(raw.withColumn("created_date", token), folder)
    return null_token_hits(read_raw_text(spark, folder, S.TICKETS, P), S.TICKETS, P)


def _silver(table: str) -> Query:
    return lambda spark, sf: silver_from_testdata(spark, sf, P)[table]


def _on_silver(fn) -> Query:
    return lambda spark, sf: fn(silver_from_testdata(spark, sf, P))


def _on_raw(fn) -> Query:
    return lambda spark, sf: fn(raw_from_testdata(spark, sf))


def _on_gold(fn) -> Query:
    return lambda spark, sf: fn(gold_from_testdata(spark, sf, P))


QUERIES: dict[str, Query] = {
    # profiling of the raw tables
    "profile_shape": _on_raw(PR.table_shapes),
    "profile_columns": _on_raw(PR.column_types),
    "profile_head": _on_raw(lambda r: PR.head_tables(r, 5)),
    "profile_null_rates": _on_raw(PR.null_rates),
    "profile_duplicates": _on_raw(PR.duplicates),
    "profile_age": _on_raw(lambda r: PR.age_profile(r[S.CUSTOMERS])),
    "profile_negative_ages": _on_raw(lambda r: PR.negative_age_values(r[S.CUSTOMERS])),
    "profile_usage_signs": _on_raw(lambda r: PR.usage_signs(r[S.USAGE])),
    "profile_date_formats": _on_raw(lambda r: PR.date_formats(r[S.CUSTOMERS])),
    "profile_date_sample": _on_raw(lambda r: PR.date_sample(r[S.CUSTOMERS], 20)),
    "profile_subscription_rules": _on_raw(lambda r: PR.subscription_rules(r[S.SUBSCRIPTIONS], P)),
    "orphan_tickets": _on_raw(lambda r: PR.orphan_rows(r[S.TICKETS], r[S.CUSTOMERS])),
    "orphan_usage": _on_raw(lambda r: PR.orphan_rows(r[S.USAGE], r[S.CUSTOMERS])),
    "orphan_ticket_sample": _on_raw(lambda r: PR.orphan_sample(r[S.TICKETS], r[S.CUSTOMERS], 5)),
    "orphan_subscriptions": _on_raw(lambda r: PR.orphan_rows(r[S.SUBSCRIPTIONS], r[S.CUSTOMERS])),
    "quality_report": quality_report,
    # checks after cleaning
    "profile_remaining_nulls": _on_silver(PR.remaining_nulls),
    "profile_distinct": _on_silver(PR.distinct_values),
    "profile_value_counts": _on_silver(PR.value_counts),
    "profile_repairs": profile_repairs,
    "quality_findings": quality_findings,
    # cleaning (silver)
    "clean_customers": _silver(S.CUSTOMERS),
    "clean_subscriptions": _silver(S.SUBSCRIPTIONS),
    "clean_tickets": _silver(S.TICKETS),
    "clean_usage": _silver(S.USAGE),
    # customer-grain aggregates and the flat table (gold)
    "usage_features": _on_silver(lambda s: FE.usage_features(s[S.USAGE])),
    "recent_logins": _on_silver(lambda s: FE.recent_logins(s[S.USAGE], P)),
    "ticket_features": _on_silver(lambda s: FE.ticket_features(s[S.TICKETS])),
    "recent_tickets": _on_silver(lambda s: FE.recent_tickets(s[S.TICKETS], P)),
    "customer_features": lambda spark, sf: gold_from_testdata(spark, sf, P),
    "summary_kpis": _on_gold(FE.summary_kpis),
    # reports over the star schema
    "churn_by_plan": _on_silver(lambda s: RP.churn_by_plan(s[S.SUBSCRIPTIONS])),
    "churn_trend_monthly": _on_silver(lambda s: RP.churn_trend_monthly(s[S.SUBSCRIPTIONS])),
    "churn_trend_monthly_dense": _on_silver(lambda s: RP.churn_trend_monthly(s[S.SUBSCRIPTIONS], dense_calendar=True)),
    "churn_by_plan_contract": _on_silver(
        lambda s: RP.churn_by_plan_contract(s[S.CUSTOMERS], s[S.SUBSCRIPTIONS], P)),
    "churn_by_ticket_bucket": _on_silver(
        lambda s: RP.churn_by_ticket_bucket(s[S.SUBSCRIPTIONS], s[S.TICKETS])),
    "channel_performance": _on_silver(
        lambda s: RP.channel_performance(s[S.CUSTOMERS], s[S.SUBSCRIPTIONS], P)),
    # the same five reports as Spark SQL text over temp views
    "churn_by_plan_sql": _on_silver(lambda s: sql_reports.run(s, "churn_by_plan", P)),
    "churn_trend_monthly_sql": _on_silver(lambda s: sql_reports.run(s, "churn_trend_monthly", P)),
    "churn_by_plan_contract_sql": _on_silver(lambda s: sql_reports.run(s, "churn_by_plan_contract", P)),
    "churn_by_ticket_bucket_sql": _on_silver(lambda s: sql_reports.run(s, "churn_by_ticket_bucket", P)),
    "channel_performance_sql": _on_silver(lambda s: sql_reports.run(s, "channel_performance", P)),
    # findings over the flat table
    "churn_by_tenure": _on_gold(RP.churn_by_tenure),
    "churn_by_engagement": _on_gold(RP.churn_by_engagement),
    "churned_vs_active_logins": _on_gold(RP.churned_vs_active_logins),
    "churned_vs_active_tickets": _on_gold(RP.churned_vs_active_tickets),
    "segment_gap": _on_gold(RP.segment_gaps),
    "channel_volume": _on_gold(RP.channel_volume),
    # sources and sinks
    "csv_round_trip": csv_round_trip,
    "parquet_round_trip": parquet_round_trip,
    "quality_json_round_trip": quality_json_round_trip,
    "null_tokens": null_tokens,
}
