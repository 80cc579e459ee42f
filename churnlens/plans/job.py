"""The batch job: raw -> bronze -> silver (star schema) -> gold (flat table) -> reports.

Each layer is written as Parquet and read back before the next one, which cuts the plan
lineage at the layer boundary (a recomputation after a lost executor restarts from the last
written layer, not from the raw files) and lets every report reuse the written tables. Bronze
is the raw data typed, once: the raw CSV is parsed a single time, and profiling and cleaning
then read only the Parquet columns they need.

    python -m churnlens.plans.job --raw-dir RAW --out OUT [--as-of 2025-06-01]
    python -m churnlens.plans.job --testdata /root/testdata/sf0.1 --out OUT

OUT must be storage every executor can reach (HDFS / object store / shared mount).
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from churnlens import schemas as S
from churnlens.operators import features as FE
from churnlens.operators import metrics as ME
from churnlens.operators import profile as PR
from churnlens.operators import reports as RP
from churnlens.operators import segments as SG
from churnlens.params import ChurnParams
from churnlens.plans.layers import gold_from_silver, silver_from_raw
from churnlens.session import build_session, session_defaults
from churnlens.sinks import (
    key_fits_buckets, write_bucketed, write_csv_export, write_csv_file, write_quality_json, write_table,
)
from churnlens.sources import raw_tables_from_testdata, read_raw_tables, read_silver, read_star
from churnlens.sources.csv import malformed_rows

# Facts are written sorted by date inside each task: recency filters then skip row groups.
DATE_ORDER = {S.USAGE: ["month"], S.TICKETS: ["created_date"]}

# Order of the rows of single-file exports.
FILE_ORDER = {S.FACT_TICKETS: ["ticket_id"], S.FACT_USAGE: ["customer_id", "month"]}

STAR_REPORTS = {
    "churn_trend_monthly": lambda s, p: RP.churn_trend_monthly(s[S.SUBSCRIPTIONS]),
    "churn_by_ticket_bucket": lambda s, p: RP.churn_by_ticket_bucket(s[S.SUBSCRIPTIONS], s[S.TICKETS]),
}
# read off the written rows of segments.star_segments and segments.flat_segments
STAR_SEGMENT_REPORTS = {
    "churn_by_plan": SG.churn_by_plan_from,
    "churn_by_plan_contract": SG.churn_by_plan_contract_from,
    "channel_performance": SG.channel_performance_from,
}
FLAT_SEGMENT_REPORTS = {
    "churn_by_tenure": SG.churn_by_tenure_from,
    "churn_by_engagement": SG.churn_by_engagement_from,
    "channel_volume": SG.channel_volume_from,
}
GOLD_REPORTS = {
    "summary_kpis": FE.summary_kpis,
    "churned_vs_active_logins": RP.churned_vs_active_logins,
    "churned_vs_active_tickets": RP.churned_vs_active_tickets,
    "segment_gap": RP.segment_gaps,
}


METRIC_REPORTS = {
    "null_rates": ME.null_rates_from,
    "remaining_nulls": ME.remaining_nulls_from,
    "duplicates": ME.duplicates_from,
    "repairs": ME.repairs_from,
    "findings": ME.quality_findings_from,
}


def run(spark: SparkSession, raw: dict[str, DataFrame], out: str, params: ChurnParams,
        csv_export: bool = True, profile: bool = True, strict: bool = False, buckets: int | None = None,
        single_csv: bool = False) -> dict[str, str]:
    """Write bronze, silver, gold, reports and (optionally) the profile. With ``buckets`` the silver
    tables are bucketed by customer id, so that the flat table's joins move nothing; a table in which one
    id has too many rows for a bucket stays plain, and its join is salted. With ``strict`` the job
    stops before the flat table when subscriptions repeat a customer (the flat table would then
    hold more than one row per customer)."""
    session_defaults(spark)
    out = out.rstrip("/")
    written: dict[str, str] = {}
    for t, df in raw.items():
        written[f"bronze_{t}"] = write_table(df, f"{out}/bronze/{t}")
    raw = {t: spark.read.parquet(f"{out}/bronze/{t}") for t in S.TABLES}
    if profile:
        # one table of metrics, from which the reports below are read off
        measured = ME.measure(raw, params).unionByName(ME.duplicate_metrics(raw)).unionByName(ME.layout_metrics(raw[S.CUSTOMERS]))
        written["metrics"] = write_table(measured.coalesce(1), f"{out}/profile/metrics")
        metrics = spark.read.parquet(written["metrics"])
        written["quality_report"] = write_quality_json(ME.quality_report_from(metrics), f"{out}/quality_report")
        for name, report in METRIC_REPORTS.items():
            written[name] = write_table(report(metrics), f"{out}/profile/{name}")

    for t, df in silver_from_raw(raw, params).items():
        path = f"{out}/{S.SILVER[t]}"
        # cleaned rows keep their customer id, and customers are one row an id
        if buckets and (t == S.CUSTOMERS or key_fits_buckets(raw[t].select("customer_id"), buckets)):
            written[S.SILVER[t]] = write_bucketed(df, path, buckets, sort_within=DATE_ORDER.get(t))
        else:
            written[S.SILVER[t]] = write_table(df, path, sort_within=DATE_ORDER.get(t))
    silver = read_silver(spark, out)
    if csv_export:
        for t in S.TABLES:
            written[f"{S.SILVER[t]}_csv"] = write_csv_export(silver[t], f"{out}/export/{S.SILVER[t]}_csv")
    if strict:
        PR.assert_unique_key(silver[S.SUBSCRIPTIONS], "customer_id", S.DIM_SUBSCRIPTIONS)

    gold_path = write_table(gold_from_silver(read_star(spark, out) if buckets else silver, params), f"{out}/{S.FEATURES}")
    written[S.FEATURES] = gold_path
    gold = spark.read.parquet(gold_path)
    if csv_export:
        written["features_csv"] = write_csv_export(gold, f"{out}/export/{S.FEATURES}_csv")
    if single_csv:
        for name, df in {**{S.SILVER[t]: silver[t] for t in S.TABLES}, S.FEATURES: gold}.items():
            write_csv_file(df, f"{out}/export/{name}.csv", FILE_ORDER.get(name, ["customer_id"]))

    star = SG.star_segments(silver[S.CUSTOMERS], silver[S.SUBSCRIPTIONS], params)
    for name, df, reports in (("star_segments", star, STAR_SEGMENT_REPORTS), ("flat_segments", SG.flat_segments(gold), FLAT_SEGMENT_REPORTS)):
        written[name] = write_table(df, f"{out}/reports/{name}")
        segments = spark.read.parquet(written[name])
        for report, fn in reports.items():
            written[report] = write_table(fn(segments), f"{out}/reports/{report}")
    for name, fn in STAR_REPORTS.items():
        written[name] = write_table(fn(silver, params), f"{out}/reports/{name}")
    for name, fn in GOLD_REPORTS.items():
        written[name] = write_table(fn(gold), f"{out}/reports/{name}")
    return written


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--raw-dir", help="folder with customers.csv, subscriptions.csv, support_tickets.csv, usage_monthly.csv")
    src.add_argument("--testdata", help="test-data folder (tables derived by the adapter)")
    ap.add_argument("--out", required=True)
    ap.add_argument("--as-of", default=None, help="analysis date, YYYY-MM-DD")
    ap.add_argument("--recency-days", type=int, default=90)
    ap.add_argument("--no-csv", action="store_true")
    ap.add_argument("--strict", action="store_true", help="fail on malformed CSV lines and when subscriptions repeat a customer")
    ap.add_argument("--recency-upper-bound", action="store_true", help="count recent rows only up to as_of")
    ap.add_argument("--multiline", choices=("find", "all", "none"), default="find",
                    help="CSV files read whole for line breaks in quoted fields: those that have some, all, none")
    ap.add_argument("--single-csv", action="store_true", help="also export every table as one sorted CSV file")
    ap.add_argument("--buckets", type=int, help="bucket the star schema by customer id into so many buckets")
    ap.add_argument("--salts", type=int, default=16, help="about the tasks that one hot key of a join may take")
    a = ap.parse_args(argv)
    default_as_of = "2001-06-01" if a.testdata else "2025-06-01"
    params = ChurnParams(as_of=dt.date.fromisoformat(a.as_of or default_as_of), recency_days=a.recency_days,
                         recency_upper_bound=a.recency_upper_bound, csv_multiline={"find": None, "all": True, "none": False}[a.multiline], salts=a.salts)
    spark = SparkSession.getActiveSession() or build_session("churnlens-job")
    raw = read_raw_tables(spark, a.raw_dir, params) if a.raw_dir else raw_tables_from_testdata(spark, a.testdata)
    if a.raw_dir:
        bad = spark.read.parquet(write_table(malformed_rows(spark, a.raw_dir, params),
                                             f"{a.out.rstrip('/')}/profile/malformed_rows"))
        if a.strict and (n := bad.agg({"malformed_rows": "sum"}).first()[0]):
            raise ValueError(f"{n} malformed lines in {a.raw_dir}")
    for name, path in run(spark, raw, a.out, params, csv_export=not a.no_csv, strict=a.strict, buckets=a.buckets,
                          single_csv=a.single_csv).items():
        print(f"{name}\t{path}")


if __name__ == "__main__":
    main()
