"""CSV source, sinks and the batch job."""

from __future__ import annotations

import glob
import json
import os

import pandas as pd
from pyspark.sql import functions as F

from churnlens import schemas as S
from churnlens.params import TESTDATA_PARAMS
from churnlens.plans import job
from churnlens.plans.layers import gold_from_silver, silver_from_raw
import pytest

from churnlens.params import ChurnParams
from churnlens.sources import raw_tables_from_testdata, read_raw_csv, read_raw_tables
from churnlens.sources.csv import null_token_hits, read_raw_text
from tests.conftest import SF_SMALL


def _write_csv_drop(spark, folder):
    """The adapter's raw tables as the four CSV files (customers split in two files:
    originals, then the repeated rows)."""
    raw = raw_tables_from_testdata(spark, SF_SMALL)
    os.makedirs(folder, exist_ok=True)
    cust = raw[S.CUSTOMERS].orderBy(S.INGEST_ORDER).toPandas()
    first = cust[cust[S.INGEST_ORDER].map(lambda r: r["seq"]) == 0]
    repeats = cust[cust[S.INGEST_ORDER].map(lambda r: r["seq"]) > 0]
    cols = list(S.RAW_COLUMNS[S.CUSTOMERS])
    os.makedirs(f"{folder}/customers.csv", exist_ok=True)
    first[cols].to_csv(f"{folder}/customers.csv/part-0.csv", index=False)
    repeats[cols].to_csv(f"{folder}/customers.csv/part-1.csv", index=False)
    for t in (S.SUBSCRIPTIONS, S.TICKETS, S.USAGE):
        raw[t].toPandas().to_csv(f"{folder}/{S.RAW_FILES[t]}", index=False)
    return raw


def test_csv_round_trip_gives_the_same_silver_and_gold(spark, tmp_dir):
    raw = _write_csv_drop(spark, tmp_dir)
    from_csv = read_raw_tables(spark, tmp_dir, TESTDATA_PARAMS)
    a = silver_from_raw(raw, TESTDATA_PARAMS)
    b = silver_from_raw(from_csv, TESTDATA_PARAMS)
    for t in S.TABLES:
        cols = a[t].columns
        assert sorted(a[t].select(cols).collect(), key=repr) == sorted(b[t].select(cols).collect(), key=repr), t
    ga = gold_from_silver(a, TESTDATA_PARAMS)
    gb = gold_from_silver(b, TESTDATA_PARAMS)
    assert ga.exceptAll(gb).count() == 0 and gb.exceptAll(ga).count() == 0


def test_csv_null_tokens_and_bad_numbers(spark, tmp_dir):
    path = f"{tmp_dir}/usage_monthly.csv"
    pd.DataFrame({
        "customer_id": ["a", "NA", "b", "c"],
        "month": ["2024-01-01", "null", "2024-02-01", ""],
        "logins": ["3", "n/a", "x7", "-1"],
        "features_used": ["1", "2", "3", "4"],
        "active_minutes": ["1.5", "NaN", "2", "3"],
    }).to_csv(path, index=False)
    rows = read_raw_csv(spark, path, S.USAGE).orderBy("features_used").collect()
    assert [r.customer_id for r in rows] == ["a", None, "b", "c"]
    assert [r.month for r in rows] == ["2024-01-01", None, "2024-02-01", None]
    assert [r.logins for r in rows] == [3, None, None, -1]
    assert [r.active_minutes for r in rows] == [1.5, None, 2.0, 3.0]


def test_job_writes_every_output(spark, tmp_dir):
    raw = raw_tables_from_testdata(spark, SF_SMALL)
    out = f"{tmp_dir}/out"
    written = job.run(spark, raw, out, TESTDATA_PARAMS)
    for name, path in written.items():
        assert glob.glob(f"{path}/part-*"), name
    gold = spark.read.parquet(written[S.FEATURES])
    assert len(gold.columns) == 32
    assert gold.select("customer_id").distinct().count() == spark.read.parquet(written[S.DIM_CUSTOMERS]).count()
    report = json.loads(open(glob.glob(f"{written['quality_report']}/part-*.json")[0]).read())
    assert set(report) == {"customers", "subscriptions", "tickets", "usage"}
    assert report["tickets"]["orphan_records"] > 0 and "null_region_%" in report["customers"]
    csv = spark.read.option("header", True).csv(written["features_csv"])
    assert csv.count() == gold.count() and len(csv.columns) == 32
    # empty flags and NULLs are both written as nothing
    assert csv.where(F.col("age_flag") == "").count() == 0


def test_per_column_null_tokens_and_hit_counts(spark, tmp_dir):
    path = f"{tmp_dir}/customers.csv"
    pd.DataFrame({"customer_id": ["a", "b", "c"], "age": ["30", "NA", "n/a"], "region": ["NA", "EU", "null"],
                  "signup_date": ["2024-01-01"] * 3, "plan": ["basic"] * 3, "acq_channel": ["x"] * 3,
                  "contract_type": ["m"] * 3}).to_csv(path, index=False)
    keep_na = ChurnParams(column_null_tokens=(("customers", "region", ("", "null")),))
    rows = read_raw_csv(spark, path, S.CUSTOMERS, keep_na).orderBy("customer_id").collect()
    assert [r.region for r in rows] == ["NA", "EU", None]
    assert [r.age for r in rows] == [30.0, None, None]
    hits = {r.column_name: r.token_hits for r in null_token_hits(read_raw_text(spark, path, S.CUSTOMERS),
                                                                  S.CUSTOMERS, keep_na).collect()}
    assert hits["age"] == 2 and hits["region"] == 1 and hits["customer_id"] == 0


def test_strict_mode_stops_on_repeated_subscription(spark, tmp_dir):
    raw = dict(raw_tables_from_testdata(spark, SF_SMALL))
    subs = raw[S.SUBSCRIPTIONS]
    raw[S.SUBSCRIPTIONS] = subs.unionByName(subs.limit(1))
    with pytest.raises(ValueError, match="repeat"):
        job.run(spark, raw, f"{tmp_dir}/strict", TESTDATA_PARAMS, csv_export=False, profile=False, strict=True)


def test_keep_first_follows_file_order_across_many_splits(spark, tmp_dir):
    """One CSV read as many splits: the kept row per id is the first in the file, as
    pandas drop_duplicates(keep="first") keeps it."""
    import random
    from churnlens.operators.clean import dedupe_first
    rnd = random.Random(7)
    rows = [{"customer_id": f"c{rnd.randrange(300)}", "age": str(i), "region": f"r{i}", "signup_date": "2024-01-01",
             "plan": "basic", "acq_channel": "x", "contract_type": "m"} for i in range(3000)]
    folder = f"{tmp_dir}/customers_csv"
    os.makedirs(folder)
    pdf = pd.DataFrame(rows)
    pdf.to_csv(f"{folder}/part-a.csv", index=False)
    pdf.iloc[::-1].to_csv(f"{folder}/part-b.csv", index=False)   # later file: never wins
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        raw = read_raw_csv(spark, folder, S.CUSTOMERS)
        assert raw.rdd.getNumPartitions() > 5
        got = {r.customer_id: r.region for r in dedupe_first(raw, "customer_id", S.INGEST_ORDER).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    want = pdf.drop_duplicates(subset="customer_id", keep="first").set_index("customer_id")["region"].to_dict()
    assert got == want


def test_csv_quotes_written_by_pandas(spark, tmp_dir):
    path = f"{tmp_dir}/support_tickets.csv"
    pd.DataFrame({"ticket_id": ["1", "2"], "customer_id": ['a "quoted" id', "b, with comma"],
                  "created_date": ["2024-01-01", "2024-01-02"], "priority": ["low", "high"],
                  "category": ["x", "y"], "resolved": ["No", "Yes"]}).to_csv(path, index=False)
    rows = read_raw_csv(spark, path, S.TICKETS).orderBy("ticket_id").collect()
    assert [r.customer_id for r in rows] == ['a "quoted" id', "b, with comma"]


def test_job_command_line_on_csv_drop(spark, tmp_dir):
    _write_csv_drop(spark, f"{tmp_dir}/raw")
    job.main(["--raw-dir", f"{tmp_dir}/raw", "--out", f"{tmp_dir}/out", "--as-of", "2001-06-01"])
    bad = {r.table_name: r.malformed_rows for r in spark.read.parquet(f"{tmp_dir}/out/profile/malformed_rows").collect()}
    assert bad == dict.fromkeys(S.TABLES, 0)
    gold = spark.read.parquet(f"{tmp_dir}/out/{S.FEATURES}")
    expected = gold_from_silver(silver_from_raw(raw_tables_from_testdata(spark, SF_SMALL), TESTDATA_PARAMS),
                                TESTDATA_PARAMS)
    assert gold.exceptAll(expected).count() == 0 and expected.exceptAll(gold).count() == 0
    plan = {r.plan: r.total_customers for r in spark.read.parquet(f"{tmp_dir}/out/reports/churn_by_plan").collect()}
    assert sum(plan.values()) == spark.read.parquet(f"{tmp_dir}/out/{S.DIM_SUBSCRIPTIONS}").count()


def test_orphan_sample_is_first_seen_in_file_order(spark, tmp_dir):
    from churnlens.operators.profile import orphan_rows, orphan_sample
    cust = f"{tmp_dir}/customers.csv"
    pd.DataFrame({"customer_id": ["a"], "age": ["1"], "region": ["x"], "signup_date": ["2024-01-01"],
                  "plan": ["p"], "acq_channel": ["c"], "contract_type": ["m"]}).to_csv(cust, index=False)
    tix = f"{tmp_dir}/support_tickets.csv"
    ids = ["z9", "a", "m1", "b7", "z9", "c3", "q0", "a0"]
    pd.DataFrame({"ticket_id": [str(i) for i in range(len(ids))], "customer_id": ids,
                  "created_date": ["2024-01-01"] * len(ids), "priority": ["low"] * len(ids),
                  "category": ["x"] * len(ids), "resolved": ["No"] * len(ids)}).to_csv(tix, index=False)
    c, t = read_raw_csv(spark, cust, S.CUSTOMERS), read_raw_csv(spark, tix, S.TICKETS)
    assert [r.customer_id for r in orphan_sample(t, c, 5).collect()] == ["z9", "m1", "b7", "c3", "q0"]
    assert S.INGEST_ORDER not in orphan_rows(t, c).columns and orphan_rows(t, c).count() == 7


CUSTOMER_ROW = {"customer_id": ["a"], "age": ["30"], "region": ["x"], "signup_date": ["2024-01-01"], "plan": ["p"],
                "acq_channel": ["c"], "contract_type": ["m"]}


def test_csv_columns_are_matched_by_name(spark, tmp_dir):
    path = f"{tmp_dir}/customers.csv"
    order = ["customer_id", "region", "age", "email", "contract_type", "plan", "signup_date", "acq_channel"]
    pd.DataFrame(CUSTOMER_ROW | {"email": ["e@x"]})[order].to_csv(path, index=False)
    df = read_raw_csv(spark, path, S.CUSTOMERS)
    row = df.first()
    assert df.columns == [*S.RAW_COLUMNS[S.CUSTOMERS], "email", S.INGEST_ORDER]
    assert (row.region, row.age, row.email, row.acq_channel) == ("x", 30.0, "e@x", "c")


def test_csv_without_a_known_column_fails_with_its_name(spark, tmp_dir):
    path = f"{tmp_dir}/customers.csv"
    pd.DataFrame({k: v for k, v in CUSTOMER_ROW.items() if k != "plan"}).to_csv(path, index=False)
    with pytest.raises(ValueError, match="plan"):
        read_raw_csv(spark, path, S.CUSTOMERS)


def test_csv_files_with_different_headers_do_not_mix(spark, tmp_dir):
    folder = f"{tmp_dir}/customers.csv"
    os.makedirs(folder)
    pd.DataFrame(CUSTOMER_ROW).to_csv(f"{folder}/a.csv", index=False)
    pd.DataFrame(CUSTOMER_ROW)[list(reversed(CUSTOMER_ROW))].to_csv(f"{folder}/b.csv", index=False)
    with pytest.raises(Exception, match="(?i)header"):
        read_raw_csv(spark, folder, S.CUSTOMERS).collect()


def test_quoted_line_breaks_are_counted_or_read(spark, tmp_dir):
    from churnlens.sources.csv import malformed_rows
    for t in S.TABLES:
        pd.DataFrame({c: ["1"] for c in S.RAW_COLUMNS[t]}).to_csv(f"{tmp_dir}/{S.RAW_FILES[t]}", index=False)
    pd.DataFrame({"ticket_id": ["1", "2"], "customer_id": ["a", "b"], "created_date": ["2024-01-01"] * 2,
                  "priority": ["low"] * 2, "category": ["two\nlines", "y"], "resolved": ["No", "Yes"],
                  }).to_csv(f"{tmp_dir}/{S.RAW_FILES[S.TICKETS]}", index=False)
    by_line = ChurnParams(csv_multiline=False)
    count = {r.table_name: r.malformed_rows for r in malformed_rows(spark, tmp_dir, by_line).collect()}
    assert count[S.TICKETS] > 0 and count[S.USAGE] == 0
    count = {r.table_name: r.malformed_rows for r in malformed_rows(spark, tmp_dir).collect()}
    assert count[S.TICKETS] == count[S.USAGE] == 0  # by default the file is found and read whole
    found = read_raw_csv(spark, f"{tmp_dir}/{S.RAW_FILES[S.TICKETS]}", S.TICKETS).orderBy("ticket_id").collect()
    assert [(r.customer_id, r.category, r.resolved) for r in found] == [("a", "two\nlines", "No"), ("b", "y", "Yes")]
    whole = ChurnParams(csv_multiline=True)
    rows = read_raw_csv(spark, f"{tmp_dir}/{S.RAW_FILES[S.TICKETS]}", S.TICKETS, whole).orderBy("ticket_id").collect()
    assert [(r.customer_id, r.category, r.resolved) for r in rows] == [("a", "two\nlines", "No"), ("b", "y", "Yes")]
    count = {r.table_name: r.malformed_rows for r in malformed_rows(spark, tmp_dir, whole).collect()}
    assert count[S.TICKETS] == 0


def test_single_layout_dates_with_a_time_and_a_layout_per_column(spark):
    from churnlens.functions import parse_date
    df = spark.createDataFrame([("2024-01-02 00:00:00",), ("2024-01-02T10:30:00Z",), ("2024-1-2",), ("x",)], "v string")
    assert [str(r[0]) for r in df.select(parse_date("v", "yyyy-M-d")).collect()] == ["2024-01-02"] * 3 + ["None"]
    p = ChurnParams(column_date_formats=(("subscriptions", "churn_date", "M/d/yyyy"),))
    assert p.date_format("subscriptions", "churn_date") == "M/d/yyyy" and p.date_format("usage", "month") == "yyyy-M-d"


def test_only_files_with_quoted_line_breaks_are_read_whole(spark, tmp_dir):
    """Two clean files stay split into many tasks; the third, with breaks and quotes, is read by one, and all
    rows come as pandas reads them."""
    from churnlens.sources.csv import files_with_open_quotes
    folder = f"{tmp_dir}/support_tickets.csv"
    os.makedirs(folder)
    frames = []
    for k in range(3):
        n = 400
        text = ["two\nlines", 'a "b",\r\nc', "plain", "one, two"] if k == 1 else ["plain", "one, two", 'in "quotes"', "x"]
        frames.append(pd.DataFrame({
            "ticket_id": [f"{k}-{i}" for i in range(n)], "customer_id": ["c"] * n, "created_date": ["2024-01-01"] * n,
            "priority": ["low"] * n, "category": [text[i % 4] for i in range(n)], "resolved": ["No"] * n}))
        frames[-1].to_csv(f"{folder}/part-{k}.csv", index=False)
    assert [f.rsplit("/", 1)[1] for f in files_with_open_quotes(spark, folder)] == ["part-1.csv"]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        raw = read_raw_csv(spark, folder, S.TICKETS)
        where = raw.withColumn("task", F.spark_partition_id()).groupBy(F.col(f"{S.INGEST_ORDER}.file").alias("file")).agg(
            F.countDistinct("task").alias("tasks"))
        tasks = {r.file.rsplit("/", 1)[1]: r.tasks for r in where.collect()}
        assert tasks["part-0.csv"] > 3 and tasks["part-2.csv"] > 3 and tasks["part-1.csv"] == 1
        got = {(r.ticket_id, r.category) for r in raw.collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    want = pd.concat([pd.read_csv(f"{folder}/part-{k}.csv") for k in range(3)])
    assert got == set(zip(want["ticket_id"], want["category"], strict=True)) and len(got) == 1200


@pytest.mark.parametrize("first,others", [
    ("13/04/2024", ["05/06/2024", "31/12/2023", "2024-01-01", "12/31/2024", "x", None, "1/2/2024"]),
    ("05/04/2024", ["06/07/2024", "13/04/2024", "2024-01-01", None, "1/2/2024"]),
    ("2024-03-05", ["2024-12-31", "05/06/2024", "2024-13-01", "x", None]),
    ("2024/03/05", ["2024/12/31", "05/06/2024", "2024-03-05", None]),
    ("20240305", ["20241231", "2024-03-05", None]),
    ("5.4.2024", ["13.4.2024", "6.7.2024", "2024-03-05", None]),
])
def test_a_columns_layout_is_that_of_its_first_value(spark, tmp_dir, first, others):
    """As pandas.to_datetime infers it, without a parameter."""
    import warnings

    from churnlens.operators.clean import clean_usage
    values = [None, first, *others]
    pd.DataFrame({"customer_id": ["a"] * len(values), "month": values, "logins": range(len(values)),
                  "features_used": 1, "active_minutes": 1.0}).to_csv(f"{tmp_dir}/usage_monthly.csv", index=False)
    raw = read_raw_csv(spark, f"{tmp_dir}/usage_monthly.csv", S.USAGE)
    got = [r.month for r in clean_usage(raw, raw, ChurnParams()).orderBy("logins").collect()]
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        want = pd.to_datetime(pd.read_csv(f"{tmp_dir}/usage_monthly.csv", dtype={"month": str})["month"], errors="coerce")
    assert got == [None if pd.isna(d) else d.date() for d in want]


def test_layouts_are_found_while_the_query_runs(spark, tmp_dir):
    """No job when the plan is built, no join in it; a named layout goes first; all rules use the same one."""
    from churnlens.operators.clean import clean_subscriptions
    from churnlens.operators.profile import subscription_rules
    rows = {"customer_id": ["a", "b", "c"], "plan": ["p"] * 3, "mrr": [1.0] * 3, "contract_type": ["m"] * 3,
            "signup_date": ["13/04/2024", "01/02/2024", "05/06/2024"], "churn_date": ["14/05/2024", "01/01/2024", None],
            "status": ["Churned", "Churned", "Churned"]}
    pd.DataFrame(rows).to_csv(f"{tmp_dir}/subscriptions.csv", index=False)
    raw = read_raw_csv(spark, f"{tmp_dir}/subscriptions.csv", S.SUBSCRIPTIONS)
    group = "layout-plan"
    spark.sparkContext.setJobGroup(group, group)
    df = clean_subscriptions(raw, ChurnParams())
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    spark.sparkContext._jsc.sc().clearJobGroup()
    assert "Join" not in df._jdf.queryExecution().executedPlan().toString()
    assert [(str(r.signup_date), r.sub_flag) for r in df.orderBy("customer_id").collect()] == [
        ("2024-04-13", ""), ("2024-02-01", "CHURN_BEFORE_SIGNUP"), ("2024-06-05", "")]
    rules = subscription_rules(raw, ChurnParams()).first()
    assert (rules.churn_before_signup, rules.churned_without_date) == (1, 1)
    named = ChurnParams(column_date_formats=(("subscriptions", "signup_date", "M/d/yyyy"),))
    assert [str(r.signup_date) for r in clean_subscriptions(raw, named).orderBy("customer_id").collect()] == ["None", "2024-01-02", "2024-05-06"]


def test_one_sorted_csv_file(spark, tmp_dir):
    from churnlens.sinks import write_csv_file
    rows = [(f"c{(7 * i) % 500:03d}", i if i % 3 else None, i % 2 == 0, ["", "a,b", 'q "x"', " pad ", None, "two\nlines"][i % 6]) for i in range(500)]
    df = spark.createDataFrame(rows, "customer_id string, n long, flag boolean, text string").repartition(7)
    path = write_csv_file(df, f"{tmp_dir}/table.csv", ["customer_id"])
    assert os.path.isfile(path) and os.listdir(tmp_dir) == ["table.csv"] or sorted(os.listdir(tmp_dir)) == [".table.csv.crc", "table.csv"]
    got = pd.read_csv(path)
    want = pd.DataFrame(sorted(rows), columns=["customer_id", "n", "flag", "text"])
    want["text"] = want["text"].replace("", None)
    pd.testing.assert_frame_equal(got, want.astype({"n": "float64"}), check_dtype=False)
    assert open(path).read().count("customer_id") == 1
    write_csv_file(df.limit(0), path, ["customer_id"])  # replaces the file; a header alone
    assert open(path).read() == "customer_id,n,flag,text\n"


def test_job_exports_single_files_and_buckets(spark, tmp_dir):
    raw = raw_tables_from_testdata(spark, SF_SMALL)
    written = job.run(spark, raw, f"{tmp_dir}/out", TESTDATA_PARAMS, csv_export=False, profile=False, buckets=4, single_csv=True)
    gold = pd.read_csv(f"{tmp_dir}/out/export/{S.FEATURES}.csv")
    assert len(gold) == spark.read.parquet(written[S.FEATURES]).count() and len(gold.columns) == 32
    ids = gold["customer_id"].dropna().tolist()
    assert ids == sorted(ids)
