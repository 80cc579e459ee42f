"""Raw churn tables derived from the supplied TPC-H-style test data.

No churn data ships with the test data, so the four raw tables are computed from
customer / nation / region / orders / lineitem, dirt included, by fixed rules
(k = c_custkey, d = 1995-01-01 + (31k mod 2340) days). The DuckDB oracle derives the
same tables with the same rules, so every query here is checked end to end.

Scale notes: nation (25 rows) and region (5 rows) are fixed-size TPC-H tables whatever the
scale factor, so they are broadcast explicitly. usage is lineitem joined to orders and
aggregated to (customer, month): lineitem hash-partitioned on the order key (what the
sort-merge join needs), the customer filter pushed into the orders scan, then a partial +
final hash aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlens import schemas as S

BASE_DATE = "1995-01-01"

# ---------------------------------------------------------------------------
# Fixed values of the adapter (dirty spellings on purpose)
# ---------------------------------------------------------------------------
ACQ_CHANNELS = ("paid search", "SOCIAL", " Organic", "referral", "Partner ")   # by k % 5
PLANS = ("BASIC", "standard", " Enterprise ", "premium")                         # by k % 4
CATEGORIES = ("billing", "TECHNICAL", " account", "Other")                       # by o_orderkey % 4
DUPLICATE_REGION = "unknown"          # region carried by the repeated customer rows
ORPHAN_CUSTOMER_ID = "Customer#X"
UNREADABLE_DATE = "not a date"


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _pick(values, idx: Column) -> Column:
    out = None
    for i, v in enumerate(values):
        out = F.when(idx == i, F.lit(v)) if out is None else out.when(idx == i, F.lit(v))
    return out


def _customer_key(custkey: Column) -> Column:
    return F.concat(F.lit("Customer#"), F.lpad(custkey.cast("string"), 9, "0"))


def _iso(d: Column) -> Column:
    return F.date_format(d, "yyyy-MM-dd")


def _customer_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _read(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    n = _read(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    r = _read(spark, sf_dir, "region").select("r_regionkey", "r_name")
    nr = n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey, "left").select("n_nationkey", "r_name")
    k = F.col("c_custkey")
    return (c.join(F.broadcast(nr), c.c_nationkey == nr.n_nationkey, "left")
            .select(k.alias("k"), "c_name", "r_name",
                    F.date_add(F.lit(BASE_DATE).cast("date"), ((k * 31) % 2340).cast("int")).alias("d")))


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = _customer_base(spark, sf_dir)
    k = F.col("k")
    region = (F.when(k % 97 == 3, F.lit(None).cast("string"))
              .when(k % 3 == 0, F.lower("r_name"))
              .otherwise(F.concat(F.lit(" "), F.col("r_name"), F.lit(" "))))
    # day-first where no month-first reading exists, then an unreadable one, then the usual layouts
    signup = (F.when((k % 41 == 6) & (F.dayofmonth("d") > 12), F.date_format("d", "dd-MM-yyyy"))
              .when(k % 89 == 12, F.lit(UNREADABLE_DATE))
              .when(k % 3 == 0, F.date_format("d", "MM-dd-yyyy"))
              .when(k % 3 == 1, F.date_format("d", "yyyy/MM/dd"))
              .otherwise(_iso(F.col("d"))))
    # repeated rows arrive after the originals, with a different region (k % 100 = 1, seq 1) or as
    # they were (k % 211 = 3, seq 2); generated from the same scan with explode instead of a second
    # pass over customers
    seq = F.explode(F.array_compact(F.array(F.lit(0), F.when(k % 100 == 1, F.lit(1)), F.when(k % 211 == 3, F.lit(2)))))
    b = b.select("*", seq.alias("seq"))
    rows = b.select(
        F.when(k % 149 == 20, F.lit(None).cast("string")).otherwise(F.col("c_name")).alias("customer_id"),
        F.when(k % 86 == 5, F.lit(-5.0)).when(k % 60 == 7, F.lit(None).cast("double"))
         .when(k % 73 == 9, F.lit(120.0))
         .otherwise((F.lit(18) + k % 60).cast("double")).alias("age"),
        F.when(F.col("seq") == 1, F.lit(DUPLICATE_REGION)).otherwise(region).alias("region"),
        signup.alias("signup_date"),
        _pick(PLANS, k % 4).alias("plan"),
        _pick(ACQ_CHANNELS, k % 5).alias("acq_channel"),
        F.when(k % 8 < 4, F.lit("monthly")).otherwise(F.lit("ANNUAL ")).alias("contract_type"),
        F.struct("seq", "k").alias(S.INGEST_ORDER),
    )
    return rows


def raw_subscriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a few customers without a subscription, a few with two, a few ids that no customer has
    b = _customer_base(spark, sf_dir).where(F.col("k") % 50 != 9)
    k, d = F.col("k"), F.col("d")
    again = F.explode(F.when(k % 101 == 30, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    b = b.select("*", again.alias("again"))
    plan = (F.when(k % 29 == 0, F.lit(None).cast("string"))
            .when(k % 7 == 0, F.lit("basic")).otherwise(_pick(PLANS, k % 4)))
    contract = (F.when(k % 31 == 0, F.lit(None).cast("string"))
                .when(k % 8 < 4, F.lit("monthly")).otherwise(F.lit("ANNUAL ")))
    churned = (k * 13) % 20 < 7
    churn_date = (F.when(churned & (k % 51 == 0), F.date_sub(d, 10))
                  .when(churned & (k % 67 == 1), F.lit(None).cast("date"))
                  .when(churned, F.date_add(d, ((k * 37) % 900).cast("int")))
                  .when(k % 83 == 0, F.date_add(d, 5)))
    customer_id = (F.when(k % 149 == 20, F.lit(None).cast("string"))
                   .when(k % 131 == 40, F.concat(F.lit("Gone#"), k.cast("string"))).otherwise(F.col("c_name")))
    return b.select(
        customer_id.alias("customer_id"),
        plan.alias("plan"),
        F.when(k % 113 == 50, F.lit(-9.5)).otherwise((F.lit(20) + k % 180 + F.col("again")).cast("double")).alias("mrr"),
        contract.alias("contract_type"),
        F.when(k % 127 == 60, F.lit(UNREADABLE_DATE)).otherwise(_iso(d)).alias("signup_date"),
        F.when(churned & (k % 59 == 7), F.lit(UNREADABLE_DATE)).otherwise(_iso(churn_date)).alias("churn_date"),
        # some already as cleaning writes them, so that the rules on raw text find rows
        F.when(churned, F.when(k % 4 == 1, F.lit("Churned")).otherwise(F.lit("churned")))
         .otherwise(F.when(k % 2 == 0, F.lit("Active")).otherwise(F.lit(" ACTIVE"))).alias("status"),
    )


def raw_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = (_read(spark, sf_dir, "orders")
         .select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"))
    ok = F.col("o_orderkey")
    priority = (F.when(F.col("o_orderpriority") == "1-URGENT", F.lit(" critical"))
                .when(F.col("o_orderpriority") == "2-HIGH", F.lit("HIGH"))
                .when(F.col("o_orderpriority") == "3-MEDIUM", F.lit("medium"))
                .otherwise(F.lit("low ")))
    return o.select(
        ok.cast("string").alias("ticket_id"),
        F.when(ok % 750 == 0, F.lit(ORPHAN_CUSTOMER_ID)).when(ok % 970 == 1, F.lit(None).cast("string"))
         .otherwise(_customer_key(F.col("o_custkey"))).alias("customer_id"),
        F.when(ok % 1009 == 5, F.lit(UNREADABLE_DATE)).otherwise(_iso(F.col("o_orderdate"))).alias("created_date"),
        priority.alias("priority"),
        _pick(CATEGORIES, ok % 4).alias("category"),
        F.when(F.col("o_orderstatus") == "O", F.lit("no")).otherwise(F.lit("YES ")).alias("resolved"),
    )


def raw_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = (_read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
         .where(F.col("o_custkey") % 11 != 0))
    # Hash-partition lineitem on the join key up front. A sort-merge join with orders does this
    # anyway (no extra shuffle at scale); when orders is small enough to broadcast it still
    # spreads the join and the partial aggregate over all cores even if lineitem arrives in a
    # few large row groups.
    li = (_read(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity", "l_shipdate")
          .repartition("l_orderkey"))
    per_month = (li.join(o, li.l_orderkey == o.o_orderkey, "inner")
                 .groupBy(F.col("o_custkey"), F.trunc(F.to_date("l_shipdate"), "MM").alias("m"))
                 .agg(F.sum("l_quantity").alias("q"), F.count(F.lit(1)).alias("n")))
    ck = F.col("o_custkey")
    modulus = F.when(ck % 3 == 0, F.lit(8)).when(ck % 3 == 1, F.lit(25)).otherwise(F.lit(51))
    return per_month.select(
        F.when(ck % 157 == 30, F.concat(F.lit("Gone#"), ck.cast("string"))).otherwise(_customer_key(ck)).alias("customer_id"),
        F.when((ck % 163 == 40) & (F.col("n") == 1), F.lit(UNREADABLE_DATE)).otherwise(_iso(F.col("m"))).alias("month"),
        (F.col("q").cast("long") % modulus - 2).alias("logins"),
        F.when(ck % 37 == 8, -F.col("n")).otherwise(F.col("n") - 1).alias("features_used"),
        F.when(ck % 43 == 9, F.lit(-1.0)).otherwise((F.col("q") * 3).cast("double")).alias("active_minutes"),
    )


def raw_tables_from_testdata(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The four raw (bronze, typed) tables for one test-data directory."""
    return {
        S.CUSTOMERS: raw_customers(spark, sf_dir),
        S.SUBSCRIPTIONS: raw_subscriptions(spark, sf_dir),
        S.TICKETS: raw_tickets(spark, sf_dir),
        S.USAGE: raw_usage(spark, sf_dir),
    }
