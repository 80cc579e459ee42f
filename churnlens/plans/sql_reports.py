"""The five report queries as Spark SQL over the star-schema temp views.

Four reports are one statement with different parts: ``units`` gives rows that stand for n
subscriptions (or for one customer without any) with c of them churned, already summed per customer or
segment, ``labels`` names the segment, ``means`` the further columns. The trend report is a statement of
its own over units per customer and month. ``CURRENT_DATE`` is the job's ``as_of`` parameter, so a result doesn't depend on the day of the
run. Sums of money are DECIMAL.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from churnlens import schemas as S
from churnlens.params import ChurnParams
from churnlens.sources.silver import register_views

# 100 * churned / rows to one decimal, half away from zero: exact in DECIMAL
RATE = "CAST(ROUND(CAST(100 * SUM(c) AS DECIMAL(38, 12)) / SUM(n), 1) AS DOUBLE)"

SUBSCRIPTION_UNITS = """
    SELECT customer_id, plan, contract_type, COUNT(*) AS n, SUM(INT(status = 'Churned')) AS c,
           SUM(CAST(mrr AS DECIMAL(20, 6))) AS mrr, COUNT(mrr) AS mrr_n,
           SUM(DATEDIFF(COALESCE(churn_date, :as_of), signup_date)) AS days,
           COUNT(DATEDIFF(COALESCE(churn_date, :as_of), signup_date)) AS days_n
    FROM dim_subscriptions GROUP BY customer_id, plan, contract_type"""

CUSTOMER_UNITS = f"""
    SELECT COALESCE(u.plan, k.plan) AS plan_final, COALESCE(u.contract_type, k.contract_type) AS contract_type_final,
           k.acq_channel, COALESCE(u.n, 1) AS n, COALESCE(u.c, 0) AS c, u.mrr, u.mrr_n, u.days, u.days_n
    FROM dim_customers k LEFT JOIN ({SUBSCRIPTION_UNITS}) u ON u.customer_id = k.customer_id"""

TICKET_UNITS = f"""
    SELECT CASE WHEN f.tickets IS NULL THEN '0 tickets' WHEN f.tickets <= 2 THEN '1-2 tickets'
                WHEN f.tickets <= 5 THEN '3-5 tickets' ELSE '6+ tickets' END AS ticket_bucket, u.n, u.c
    FROM ({SUBSCRIPTION_UNITS}) u
    LEFT JOIN (SELECT customer_id, COUNT(*) AS tickets FROM fact_support_tickets GROUP BY customer_id) f
      ON f.customer_id = u.customer_id"""

MEAN_MRR = "ROUND(TRY_DIVIDE(DOUBLE(SUM(mrr)), SUM(mrr_n)), 0) AS avg_mrr"
MEAN_DAYS = "ROUND(TRY_DIVIDE(DOUBLE(SUM(days)), SUM(days_n)), 0) AS avg_tenure_days"


@dataclass(frozen=True)
class SegmentReport:
    units: str
    labels: tuple[str, ...]
    total: str = "total_customers"
    churned: str | None = "churned_customers"
    means: tuple[str, ...] = ()

    def sql(self) -> str:
        measures = [f"SUM(n) AS {self.total}", *([f"SUM(c) AS {self.churned}"] if self.churned else []),
                    f"{RATE} AS churn_rate_pct", *self.means]
        labels = ", ".join(self.labels)
        order = ", ".join(f"{c} NULLS FIRST" for c in ("churn_rate_pct DESC", *self.labels))
        return f"SELECT {labels}, {', '.join(measures)} FROM ({self.units}) GROUP BY {labels} ORDER BY {order}"


PLAN_UNITS = """
    SELECT plan, COUNT(*) AS n, SUM(INT(status = 'Churned')) AS c FROM dim_subscriptions GROUP BY plan"""

# churned subscriptions, summed per customer and month of the churn date
MONTH_UNITS = """
    SELECT customer_id, TRUNC(churn_date, 'MM') AS churn_month, COUNT(*) AS n, SUM(CAST(mrr AS DECIMAL(20, 6))) AS mrr
    FROM dim_subscriptions WHERE status = 'Churned' AND churn_date IS NOT NULL GROUP BY ALL"""

# one statement: windows over the months' sums
TREND = f"""
    SELECT churn_month, SUM(n) AS churned_count, DOUBLE(SUM(mrr)) AS mrr_lost,
           DOUBLE(SUM(n) - MAX(SUM(n)) OVER month_before) AS change_vs_prev_month,
           SUM(SUM(n)) OVER so_far AS cumulative_churned, DOUBLE(SUM(SUM(mrr)) OVER so_far) AS cumulative_mrr_lost
    FROM ({MONTH_UNITS}) GROUP BY churn_month
    WINDOW so_far AS (ORDER BY churn_month ROWS UNBOUNDED PRECEDING),
           month_before AS (ORDER BY churn_month ROWS BETWEEN 1 PRECEDING AND 1 PRECEDING)
    ORDER BY churn_month"""

SQL = {
    "churn_by_plan": SegmentReport(PLAN_UNITS, ("plan",)).sql(),
    "churn_trend_monthly": TREND,
    "churn_by_plan_contract": SegmentReport(CUSTOMER_UNITS, ("plan_final", "contract_type_final"), means=(MEAN_MRR,)).sql(),
    "churn_by_ticket_bucket": SegmentReport(TICKET_UNITS, ("ticket_bucket",), "customers", None).sql(),
    "channel_performance": SegmentReport(CUSTOMER_UNITS, ("acq_channel",), churned=None, means=(MEAN_DAYS, MEAN_MRR)).sql(),
}


def run(silver: dict[str, DataFrame], name: str, params: ChurnParams) -> DataFrame:
    """Register the silver tables as views and run one report query."""
    register_views(silver)
    spark = silver[S.CUSTOMERS].sparkSession
    return spark.sql(SQL[name], args={"as_of": params.as_of} if ":as_of" in SQL[name] else None)
