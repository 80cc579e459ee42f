"""Schemas of the four raw tables.

CSV files are read with every column as text (no inference pass, nothing lost on dirty
values); ``RAW_TYPES`` then casts with ``try_cast``. Dates stay text until cleaning.
"""

from __future__ import annotations

from pyspark.sql import types as T

CUSTOMERS = "customers"
SUBSCRIPTIONS = "subscriptions"
TICKETS = "tickets"
USAGE = "usage"
TABLES = (CUSTOMERS, SUBSCRIPTIONS, TICKETS, USAGE)

# Known columns of each raw file, in the order results list them.
RAW_COLUMNS = {
    CUSTOMERS: ("customer_id", "age", "region", "signup_date", "plan", "acq_channel", "contract_type"),
    SUBSCRIPTIONS: ("customer_id", "plan", "mrr", "contract_type", "signup_date", "churn_date", "status"),
    TICKETS: ("ticket_id", "customer_id", "created_date", "priority", "category", "resolved"),
    USAGE: ("customer_id", "month", "logins", "features_used", "active_minutes"),
}

# Typed raw (bronze) columns; anything not listed is a string.
RAW_TYPES = {
    CUSTOMERS: {"age": T.DoubleType()},
    SUBSCRIPTIONS: {"mrr": T.DoubleType()},
    TICKETS: {},
    USAGE: {"logins": T.LongType(), "features_used": T.LongType(), "active_minutes": T.DoubleType()},
}

# Raw file names as delivered.
RAW_FILES = {
    CUSTOMERS: "customers.csv",
    SUBSCRIPTIONS: "subscriptions.csv",
    TICKETS: "support_tickets.csv",
    USAGE: "usage_monthly.csv",
}

# Star-schema table names (silver) and the flat table (gold).
DIM_CUSTOMERS = "dim_customers"
DIM_SUBSCRIPTIONS = "dim_subscriptions"
FACT_TICKETS = "fact_support_tickets"
FACT_USAGE = "fact_usage_monthly"
FEATURES = "analytical_customer_features"
SILVER = {CUSTOMERS: DIM_CUSTOMERS, SUBSCRIPTIONS: DIM_SUBSCRIPTIONS, TICKETS: FACT_TICKETS, USAGE: FACT_USAGE}

# Column that records ingest order of customer rows (first one wins on duplicate keys).
INGEST_ORDER = "_ingest_order"


# Date columns of one layout each (customers' signup dates are mixed).
SINGLE_LAYOUT_DATES = {SUBSCRIPTIONS: ("signup_date", "churn_date"), TICKETS: ("created_date",), USAGE: ("month",)}
# Column with the layouts that were found for a table's date columns.
LAYOUTS = "_layouts"


def raw_type(table: str, column: str) -> T.DataType:
    return RAW_TYPES[table].get(column, T.StringType())
