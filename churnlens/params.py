"""Job parameters and the fixed values the results depend on."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Fixed values (must stay as they are for results to match)
# ---------------------------------------------------------------------------

# Strings that pandas.read_csv reads as missing by default (its na_values list).
PANDAS_NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
)

# Audit-flag labels.
NEGATIVE_AGE = "NEGATIVE_AGE"
ACTIVE_WITH_CHURN_DATE = "ACTIVE_WITH_CHURN_DATE"
CHURN_BEFORE_SIGNUP = "CHURN_BEFORE_SIGNUP"

# Status / ticket values compared after standardisation.
STATUS_ACTIVE = "Active"
STATUS_CHURNED = "Churned"
RESOLVED_NO = "No"
PRIORITY_CRITICAL = "Critical"

# Tenure buckets: left-closed day ranges [lo, hi).
TENURE_EDGES = (0, 90, 180, 365, 730, 9999)
TENURE_LABELS = ("0-3m", "3-6m", "6-12m", "12-24m", "24m+")

# Engagement tiers on rounded mean monthly logins: right-closed ranges (lo, hi].
ENGAGEMENT_EDGES = (-1, 0, 5, 15, 9999)
ENGAGEMENT_LABELS = ("Inactive", "Low", "Medium", "High")

# Ticket-volume buckets of the ticket report: 0, <=2, <=5, more.
TICKET_BUCKET_LABELS = ("0 tickets", "1-2 tickets", "3-5 tickets", "6+ tickets")

# Data-quality findings and their severity, in report order.
FINDINGS = (
    ("customers", "duplicate rows", "HIGH"),
    ("customers", "negative ages", "MEDIUM"),
    ("customers", "mixed date formats", "MEDIUM"),
    ("customers", "null regions", "LOW"),
    ("subscriptions", "active + churn date", "HIGH"),
    ("subscriptions", "churn before signup", "HIGH"),
    ("tickets", "orphan records", "LOW"),
)

# Null-rate severity thresholds (percent): > HIGH is HIGH, > MEDIUM is MEDIUM, else LOW.
NULL_RATE_HIGH = 20.0
NULL_RATE_MEDIUM = 5.0

# Customer signup dates come in several layouts; month-first wins.
CUSTOMER_DATE_FORMATS = ("M-d-yyyy", "yyyy/M/d", "yyyy-M-d", "M/d/yyyy", "M/d/yy", "M-d-yy", "d MMM yyyy", "MMM d, yyyy",
                         "yyyyMMdd", "yyyy.M.d", "M.d.yyyy")
# Layouts that are tried day-first when no month-first one fits.
DAY_FIRST_FORMATS = ("d-M-yyyy", "d/M/yyyy", "d.M.yyyy")
# A time of day behind a date, left off before the date is read.
TIME_OF_DAY = r"[T ]\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:?\d{2})?$"
ISO_DATE_FORMAT = "yyyy-M-d"


@dataclass(frozen=True)
class ChurnParams:
    """Parameters of one analysis run."""

    as_of: dt.date = dt.date(2025, 6, 1)
    recency_days: int = 90
    customer_date_formats: tuple[str, ...] = CUSTOMER_DATE_FORMATS
    # pandas' mixed parser still reads 13-04-2024 as 13 April; keep that by default.
    day_first_fallback: bool = True
    # single-layout columns of tables without an order of rows; with one, a column's first value shows its layout
    iso_date_format: str = ISO_DATE_FORMAT
    # layouts of single-layout columns that are known: (("subscriptions", "churn_date", "M/d/yyyy"), ...)
    column_date_formats: tuple[tuple[str, str, str], ...] = ()
    null_tokens: tuple[str, ...] = field(default=PANDAS_NULL_TOKENS)
    # per-column overrides: ((table, column, tokens), ...), e.g. keep a region code "NA"
    column_null_tokens: tuple[tuple[str, str, tuple[str, ...]], ...] = ()
    # also bound the recency windows above by as_of (rows dated later are then left out)
    recency_upper_bound: bool = False
    # salts of the joins whose row-level side may be skewed: about the tasks that a hot key may take
    salts: int = 16
    # quoted CSV fields may hold line breaks. None: files that have such fields are found and read by one
    # task each, the others stay split; True: every file is read by one task; False: a record is a line
    csv_multiline: bool | None = None

    def tokens_for(self, table: str, column: str) -> tuple[str, ...]:
        for t, c, tokens in self.column_null_tokens:
            if t == table and c == column:
                return tokens
        return self.null_tokens

    def has_date_format(self, table: str, column: str) -> bool:
        return any((t, c) == (table, column) for t, c, _ in self.column_date_formats)

    def date_format(self, table: str, column: str) -> str:
        for t, c, fmt in self.column_date_formats:
            if t == table and c == column:
                return fmt
        return self.iso_date_format

    @property
    def cutoff(self) -> dt.date:
        """First day inside the recency window (inclusive)."""
        return self.as_of - dt.timedelta(days=self.recency_days)


# The analysis date used with the supplied test data (some dates lie after it on purpose).
TESTDATA_AS_OF = dt.date(2001, 6, 1)
TESTDATA_PARAMS = ChurnParams(as_of=TESTDATA_AS_OF)
