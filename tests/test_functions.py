"""Expression cases (FIXTURES.md section 3)."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from churnlens.functions import (
    clean_text, clip_lower, engagement_tier, np_round, parse_date, parse_mixed_date, pct_half_up,
    tenure_bucket, ticket_bucket, title_case,
)
from churnlens.params import CUSTOMER_DATE_FORMATS, ChurnParams


def _eval(spark, values, expr, schema="v string"):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(expr(F.col("v"))).collect()]


def test_title_clean_matches_python_title(spark):
    values = ["  pRO-plus ", "o'neil x", "abc1def", "A/B x", "", None, "MIDDLE EAST", " ACTIVE", "a\tb c"]
    got = _eval(spark, values, clean_text)
    assert got == [None if v is None else v.strip().title() for v in values]


def test_strip_and_title_on_unicode(spark):
    values = ["\u00a0pro\u2003", "\x1fbasic\t", "\u4e2dab cd", "e\u0301xy", "ǆemal", "x2y-z"]
    assert _eval(spark, values, clean_text) == [v.strip().title() for v in values]


def test_title_case_only_letters_and_spaces(spark):
    assert _eval(spark, ["paid search", "SOCIAL"], title_case) == ["Paid Search", "Social"]


def test_np_round_is_half_even_on_binary(spark):
    got = _eval(spark, [0.125, 1.005, 2.675, 0.145, None], lambda c: np_round(c, 2), "v double")
    assert got == [0.12, 1.0, 2.68, 0.14, None]


def test_mixed_dates(spark):
    fmts = CUSTOMER_DATE_FORMATS
    vals = ["03-04-2024", "2024/03/04", "2024-03-04", "2024-3-4", "junk", "13-04-2024", None]
    on = _eval(spark, vals, lambda c: parse_mixed_date(c, fmts, True))
    off = _eval(spark, vals, lambda c: parse_mixed_date(c, fmts, False))
    d = dt.date(2024, 3, 4)
    assert on == [d, d, d, d, None, dt.date(2024, 4, 13), None]
    assert off == [d, d, d, d, None, None, None]


def test_single_format_date_never_throws(spark):
    assert _eval(spark, ["2024-03-04", "2024-3-4", "03/04/2024", ""], lambda c: parse_date(c, "yyyy-M-d")) == [
        dt.date(2024, 3, 4), dt.date(2024, 3, 4), None, None]


@pytest.mark.parametrize("days,label", [
    (0, "0-3m"), (89, "0-3m"), (90, "3-6m"), (179, "3-6m"), (180, "6-12m"), (364, "6-12m"),
    (365, "12-24m"), (729, "12-24m"), (730, "24m+"), (9998, "24m+"), (9999, None), (None, None), (-1, None)])
def test_tenure_bucket_edges(spark, days, label):
    assert _eval(spark, [days], tenure_bucket, "v int") == [label]


@pytest.mark.parametrize("x,label", [
    (0.0, "Inactive"), (0.01, "Low"), (5.0, "Low"), (5.01, "Medium"), (15.0, "Medium"),
    (15.01, "High"), (9999.0, "High"), (10000.0, None)])
def test_engagement_tier_edges(spark, x, label):
    assert _eval(spark, [x], engagement_tier, "v double") == [label]


def test_clip_keeps_null(spark):
    assert _eval(spark, [None, -2, 3], lambda c: clip_lower(c, 0), "v long") == [None, 0, 3]


def test_cutoff_is_inclusive_90_days():
    p = ChurnParams()
    assert p.cutoff == dt.date(2025, 3, 3)
    assert dt.date(2025, 3, 1) < p.cutoff


@pytest.mark.parametrize("n,label", [(None, "0 tickets"), (0, "0 tickets"), (1, "1-2 tickets"), (2, "1-2 tickets"),
                                     (3, "3-5 tickets"), (5, "3-5 tickets"), (6, "6+ tickets")])
def test_ticket_bucket(spark, n, label):
    assert _eval(spark, [n], ticket_bucket, "v long") == [label]


def test_pct_half_up_exact(spark):
    df = spark.createDataFrame([(1, 8), (199, 514), (1, 3), (2, 3), (0, 5), (1, 0), (5, 200)], "n long, d long")
    got = [r[0] for r in df.select(pct_half_up("n", "d", 1)).collect()]
    # 12.5 -> 12.5, 38.715.. -> 38.7, 33.33.. -> 33.3, 66.66.. -> 66.7, 0, den 0 -> NULL, 2.5 exact
    assert got == [12.5, 38.7, 33.3, 66.7, 0.0, None, 2.5]
    ties = spark.createDataFrame([(1, 16), (3, 16)], "n long, d long")  # 6.25 and 18.75 -> half up
    assert [r[0] for r in ties.select(pct_half_up("n", "d", 1)).collect()] == [6.3, 18.8]
