"""Property tests: Spark expressions against their Python definitions on random inputs.
Each hypothesis example is one batch of values evaluated in a single Spark job."""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from churnlens.functions import clean_text, np_round, pct_half_up

# letters with simple case mappings, digits, punctuation, spaces/tabs, an uncased script
ALPHABET = "abcXYZéÜñøÆ-'/1 2\t.中文_"
SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(st.lists(st.text(alphabet=ALPHABET, max_size=16), min_size=1, max_size=150))
def test_clean_text_equals_python_strip_title(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    got = [r[0] for r in df.orderBy("i").select(clean_text(F.col("v"))).collect()]
    assert got == [v.strip().title() for v in values]


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 10 ** 9), st.integers(1, 10 ** 9)), min_size=1, max_size=150))
def test_pct_half_up_equals_exact_rounding(spark, pairs):
    pairs = [(min(n, d), d) for n, d in pairs]
    df = spark.createDataFrame([(i, n, d) for i, (n, d) in enumerate(pairs)], "i int, n long, d long")
    got = [r[0] for r in df.orderBy("i").select(pct_half_up("n", "d", 1)).collect()]
    want = [math.floor(Fraction(1000 * n, d) + Fraction(1, 2)) / 10 for n, d in pairs]
    assert got == want


@SETTINGS
@given(st.lists(st.floats(min_value=-1e6, max_value=1e6, allow_nan=False), min_size=1, max_size=150))
def test_np_round_equals_numpy(spark, xs):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i int, x double")
    got = [r[0] for r in df.orderBy("i").select(np_round("x", 2)).collect()]
    want = [float(np.round(x, 2)) for x in xs]
    assert all(g == w or (g == 0 and w == 0) for g, w in zip(got, want))


def _date_text(draw):
    import datetime as dt
    d = draw(st.dates(min_value=dt.date(1990, 1, 1), max_value=dt.date(2030, 12, 31)))
    pad = draw(st.booleans())
    m, dd = (f"{d.month:02d}", f"{d.day:02d}") if pad else (str(d.month), str(d.day))
    layout = draw(st.sampled_from(["mdy", "ymd_slash", "iso", "dmy", "mdy_slash", "mdy_short", "day_name",
                                  "compact", "ymd_dot", "mdy_time", "iso_time", "junk"]))
    if layout == "mdy":
        return f"{m}-{dd}-{d.year}"
    if layout == "ymd_slash":
        return f"{d.year}/{m}/{dd}"
    if layout == "iso":
        return f"{d.year}-{m}-{dd}"
    others = {"mdy_slash": f"{m}/{dd}/{d.year}", "mdy_short": f"{m}/{dd}/{d.year % 100:02d}",
              "day_name": d.strftime("%d %b %Y"), "compact": d.strftime("%Y%m%d"), "ymd_dot": f"{d.year}.{d.month:02d}.{d.day:02d}",
              "mdy_time": f"{d.month:02d}-{d.day:02d}-{d.year} 10:00", "iso_time": f"{d.isoformat()} 07:08:09"}
    if layout == "mdy_short" and d.year < 2000:
        return d.isoformat()
    if layout in others:
        return others[layout]
    if layout == "dmy":   # only day-first readable when the day is above 12
        return f"{dd}-{m}-{d.year}"
    return draw(st.sampled_from(["junk", "", "2024-13-45", "31-31-2024", "n/a"]))


@SETTINGS
@given(st.lists(st.composite(lambda draw: _date_text(draw))(), min_size=1, max_size=120))
def test_mixed_dates_equal_pandas_mixed_parser(spark, values):
    import pandas as pd
    from churnlens.functions import parse_mixed_date
    from churnlens.params import CUSTOMER_DATE_FORMATS
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    got = [r[0] for r in df.orderBy("i").select(parse_mixed_date(F.col("v"), CUSTOMER_DATE_FORMATS, True)).collect()]
    # each value parsed alone: pandas' mixed parser decides per element
    want = [pd.to_datetime(pd.Series([v]), format="mixed", dayfirst=False, errors="coerce").iloc[0] for v in values]
    want = [None if pd.isna(w) else w.date() for w in want]
    assert got == want
