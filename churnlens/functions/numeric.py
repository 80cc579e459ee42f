"""Numeric helpers with exactly specified rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from churnlens.functions._util import as_col


def np_round(c, digits: int = 2) -> Column:
    """Round like pandas/numpy ``round``: half-to-even on the scaled binary value.

    ``F.round`` rounds half-up on the decimal text of the double (0.125 -> 0.13);
    pandas gives 0.12. ``rint(x * 10^d) / 10^d`` is numpy's own definition.
    """
    scale = float(10 ** digits)
    return F.rint(as_col(c) * F.lit(scale)) / F.lit(scale)


def clip_lower(c, lower=0) -> Column:
    """``clip(lower=...)`` that keeps NULL as NULL (``greatest`` would turn NULL into 0)."""
    col = as_col(c)
    return F.when(col < F.lit(lower), F.lit(lower)).otherwise(col)


def pct_half_up(num, den, digits: int = 1) -> Column:
    """``ROUND(100.0 * num / den, digits)`` computed exactly on integers.

    Half away from zero on the exact ratio (what a numeric SQL ROUND gives), carried out in
    integer arithmetic so no binary or decimal intermediate can land on the wrong side of a
    tie. ``num`` and ``den`` are non-negative counts; NULL when ``den`` is 0.
    """
    n = as_col(num).cast("long")
    d = as_col(den).cast("long")
    scale = 10 ** (digits + 2)
    x = n * F.lit(2 * scale) + d          # 2 * 10^(digits+2) * num + den
    m = d * F.lit(2)
    # floor(x / m) without a floating-point division: x - x mod m is a multiple of m.
    q = (x - F.pmod(x, m)) / m
    return F.when(d > 0, q / F.lit(float(10 ** digits)))


def safe_ratio(num, den) -> Column:
    """num / den as double, NULL when den is 0 or NULL."""
    return F.try_divide(as_col(num).cast("double"), as_col(den).cast("double"))


def exact_mean(c, scale: int = 2) -> Column:
    """Mean of a column holding values with at most ``scale`` decimals, summed exactly.

    The sum is taken as DECIMAL, so it does not depend on the order rows arrive in
    (a double sum does), then divided once in double.
    """
    col = as_col(c)
    total = F.sum(col.cast(f"decimal(38,{scale})")).cast("double")
    return F.try_divide(total, F.count(col).cast("double"))
