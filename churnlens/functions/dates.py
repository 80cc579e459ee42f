"""Date parsing that never throws: unparsable text becomes NULL."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlens.functions._util import as_col
from churnlens.params import CUSTOMER_DATE_FORMATS, DAY_FIRST_FORMATS, ISO_DATE_FORMAT, TIME_OF_DAY

# Layouts that a column may turn out to have, month-first ones before day-first ones.
LAYOUTS = (ISO_DATE_FORMAT, *[f for f in CUSTOMER_DATE_FORMATS if f != ISO_DATE_FORMAT], *DAY_FIRST_FORMATS)
MIXED = -1


def without_time(c) -> Column:
    """The date part of a text: a time of day at the end is left off."""
    return F.regexp_replace(F.trim(as_col(c)), TIME_OF_DAY, "")


def parse_date(c, fmt: str) -> Column:
    """One layout, with or without a time of day; bad text -> NULL (``cast`` would throw under
    ANSI mode)."""
    return F.try_to_date(without_time(c), fmt)


def parse_mixed_date(c, formats: Sequence[str], day_first_fallback: bool = True) -> Column:
    """First layout that parses wins; month-first layouts come first. A time of day is left off.

    With ``day_first_fallback`` a value such as 13-04-2024 that no month-first layout accepts
    is read day-first, as pandas' mixed parser does.
    """
    col = without_time(c)
    tries = [F.try_to_date(col, f) for f in formats]
    if day_first_fallback:
        tries += [F.try_to_date(col, f) for f in DAY_FIRST_FORMATS]
    return F.coalesce(*tries)


def layout_of(c) -> Column:
    """Number (in ``LAYOUTS``) of the first layout that reads a value; ``MIXED`` if none does."""
    col = without_time(c)
    tries = [F.when(F.try_to_date(col, f).isNotNull(), F.lit(i)) for i, f in enumerate(LAYOUTS)]
    return F.coalesce(*tries, F.lit(MIXED))


def column_layouts(df: DataFrame, columns: Sequence[str], order: str) -> Column:
    """The layouts of ``columns`` of ``df`` as a struct in a scalar subquery: each that of the column's first
    value in ``order`` that isn't NULL. One aggregate over these columns, run once while the query runs."""
    first = [F.min_by(layout_of(c), F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in columns]
    return df.agg(F.struct(*first).alias("layouts")).scalar()


def parse_by_layout(c, layout: Column, formats: Sequence[str]) -> Column:
    """Values in the layout of that number; other values are NULL. A column whose first value no layout
    reads is read value by value, as a mixed one."""
    col = without_time(c)
    out = F.when(layout == MIXED, parse_mixed_date(c, formats))
    for i, f in enumerate(LAYOUTS):
        out = out.when(layout == i, F.try_to_date(col, f))
    return out
