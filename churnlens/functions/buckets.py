"""Binning expressions (ordered categories as label + rank)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from churnlens.functions._util import as_col
from churnlens.params import (
    ENGAGEMENT_EDGES, ENGAGEMENT_LABELS, TENURE_EDGES, TENURE_LABELS, TICKET_BUCKET_LABELS,
)


def _left_closed(col: Column, edges, labels, as_rank: bool) -> Column:
    out = None
    for i, (lo, hi) in enumerate(zip(edges[:-1], edges[1:])):
        cond = (col >= F.lit(lo)) & (col < F.lit(hi))
        val = F.lit(i) if as_rank else F.lit(labels[i])
        out = F.when(cond, val) if out is None else out.when(cond, val)
    return out


def _right_closed(col: Column, edges, labels, as_rank: bool) -> Column:
    out = None
    for i, (lo, hi) in enumerate(zip(edges[:-1], edges[1:])):
        cond = (col > F.lit(lo)) & (col <= F.lit(hi))
        val = F.lit(i) if as_rank else F.lit(labels[i])
        out = F.when(cond, val) if out is None else out.when(cond, val)
    return out


def tenure_bucket(days) -> Column:
    """[0,90) 0-3m, [90,180) 3-6m, [180,365) 6-12m, [365,730) 12-24m, [730,9999) 24m+, else NULL."""
    return _left_closed(as_col(days), TENURE_EDGES, TENURE_LABELS, False)


def tenure_rank(days) -> Column:
    return _left_closed(as_col(days), TENURE_EDGES, TENURE_LABELS, True)


def engagement_tier(avg_logins) -> Column:
    """(-1,0] Inactive, (0,5] Low, (5,15] Medium, (15,9999] High, else NULL."""
    return _right_closed(as_col(avg_logins), ENGAGEMENT_EDGES, ENGAGEMENT_LABELS, False)


def engagement_rank(avg_logins) -> Column:
    return _right_closed(as_col(avg_logins), ENGAGEMENT_EDGES, ENGAGEMENT_LABELS, True)


def ticket_bucket(n_tickets) -> Column:
    """0 / 1-2 / 3-5 / 6+ tickets; a missing count is 0."""
    n = F.coalesce(as_col(n_tickets), F.lit(0))
    zero, low, mid, high = TICKET_BUCKET_LABELS
    return (F.when(n == 0, F.lit(zero)).when(n <= 2, F.lit(low))
            .when(n <= 5, F.lit(mid)).otherwise(F.lit(high)))
