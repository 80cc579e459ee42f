"""Segment rates by grouping sets equal the single reports."""

from __future__ import annotations

import pytest

from churnlens import schemas as S
from churnlens.operators import reports as RP
from churnlens.operators import segments as SG
from churnlens.params import TESTDATA_PARAMS as P
from churnlens.plans.layers import gold_from_silver, silver_from_raw
from churnlens.session import shared_table
from churnlens.sources import raw_tables_from_testdata
from tests.conftest import SF_SMALL
from tests.test_plans import _final_plan


@pytest.fixture(scope="module")
def silver(spark):
    tables = silver_from_raw(raw_tables_from_testdata(spark, SF_SMALL), P)
    return {t: shared_table(df, f"silver-{t}") for t, df in tables.items()}


@pytest.fixture(scope="module")
def gold(silver):
    return shared_table(gold_from_silver(silver, P), "gold")


def same(got, want):
    assert got.schema.simpleString() == want.schema.simpleString()
    assert got.collect() == want.collect()


def test_star_reports(silver):
    c, s = silver[S.CUSTOMERS], silver[S.SUBSCRIPTIONS]
    segments = shared_table(SG.star_segments(c, s, P), "segments")
    same(SG.churn_by_plan_from(segments), RP.churn_by_plan(s))
    same(SG.churn_by_plan_contract_from(segments), RP.churn_by_plan_contract(c, s, P))
    same(SG.channel_performance_from(segments), RP.channel_performance(c, s, P))


def test_flat_reports(gold):
    segments = shared_table(SG.flat_segments(gold), "segments")
    same(SG.churn_by_tenure_from(segments), RP.churn_by_tenure(gold))
    same(SG.churn_by_engagement_from(segments), RP.churn_by_engagement(gold))
    same(SG.channel_volume_from(segments), RP.channel_volume(gold))


def test_one_scan_each(spark, silver, gold):
    plan = _final_plan(SG.star_segments(silver[S.CUSTOMERS], silver[S.SUBSCRIPTIONS], P))
    assert plan.count("silver-customers") == 1 and plan.count("silver-subscriptions") == 1
    assert _final_plan(SG.flat_segments(gold)).count("Scan parquet") == 1


def test_empty_tables(silver, gold):
    none = {t: df.limit(0) for t, df in silver.items()}
    assert SG.star_segments(none[S.CUSTOMERS], none[S.SUBSCRIPTIONS], P).count() == 0
    assert SG.flat_segments(gold.limit(0)).count() == 0
