"""Every registered query against its DuckDB oracle (the driver's check, on sf0.001)."""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from churnlens.checks.compare import compare, duckdb_views
from churnlens.plans.catalog import QUERIES as CATALOG
from tests.conftest import SF_SMALL

QUERIES = {k: v for k, v in E.queries().items() if k in CATALOG}
ORACLE = {k: v for k, v in E.oracle_sql().items() if k in CATALOG}


@pytest.fixture(scope="module")
def duck():
    return duckdb_views(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE) == set(CATALOG)


SPARK_TO_DUCK = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
                 "date": "DATE", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    sdf = QUERIES[name](spark, SF_SMALL)
    rel = duck.sql(ORACLE[name])
    spark_types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
                   for f in sdf.schema.fields}
    assert spark_types == {c: str(t) for c, t in zip(rel.columns, rel.types)}
    status, detail = compare(sdf.toPandas(), rel.df())
    assert status == "OK", detail


def test_entry_runs(spark):
    df = E.entry(spark)
    assert len(df.columns) == 32 and df.count() > 0
