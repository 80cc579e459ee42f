"""Raw -> silver -> gold as lazy plans. Building one starts no job and reads nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from churnlens import schemas as S
from churnlens.operators import clean, features
from churnlens.params import ChurnParams
from churnlens.sources.testdata import raw_tables_from_testdata


def silver_from_raw(raw: dict[str, DataFrame], params: ChurnParams) -> dict[str, DataFrame]:
    return clean.clean_all(raw, params)


def gold_from_silver(silver: dict[str, DataFrame], params: ChurnParams) -> DataFrame:
    return features.customer_features(
        silver[S.CUSTOMERS], silver[S.SUBSCRIPTIONS], silver[S.USAGE], silver[S.TICKETS], params)


def raw_from_testdata(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return raw_tables_from_testdata(spark, sf_dir)


def silver_from_testdata(spark: SparkSession, sf_dir: str, params: ChurnParams) -> dict[str, DataFrame]:
    return silver_from_raw(raw_from_testdata(spark, sf_dir), params)


def gold_from_testdata(spark: SparkSession, sf_dir: str, params: ChurnParams) -> DataFrame:
    return gold_from_silver(silver_from_testdata(spark, sf_dir, params), params)
