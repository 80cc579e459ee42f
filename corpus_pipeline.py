"""From raw documents to packed training sequences, in five stages.

quality (rejected documents go), toxicity (toxic ones go), near duplicates (one document of each
group stays), mixture (documents repeated or left out to reach the sources' target weights), packing
(the pieces of the sequences). Each stage is written and read again before the next one starts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from churnlens.llm import mixing, packing, quality, simhash, toxicity
from churnlens.llm.common import written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, _labels(spark, sf_dir))


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep_clean(docs, _labels(spark, sf_dir))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs, null_ids_stay=False)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # executors that went through four stages before have less room for remembered words
    return packing.pack_documents(docs, cache_entries=200_000)


STAGES: list[tuple[str, Stage]] = [("quality", good), ("toxicity", clean), ("near_duplicates", distinct),
                                   ("mixture", mixed), ("packing", packed)]

# The stages rest on trained models, XXH64 and a tokenizer, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
