"""Read written star-schema tables and expose them to Spark SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from churnlens import schemas as S
from churnlens.operators.joins import JOIN_KEY
from churnlens.sinks.writers import LAYOUT, bucketed_name


def read_silver(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    """dim/fact tables written by the batch job, keyed by the raw table name."""
    root = base.rstrip("/")
    return {t: spark.read.parquet(f"{root}/{S.SILVER[t]}").drop(*JOIN_KEY) for t in S.TABLES}


def _layout(spark: SparkSession, path: str):
    """(buckets, schema) of a table written by ``write_bucketed``; None for a plain one."""
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path + LAYOUT)
    if not jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(jvm_path):
        return None
    row = spark.read.schema("buckets int, columns string").json(path + LAYOUT).first()
    import json

    return row["buckets"], T.StructType.fromJson(json.loads(row["columns"]))


def read_star(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    """Like ``read_silver``, but bucketed tables keep their layout and key columns: joins and
    aggregates on ``JOIN_KEY`` need no exchange. Any session can read them; the bucket layout is
    registered in its catalog first."""
    tables = {}
    for t in S.TABLES:
        path = f"{base.rstrip('/')}/{S.SILVER[t]}"
        layout = _layout(spark, path)
        if layout is None:
            tables[t] = spark.read.parquet(path)
            continue
        buckets, schema = layout
        known = T.StructType([*schema.fields, T.StructField("_jk", T.StringType()), T.StructField("_jk_null", T.BooleanType())])
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in known.fields)
        name = bucketed_name(path)
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({', '.join(JOIN_KEY)}) "
                  f"INTO {buckets} BUCKETS LOCATION '{path}'")
        tables[t] = spark.table(name)
    return tables


def register_views(tables: dict[str, DataFrame]) -> None:
    """Temp views under the star-schema names used by the SQL reports."""
    for t, df in tables.items():
        df.createOrReplaceTempView(S.SILVER.get(t, t))
