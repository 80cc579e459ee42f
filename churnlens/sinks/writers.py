"""Sinks.

Writes go through Spark's file commit protocol (task output is only published when the
job commits), so a lost executor means re-run tasks, never half-written tables.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.errors import UnsupportedOperationException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlens import schemas as S
from churnlens.operators.joins import JOIN_KEY, with_join_key


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "overwrite",
                sort_within: list[str] | None = None) -> str:
    """Parquet table. With ``partition_by`` rows are first sorted by the partition columns
    inside each task, so a task keeps one open file at a time. ``sort_within`` sorts each task's
    rows (no shuffle) so Parquet row-group min/max statistics are narrow on those columns and a
    range filter on them skips most row groups."""
    w = df
    if partition_by or sort_within:
        w = df.sortWithinPartitions(*(list(partition_by or []) + list(sort_within or [])))
    writer = w.write.mode(mode).option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


LAYOUT = "_layout"


def key_fits_buckets(df: DataFrame, buckets: int, key: str = "customer_id", hot_factor: float = 4.0) -> bool:
    """Whether no key holds more than ``hot_factor`` times the rows of a mean bucket: a bucket is one
    task, so a table with such a key is better left unbucketed. One aggregate, two numbers read."""
    per_key = with_join_key(df, key).groupBy(*JOIN_KEY).agg(F.count(F.lit(1)).alias("n"))
    most, rows = per_key.agg(F.max("n"), F.sum("n")).first()
    return most is None or most <= hot_factor * max(1.0, rows / buckets)


def write_bucketed(df: DataFrame, path: str, buckets: int, key: str = "customer_id",
                   sort_within: list[str] | None = None) -> str:
    """Parquet files bucketed by the null-safe key columns of ``key`` (``JOIN_KEY``, which are written
    too), one file a bucket, rows in ``sort_within`` order inside it. Tables of equal ``buckets`` join and
    group by that key without an exchange when read with ``sources.silver.read_star``. The number of
    buckets lies beside the table in ``<path>_layout``."""
    spark, path = df.sparkSession, path.rstrip("/")
    rows = with_join_key(df, key).repartition(buckets, *JOIN_KEY)
    writer = rows.write.format("parquet").mode("overwrite").option("compression", "zstd").option("path", path)
    writer = writer.bucketBy(buckets, *JOIN_KEY)
    if sort_within:
        writer = writer.sortBy(*sort_within)
    name = bucketed_name(path)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    writer.saveAsTable(name)
    spark.createDataFrame([(buckets, df.schema.json())], "buckets int, columns string").coalesce(1).write.mode(
        "overwrite").json(path + LAYOUT)
    return path


def bucketed_name(path: str) -> str:
    """The name under which a session's catalog knows the bucketed table at ``path``."""
    return "star_" + hashlib.sha256(path.rstrip("/").encode()).hexdigest()[:24]


def _pandas_text(df: DataFrame) -> DataFrame:
    """Booleans as True / False, as pandas writes them."""
    return df.select(*[
        F.when(F.col(f.name), F.lit("True")).when(~F.col(f.name), F.lit("False")).alias(f.name)
        if isinstance(f.dataType, T.BooleanType) else F.col(f.name)
        for f in df.schema.fields])


def _csv_writer(df: DataFrame, mode: str, header: bool):
    return (df.write.mode(mode).option("header", header).option("emptyValue", "")
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
            .option("nullValue", "").option("escape", '"').option("dateFormat", "yyyy-MM-dd"))


def write_csv_export(df: DataFrame, path: str, pandas_style: bool = True, mode: str = "overwrite") -> str:
    """CSV with a header for BI tools; blanks around values are kept. Empty strings and NULLs are both written as nothing
    (as pandas ``to_csv`` does); with ``pandas_style`` booleans are written True/False.
    The export stays split in part files; ``write_csv_file`` makes one file of them."""
    _csv_writer(_pandas_text(df) if pandas_style else df, mode, header=True).csv(path)
    return path


def write_csv_file(df: DataFrame, path: str, order_by: list[str]) -> str:
    """One CSV file with one header line and the rows in the order of ``order_by`` (NULLs first, then all
    other columns), in the format of ``write_csv_export``.

    Tasks sort and write the parts (a range partitioning: no task holds the table) beside ``path`` under a
    name of their own; then the file system joins them in order. On HDFS that is ``concat``, which moves no
    bytes; other file systems get them appended one after the other through a fixed buffer. The file
    appears under ``path`` by a rename at the end, so a reader never sees half of it and a failed
    attempt leaves the last file in place."""
    spark = df.sparkSession
    text = _pandas_text(df)
    order = [*order_by, *[c for c in text.columns if c not in order_by]]
    work = f"{path}.{uuid.uuid4().hex}"
    _csv_writer(text.orderBy(*[F.col(c).asc_nulls_first() for c in order]), "error", header=False).csv(f"{work}/parts")
    names = spark.createDataFrame([tuple(text.columns)], ", ".join(f"`c{i}` string" for i in range(len(text.columns))))
    _csv_writer(names.coalesce(1), "error", header=False).csv(f"{work}/header")

    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path
    fs = at(work).getFileSystem(conf)

    def files(folder: str) -> list:
        found = [s.getPath() for s in fs.listStatus(at(folder)) if s.getPath().getName().startswith("part-") and s.getLen() > 0]
        return sorted(found, key=lambda p: p.getName())
    whole, parts = at(f"{work}/parts/_whole"), files(f"{work}/parts")
    fs.rename(files(f"{work}/header")[0], whole)  # concat wants all files in one folder
    if parts:
        try:
            sources = spark.sparkContext._gateway.new_array(at, len(parts))
            for i, p in enumerate(parts):
                sources[i] = p
            fs.concat(whole, sources)
        except UnsupportedOperationException:  # no HDFS
            joined = at(f"{work}/joined")
            out = fs.create(joined)
            for p in [whole, *parts]:
                source = fs.open(p)
                jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, out, 1 << 20, False)
                source.close()
            out.close()
            whole = joined
    fs.delete(at(path), True)
    if not fs.rename(whole, at(path)):
        raise OSError(f"could not rename {whole.toString()} to {path}")
    fs.delete(at(work), True)
    return path


def quality_report_nested(report: DataFrame) -> DataFrame:
    """(section, metric, value) rows -> one row with a metric map per section.

    Each section holds a fixed handful of metrics, so ``collect_list`` per section is bounded.
    """
    sections = list(S.TABLES)
    entries = F.map_from_entries(F.collect_list(F.struct("metric", "value")))
    return report.groupBy().pivot("section", sections).agg(entries)


def write_quality_json(report: DataFrame, path: str, mode: str = "overwrite") -> str:
    """The nested quality report as one JSON document (a single one-row part file)."""
    quality_report_nested(report).coalesce(1).write.mode(mode).json(path)
    return path
