"""Exact deduplication as a stateful stream over a folder of Parquet files.

Two Structured Streaming queries keep a store in a shared folder. The first turns every document into
an arrival: digest of its normalised text, doc_id, length in code points and content locator (file and
row number in it). The second groups the arrivals by digest; its state, one row per digest in RocksDB
on disk with its change log in the store, has no watermark and never expires. It retains the number of
arrivals and the best one: its length, its doc_id and the locator of its content. Both queries read
what is there and stop; called again with the same store they read only new files and go on from the
state. The state is read back with Spark's state data source.

A hit is an arrival whose digest another one shares. The whole normalised texts of all hits are fetched
by their locators and compared: where one digest stands for several texts (a collision), its rows are
grouped by the text itself. So equal digests alone never make two documents equal.

Texts are equal when identical after deleting every ``[\\x20\\x09-\\x0D]``; null counts as empty, and
empty texts are equal to each other. Of equal texts the row with the most code points stays, then the
smallest doc_id (null last), then the last by file and row number, so of repeated rows exactly one.
The folder may be empty of rows; columns other than doc_id and text are not read. Long texts move
whole, through built-in functions only; a text occurs once per task in the comparison however often
it is repeated, and no step gathers a group in one task.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlens.llm.common import run_folder, written

WHITE = " \t\n\x0b\f\r"
LOCATOR = ("file", "row")

# Spark settings of the streaming session: state on disk, bounded memory for all stores of an executor.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",  # else several MB per store are reserved
}


def sha256(normalised: Column) -> Column:
    return F.sha2(normalised.cast("binary"), 256)


def content(docs: DataFrame) -> DataFrame:
    """doc_id, points, text (normalised), file, row of a Parquet scan, batch or stream."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.length(text).alias("points"),
                       F.translate(text, WHITE, "").alias("text"), F.col("_metadata.file_path").alias("file"),
                       F.col("_metadata.row_index").alias("row"))


def best() -> Column:
    """The row that stays, largest first: most code points, smallest doc_id (its complement is largest,
    null is smallest), locator."""
    return F.max(F.struct("points", F.bitwise_not("doc_id").alias("id"), *LOCATOR)).alias("best")


def ingest(spark: SparkSession, path: str, store: str, digest: Callable[[Column], Column] = sha256,
           max_bytes_per_trigger: int = 1 << 40, max_files_per_trigger: int | None = None) -> None:
    """Take the files of ``path`` that ``store`` has not seen into its arrivals and its state, in
    micro-batches of at most ``max_bytes_per_trigger`` (or ``max_files_per_trigger`` files). The number
    of state partitions is ``spark.sql.shuffle.partitions`` of the store's first call."""
    session = spark.newSession()  # the settings hold for these two queries only
    for k, v in STATE_CONF.items():
        session.conf.set(k, v)
    session.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    limit = ({"maxFilesPerTrigger": str(max_files_per_trigger)} if max_files_per_trigger
             else {"maxBytesPerTrigger": str(max_bytes_per_trigger)})
    path = path.rstrip("/")
    as_glob = f"{path[:-1]}[{path[-1]}]"  # the stream takes a folder or a single file alike
    docs = session.readStream.schema(spark.read.parquet(path).schema).options(**limit).parquet(as_glob)
    arrived = content(docs).select(digest(F.col("text")).alias("digest"), sha256(F.col("text")).alias("text_sha256"),
                                   "doc_id", "points", *LOCATOR)
    arrived.writeStream.format("parquet").option("checkpointLocation", f"{store}/arrivals-log").trigger(
        availableNow=True).start(f"{store}/arrivals").awaitTermination()

    arrivals = session.readStream.schema(arrived.schema).options(**limit).parquet(f"{store}/arrivals")
    state = arrivals.groupBy("digest").agg(best(), F.count("*").alias("n"))
    state.writeStream.format("noop").outputMode("update").option("checkpointLocation", f"{store}/state").trigger(
        availableNow=True).start().awaitTermination()


def retained(spark: SparkSession, store: str) -> DataFrame:
    """digest, keep_id, keep_file, keep_row, group_size: the state of ``store``."""
    rows = spark.read.format("statestore").load(f"{store}/state")
    best = F.col("value.max")
    return rows.select("key.digest", F.bitwise_not(best["id"]).alias("keep_id"), best["file"].alias("keep_file"),
                       best["row"].alias("keep_row"), F.col("value.count").alias("group_size"))


def contents_of(spark: SparkSession, path: str, rows: DataFrame) -> DataFrame:
    """``rows`` (with file and row) and the doc_id, points and normalised text at each locator. Every
    locator is one row, so no key of the join is hot."""
    return content(spark.read.parquet(path)).join(rows, list(LOCATOR))


def deduplicate(spark: SparkSession, path: str, store: str | None = None,
                digest: Callable[[Column], Column] = sha256, **limits) -> DataFrame:
    """One row per document of the Parquet folder or file ``path``: doc_id, keep_id (doc_id of the row
    that stays), group_size, kept, text_sha256, keep_file, keep_row (locator of the row that stays),
    file, row. ``store`` is a shared folder that later calls with more files continue, by default a new
    one; ``limits`` are those of ``ingest``."""
    store = store or run_folder(spark, "dedup-store")
    ingest(spark, path, store, digest, **limits)
    arrivals = spark.read.parquet(f"{store}/arrivals")
    groups = written(retained(spark, store), "dedup-groups")
    # both sides are plain written tables, so that a digest with very many arrivals is split
    found = written(arrivals.join(groups, "digest"), "dedup-found")

    hits = found.filter("group_size > 1").select("digest", *LOCATOR)
    texts = contents_of(spark, path, hits).groupBy("digest", "text").agg(F.count("*").alias("n"))
    collided = written(texts.groupBy("digest").agg(F.count("*").alias("texts")).filter("texts > 1").select("digest"),
                       "dedup-collisions")
    columns = ["doc_id", "keep_id", "group_size", (
        (F.col("file") == F.col("keep_file")) & (F.col("row") == F.col("keep_row"))).alias("kept"),
        "text_sha256", "keep_file", "keep_row", *LOCATOR]
    if collided.isEmpty():
        return found.select(*columns)
    apart = written(contents_of(spark, path, found.join(collided, "digest").select("digest", "text_sha256", *LOCATOR)),
                    "dedup-collided-texts")
    by_text = apart.groupBy("digest", "text").agg(best(), F.count("*").alias("group_size")).select(
        "digest", "text", F.bitwise_not("best.id").alias("keep_id"), F.col("best.file").alias("keep_file"),
        F.col("best.row").alias("keep_row"), "group_size")
    again = apart.join(written(by_text, "dedup-by-text"), ["digest", "text"])
    return found.join(collided, "digest", "left_anti").select(*columns).unionByName(again.select(*columns))
