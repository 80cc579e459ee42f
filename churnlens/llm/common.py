"""Helpers shared by the operators: tables in the shared folder, file systems, folds."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from churnlens.session import checkpoint_dir


#: Rows of an Arrow batch that are Python values at once: texts may be long.
SLICE = 256


def release() -> None:
    """Give freed Arrow buffers back to the system: its pool would keep those of the largest batch in a
    Python worker that Spark uses again for later stages."""
    pa.default_memory_pool().release_unused()


def run_folder(spark: SparkSession, name: str) -> str:
    """A new folder name under ``spark.checkpoint.dir``, which all executors share."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back: the lineage is cut, and a
    lost executor costs no more than the tasks it ran."""
    spark = df.sparkSession
    path = run_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def replaced(df: DataFrame, name: str, old: str | None) -> tuple[DataFrame, str]:
    """``df`` written and read back, and its folder; the folder ``old`` of the table that it replaces is
    removed, once the new one is whole. For rounds that each need only the last one's table."""
    spark = df.sparkSession
    path = run_folder(spark, name)
    df.write.parquet(path)
    if old:
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(old)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
    return spark.read.schema(df.schema).parquet(path), path


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """Names like ``wanted`` that no column of ``df`` has."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def fold(key: Column, modulus: int) -> Column:
    """crc32 of the key as text, modulo ``modulus``; a null key counts as the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % modulus


def batched(schema: pa.Schema, rows: Iterator[tuple], size: int = 4096) -> Iterator[pa.RecordBatch]:
    """Row tuples as Arrow batches of at most ``size`` rows."""
    buffer: list[tuple] = []
    for row in rows:
        buffer.append(row)
        if len(buffer) >= size:
            yield to_batch(schema, buffer)
            buffer = []
    if buffer:
        yield to_batch(schema, buffer)


def to_batch(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def map_rows(df: DataFrame, fn: Callable[[Iterator[tuple]], Iterator[tuple]], schema: pa.Schema,
             ddl: str, batch: int = 4096) -> DataFrame:
    """``fn`` turns the row tuples of a partition into output tuples; data moves in Arrow batches, of
    which ``SLICE`` rows at a time become Python values."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for b in batches:
                for at in range(0, b.num_rows, SLICE):
                    yield from zip(*(c.to_pylist() for c in b.slice(at, SLICE).columns), strict=True)
                release()
        yield from batched(schema, fn(rows()), batch)
        release()
    return df.mapInArrow(run, ddl)


def scored_by(score: Callable[[list], np.ndarray], text: Column) -> Column:
    """``score`` of the texts, ``SLICE`` at a time, as a double column."""
    @F.arrow_udf("double")
    def run(batch: pa.Array) -> pa.Array:
        parts = [score(batch.slice(at, SLICE).to_pylist()) for at in range(0, len(batch), SLICE)]
        release()
        return pa.array(np.concatenate(parts) if parts else np.zeros(0), pa.float64())
    return run(text)


def open_fs(uri: str):
    """The Arrow file system and the path in it for a folder or file URI, as tasks use them to
    write and read the binary formats of this package (file, hdfs, s3 and gs URIs)."""
    from pyarrow import fs

    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri.removeprefix("file:")
    return fs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri}")


def files_by_task(manifest: DataFrame, task_mb: int = 256) -> DataFrame:
    """The rows of ``manifest`` (path, bytes, ...), dealt to tasks by their running bytes: at most about
    ``task_mb`` a task, and less where that would leave cores idle. The running sum sees one row a file."""
    spark = manifest.sparkSession
    files, total = manifest.agg(F.count("*"), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    tasks = max(1, min(files, max(2 * spark.sparkContext.defaultParallelism, -(-total // (task_mb << 20)))))
    before = F.coalesce(F.sum("bytes").over(Window.orderBy("path").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    task = F.least(F.floor(before * tasks / F.lit(max(1, total))), F.lit(tasks - 1)).cast("int")
    return manifest.withColumn("task", task).repartitionById(tasks, F.col("task")).drop("task")


def labelled_sample(labels: DataFrame, label: str, modulus: int, held_out: int, rows: int) -> DataFrame:
    """doc_id, label of at most ``rows`` labelled documents outside the held-out fold, the first in
    the order of a hash of doc_id: a documented bound, so the result may be broadcast. A doc_id with
    several labels counts as 1 if any is; null ids and labels other than 0 and 1 are left out."""
    kept = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & (fold(F.col("doc_id"), modulus) != held_out))
    one = kept.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(label).cast("int").alias("label"))
    return one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def sampled_texts(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """doc_id, text, label of the sample's documents; the sample is bounded by its row limit."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return slim.join(F.broadcast(sample), "doc_id")


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 50) -> np.ndarray:
    """Coefficients of a logistic model with a ridge on all but the constant."""
    b = np.zeros(x.shape[1])
    penalty = np.full(len(b), ridge)
    penalty[0] = 1e-6
    for _ in range(rounds):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ b, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty), x.T @ (y - p) - penalty * b)
        b += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return b
