"""SparkSession settings and the checkpoint folder rule."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(app: str = "churnlens", cpus: int | None = None, shuffle_partitions: int | None = None,
                  driver_memory: str = "8g", extra: dict | None = None) -> SparkSession:
    """A local session for tests and benchmarks. On a cluster use the cluster's session and
    keep its settings; only ``session_defaults`` are applied there. ``CHURNLENS_SESSION_TZ``
    runs the checks under another session time zone."""
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    b = (SparkSession.builder.master(f"local[{cpus}]").appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.memory", driver_memory)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    conf = {**SESSION_DEFAULTS, **(extra or {})}
    if os.environ.get("CHURNLENS_SESSION_TZ"):
        conf["spark.sql.session.timeZone"] = os.environ["CHURNLENS_SESSION_TZ"]
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


# Settings the jobs rely on; all are standard Spark SQL options.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # broadcast decided on measured (runtime) sizes, capped
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
}


def session_defaults(spark: SparkSession) -> None:
    """Apply the job settings to an existing session without overriding ones already set."""
    for k, v in SESSION_DEFAULTS.items():
        if spark.conf.get(k, None) in (None, ""):
            spark.conf.set(k, v)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; set one only when it is unset and Spark runs
    in this one process (tests, local runs), never override the cluster's."""
    current = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if current:
        return current
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError(f"{CHECKPOINT_CONF} is not set: on a cluster ({master}) it must name a folder that the "
                           "driver and all executors share")
    local = tempfile.mkdtemp(prefix="churnlens-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.sparkContext.setCheckpointDir(local)
    spark.conf.set(CHECKPOINT_CONF, local)
    return spark.sparkContext.getCheckpointDir() or local


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def shared_table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back: its lineage is cut, and its size is
    known to the planner."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
