"""Session configuration shared by every job.

The settings pin the semantics the analytics depend on (UTC clock, ANSI
casts, text partition values) and switch on adaptive execution so joins
against dimensions that turn out small at runtime become broadcasts only
after their real size has been measured.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Semantic settings: results depend on these, so every session gets them.
SEMANTIC_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # load_date stays text and compares lexically, as in the source views.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}

# Execution settings: safe at any scale, tuned further per cluster.
EXECUTION_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Shuffles start with many partitions and are merged to the advisory size
    # (compressed; a sort holds over ten times that), so what one task sorts
    # stays the same as the tables grow.
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "1024",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16MB",
    "spark.sql.files.maxPartitionBytes": "32MB",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Runtime (measured) size bound for converting a shuffle join to a
    # broadcast join; static estimates are not trusted for that decision.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the semantic and execution settings to an existing session."""
    for key, value in {**SEMANTIC_CONF, **EXECUTION_CONF}.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder for intermediate tables: ``spark.checkpoint.dir``.

    Only a local session (tests, single-node bench) without that setting gets
    a temporary folder; anywhere else executors could not read one another's
    files, so a missing setting is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    path = tempfile.mkdtemp(prefix="examlytics-shared-")
    spark.sparkContext.setCheckpointDir(path)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet under a fresh path of the shared folder and read it back.

    Cuts the lineage: later plans scan columns (with pruning and pushdown),
    and a lost executor re-reads files instead of recomputing stages.
    """
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_bytes(df: DataFrame) -> int:
    """Bytes of the folders that hold a table made by :func:`keep`."""
    spark, total = df.sparkSession, 0
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        total += path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(path).getLength()
    return total


def discard(df: DataFrame) -> None:
    """Delete the folder of a table made by :func:`keep` (nothing else is touched)."""
    spark = df.sparkSession
    root = shared_dir(spark)
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        if path.toUri().getPath().startswith(spark._jvm.org.apache.hadoop.fs.Path(root).toUri().getPath() + "/"):
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "examlytics") -> SparkSession:
    """Session for tests and single-node benchmarks (UI off, no extra ports)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("EXAMLYTICS_DRIVER_MEMORY", "8g"))
    )
    for key, value in {**SEMANTIC_CONF, **EXECUTION_CONF}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
