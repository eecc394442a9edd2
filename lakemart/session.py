"""Session factory and the checkpoint-directory rule.

Library code never creates a session of its own; it takes the caller's.
``get_session`` is for scripts, tests and ``bench.py``.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

SESSION_DEFAULTS = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(
    app_name: str = "lakemart",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the settings the package assumes."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder for intermediate tables, configuring it if needed.

    The cluster names one in ``spark.checkpoint.dir``; that one is always used.
    Only a local-mode session without the setting (tests) uses its warehouse
    folder; anywhere else a missing setting is an error, because a machine-local
    folder does not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; name a shared folder for checkpoints"
            )
        configured = f"{spark.conf.get('spark.sql.warehouse.dir')}/_intermediate"
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


#: Bytes of the tables a query reads for which its shuffles begin with one partition.
SHUFFLE_BYTES = 12 << 20


def bytes_at(spark: SparkSession, paths: Iterable[str]) -> int:
    found = (hadoop_path(spark, p) for p in paths)
    return sum(fs.getContentSummary(path).getLength() for path, fs in found)


def size_shuffles(spark: SparkSession, paths: Iterable[str]) -> int:
    """Let shuffles begin with as many partitions as the bytes at ``paths`` ask for.

    A fixed number makes tasks that grow with the input, until every sort and
    aggregate spills all it holds. Adaptive execution merges partitions that turn out
    small; without it the session's own number holds. Spark reads the setting when a
    plan runs, after the query has been handed over, so it stays set.
    """
    n = max(shuffle_partitions(spark), -(-bytes_at(spark, paths) // SHUFFLE_BYTES))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(n))
    return n


def new_folder(spark: SparkSession, kind: str) -> str:
    """Path of a new folder in the shared folder; it goes when the driver ends."""
    path = f"{ensure_checkpoint_dir(spark)}/{kind}-{uuid.uuid4().hex}"
    jvm_path, fs = hadoop_path(spark, path)
    fs.deleteOnExit(jvm_path)
    return path


def hadoop_path(spark: SparkSession, path: str):
    """``path`` and its file system, as the JVM's objects."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path, jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())


def store(df: DataFrame) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    For frames with two readers or more: ``df`` is computed once, readers still
    prune columns and push filters down, and the files do not depend on the
    executors that wrote them. They go when the driver ends.
    """
    spark = df.sparkSession
    path = new_folder(spark, "stored")
    df.write.option("compression", "zstd").parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    stored._stored_at = path
    return stored


def discard(stored: DataFrame) -> None:
    """Delete the files of a frame that ``store`` gave, once nothing reads it any more."""
    path = getattr(stored, "_stored_at", None)
    if path is None:
        raise ValueError("not a stored frame")
    jvm_path, fs = hadoop_path(stored.sparkSession, path)
    fs.delete(jvm_path, True)


def store_for_rounds(df: DataFrame, partition_mb: int = 64) -> DataFrame:
    """``store`` for a frame that an iterative job reads hundreds of times.

    A scan of many small files makes a task of each, and an iterative job pays
    for every task in every round. Here the number of partitions follows the
    bytes written: one for each ``partition_mb``, one at least.
    """
    spark = df.sparkSession
    path = new_folder(spark, "stored")
    df.write.option("compression", "zstd").parquet(path)
    jvm_path, fs = hadoop_path(spark, path)
    size = fs.getContentSummary(jvm_path).getLength()
    return spark.read.schema(df.schema).parquet(path).coalesce(max(1, -(-size // (partition_mb << 20))))
