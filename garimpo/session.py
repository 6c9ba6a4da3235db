"""Session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# String partition values keep their zero padding ("05" must not become 5).
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # Plans are built from many Column calls; recording a call site for each doubles that time.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "garimpo", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    builder = builder.config("spark.ui.showConsoleProgress", "false")
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def cluster_settings(shuffle_bytes: int, partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Partition sizes for the largest shuffle of a job; AQE merges what turns out smaller."""
    partitions = max(200, -(-shuffle_bytes // partition_bytes))
    return {
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
    }


def shared_folder(spark: SparkSession) -> str:
    """Folder for tables that cut lineage.

    The cluster names it in ``spark.checkpoint.dir``. Only a local master may fall back to
    a temporary folder, because there every executor shares the driver's disk.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    return "file:" + os.path.join(tempfile.gettempdir(), "garimpo")


# Paths that this process has handed out, by application.
_handed_out: dict[str, list[str]] = {}


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path nobody has written to yet, below the shared folder."""
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    _handed_out.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def release(spark: SparkSession) -> int:
    """Remove every intermediate table of this application; call it once the results have been read.

    A lazy result reads its intermediate tables when it runs, so operators cannot do this themselves.
    """
    return sum(remove_path(spark, path) for path in _handed_out.pop(spark.sparkContext.applicationId, []))


def remove_path(spark: SparkSession, path: str) -> bool:
    """Remove a folder through the Hadoop file system; False when it was not there."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True))


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target))
