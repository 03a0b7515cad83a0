"""Spark session and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def get_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "mortar") -> SparkSession:
    """Session for local runs and tests.

    On a cluster the session comes from spark-submit and none of these
    settings are forced; here they keep local runs small and quiet.
    """
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("MORTAR_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


# Settings for a large cluster (e.g. ~1000 executors over ~100 TB of Parquet),
# passed to spark-submit; the plans do not depend on them for correctness.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Start wide and let AQE coalesce to ~256 MB per reducer.
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    # Split skewed sort-merge join partitions at runtime.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    # Size-checked broadcasts only (statistics or runtime sizes).
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
    # spark.checkpoint.dir: set by the cluster to shared storage.
}


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and materialized tables.

    Taken from ``spark.checkpoint.dir`` (or the context's checkpoint dir) as
    the cluster names it. Only when neither is set and the master is local
    (tests, local runs) a fresh scratch folder is made and registered; on a
    cluster a missing setting is an error, never a machine-local folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: on a cluster it must name shared storage "
            "(checkpoints and materialized intermediates are written there)"
        )
    path = tempfile.mkdtemp(prefix="mortar-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


_scratch: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared checkpoint folder, remembered for ``remove_scratch``."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _scratch.append(path)
    return path


def _hadoop_path(spark: SparkSession, path: str):
    """(file system, path) of a name, whatever store it is in."""
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), found


def qualified_path(spark: SparkSession, path: str) -> str:
    """The whole name of a path, with its store; a table's path would be looked for in the warehouse otherwise."""
    fs, found = _hadoop_path(spark, path)
    return fs.makeQualified(found).toString()


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, found = _hadoop_path(spark, path)
    return fs.exists(found)


def remove_path(spark: SparkSession, path: str) -> bool:
    """Delete a folder or file with all in it; whether there was one."""
    fs, found = _hadoop_path(spark, path)
    return fs.delete(found, True)


def replace_path(spark: SparkSession, new: str, old: str) -> bool:
    """Put ``new``, of the same store, in the place of ``old``; without a ``new`` the old one just goes. Whether there was a new one."""
    fs, source = _hadoop_path(spark, new)
    there = fs.exists(source)
    remove_path(spark, old)
    if there and not fs.rename(source, _hadoop_path(spark, old)[1]):
        raise OSError(f"could not put {new} in the place of {old}")
    return there


def remove_scratch(spark: SparkSession) -> int:
    """Delete what this process wrote to scratch folders; returns how many there were.

    Call it when results that read them are written. DataFrames built before can't be used
    afterwards.
    """
    removed = 0
    while _scratch:
        removed += bool(remove_path(spark, _scratch.pop()))
    return removed


@contextmanager
def settings(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """Settings of the session that hold within the block; put back after it."""
    before = {name: spark.conf.get(name, None) for name in conf}
    try:
        for name, value in conf.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
