"""Sinks: materialize a result as a table, a view, or a scratch copy."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..session import scratch_path


def materialize(
    df: DataFrame,
    name: str,
    kind: str = "scratch",
    path: str | None = None,
    partition_by: list[str] | None = None,
) -> DataFrame:
    """Write ``df`` once and return a DataFrame reading it back.

    kind="table": ``saveAsTable(name)`` (full rebuild, as a table model).
    kind="view": a temporary view, nothing written.
    kind="scratch": Parquet under the shared ``spark.checkpoint.dir`` (or
    ``path``); used where a result is read more than once, so it is computed
    once, survives executor loss and cuts the lineage. ``session.remove_scratch``
    deletes these folders when their readers are done.
    """
    spark = df.sparkSession
    if kind == "view":
        df.createOrReplaceTempView(name)
        return spark.table(name)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if kind == "table":
        writer.format("parquet").saveAsTable(name)
        return spark.table(name)
    if kind != "scratch":
        raise ValueError(f"unknown materialization {kind!r}")
    target = path or scratch_path(spark, name)
    writer.parquet(target)
    return spark.read.schema(df.schema).parquet(target)


def clustered_table(df: DataFrame, name: str, by: Sequence[str], order: Sequence[str] = (), buckets: int = 16, dealt: bool = False) -> DataFrame:
    """Write ``df`` as a table whose files are bucketed by ``by`` and sorted by ``by`` and ``order``, and read it.

    Aggregations and windows on ``by`` (or on more columns) and joins on exactly ``by`` between
    tables of as many buckets need no exchange. Rows are dealt to their bucket's task before
    the write, so there is one file a bucket; ``dealt`` says that they are already, by
    ``repartition(buckets, *by)``. Give a number of buckets that grows with the rows, as a bucket is
    one task's work. Meant for tables with bounded rows a key, like
    daily ones: a bucket with a hot key of raw events is one task's work for every reader, and those
    are better left to AQE. The files lie in the shared folder, under a table name of their own;
    ``session.remove_scratch`` removes them.
    """
    spark, by = df.sparkSession, list(by)
    table = f"{name}_{uuid.uuid4().hex}"
    rows = (df if dealt else df.repartition(buckets, *by)).sortWithinPartitions(*by, *order)
    writer = rows.write.format("parquet").bucketBy(buckets, *by).sortBy(*by, *order)
    writer.option("path", scratch_path(spark, name)).saveAsTable(table)
    return spark.table(table)


def write_folders(df: DataFrame, path: str, folder: str, by: str, buckets: int) -> None:
    """Write ``df`` in one folder for each value of ``folder``, its files bucketed by ``by``, for ``stored_folders``."""
    table = f"mortar_folders_{uuid.uuid4().hex}"
    df.write.format("parquet").partitionBy(folder).bucketBy(buckets, by).option("path", path).saveAsTable(table)
    df.sparkSession.sql(f"DROP TABLE {table}")  # its files stay


@contextmanager
def stored_folders(spark: SparkSession, path: str, schema: T.StructType, folder: str, by: str, buckets: int) -> Iterator[DataFrame]:
    """What ``write_folders`` wrote, with columns of ``schema``, dealt by ``by`` over ``buckets`` tasks as it lies: no exchange.

    It is read through a table of its own, which goes when the block ends.
    """
    table, columns = f"mortar_folders_{uuid.uuid4().hex}", ", ".join(f"`{c.name}` {c.dataType.simpleString()}" for c in schema)
    quoted = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet OPTIONS (path '{quoted}') PARTITIONED BY (`{folder}`) CLUSTERED BY (`{by}`) INTO {buckets} BUCKETS")
    try:
        spark.catalog.recoverPartitions(table)
        yield spark.table(table)
    finally:
        spark.sql(f"DROP TABLE {table}")
