"""A slowly changing dimension: change events, validity ranges, daily grain, snapshots.

``validity_ranges`` derives the ranges from all events. ``merge_changes`` keeps them in a
table instead and takes events in batches, in any order, reading and writing only what
the keys of a batch touch. ``write_snapshots`` adds days to a growing table of snapshots.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..session import path_exists, remove_path
from ..sources.sinks import materialize


def daily_changes(events: DataFrame, key: str, day: str, order: str, value: str) -> DataFrame:
    """The value that holds at the end of each day with a change: (key, day, order, value).

    The last event of a day by ``order`` wins, among equal ones the greatest value. One
    aggregation with partial combining, so a key with a third of all events reaches the
    windows below as one row a day. Events without a day are left out.
    """
    last = F.max(F.struct(F.col(order).alias("o"), F.col(value).alias("v")))
    known = events.where(F.col(day).isNotNull())
    return known.groupBy(key, F.col(day).alias("day")).agg(last.alias("_last")).select(key, "day", F.col("_last.o").alias(order), F.col("_last.v").alias(value))


def ranges_of(changes: DataFrame, key: str, value: str) -> DataFrame:
    """(key, value, valid_from, valid_to) from one value a (key, day); a day that changes nothing begins no range."""
    w = Window.partitionBy(key).orderBy("day")
    first = F.row_number().over(w) == 1
    starts = changes.withColumn("_new", first | ~F.col(value).eqNullSafe(F.lag(value).over(w))).where("_new")
    return starts.select(key, value, F.col("day").alias("valid_from"), F.lead("day").over(w).alias("valid_to"))


def validity_ranges(events: DataFrame, key: str, day: str, order: str, value: str) -> DataFrame:
    """(key, value, valid_from, valid_to): ``valid_to`` is exclusive, NULL for the current value.

    Days on which the value stays as it was don't begin a range; NULL is a value like others.
    """
    return ranges_of(daily_changes(events, key, day, order, value), key, value)


# --------------------------------------------------------------------------- ranges kept in a table

#: Folders that a store of ranges is divided in, by a hash of the key.
BUCKETS = 64


def merge_changes(path: str, events: DataFrame, key: str, day: str, order: str, value: str, buckets: int = BUCKETS) -> int:
    """Merge a batch of change events, late ones too, into the ranges stored at ``path``; returns the folders written.

    The store has a range for each (key, day) with a change: (key, value, valid_from, valid_to,
    order), so a late event splits the range it falls into, replaces one that began that day if
    it is later by ``order``, and closes or extends its neighbours; whatever the batches and their
    order, the result is that of one batch (``order`` must not depend on the batch). Ranges
    of equal value side by side stay apart here, as a later batch may come between; ``read_ranges``
    joins them.

    Only folders that hold a key of the batch are read and written again, and in them only
    the batch's keys are worked out anew. The new folders are written aside first, then put in
    place of the old ones by one commit, so a job that fails leaves the store as it was.
    """
    spark = events.sparkSession
    fresh = materialize(daily_changes(events, key, day, order, value), "changes")
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
    keys = fresh.select(F.col(key).alias("_k")).distinct()
    touched = sorted(r[0] for r in fresh.select(bucket.alias("b")).distinct().collect())  # at most ``buckets``
    if not touched:
        return 0
    kept, known = None, fresh
    if path_exists(spark, path):
        stored = spark.read.parquet(path).where(F.col("bucket").isin(touched)).drop("bucket")
        same = F.col(key).eqNullSafe(F.col("_k"))
        kept = stored.join(keys, same, "left_anti")
        hit = stored.join(keys, same, "left_semi").select(key, F.col("valid_from").alias("day"), order, value)
        last = F.max(F.struct(F.col(order).alias("o"), F.col(value).alias("v"))).alias("_last")
        known = hit.unionByName(fresh).groupBy(key, "day").agg(last).select(key, "day", F.col("_last.o").alias(order), F.col("_last.v").alias(value))
    until = F.lead("day").over(Window.partitionBy(key).orderBy("day"))
    merged = known.select(key, value, F.col("day").alias("valid_from"), until.alias("valid_to"), order)
    if kept is not None:
        merged = merged.unionByName(kept)
    aside = materialize(merged.withColumn("bucket", bucket), "merged-ranges")
    _replace_partitions(aside.repartition("bucket", key).sortWithinPartitions("bucket", key, "valid_from"), path, "bucket")
    return len(touched)


def read_ranges(spark: SparkSession, path: str, key: str, value: str) -> DataFrame:
    """(key, value, valid_from, valid_to) of a store, as ``validity_ranges`` gives them from all events."""
    return ranges_of(spark.read.parquet(path).withColumnRenamed("valid_from", "day"), key, value)


def _replace_partitions(rows: DataFrame, path: str, *columns: str) -> None:
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*columns).parquet(path)


def daily_grain(ranges: DataFrame, key: str, value: str, start: str, end: str) -> DataFrame:
    """(key, date, value) for every day in [start, end) that a range covers."""
    a = F.greatest(F.col("valid_from"), F.lit(start).cast("date"))
    b = F.least(F.coalesce(F.col("valid_to"), F.lit(end).cast("date")), F.lit(end).cast("date"))
    covered = ranges.where(a < b)
    return covered.select(key, F.explode(F.sequence(a, F.date_sub(b, 1))).alias("date"), value)


def value_on_day(facts: DataFrame, day: str, ranges: DataFrame, key: str, value: str) -> DataFrame:
    """Add to each fact the value that held for its key on its day; NULL where none did.

    An interval join by month: a range is copied to each month it covers and meets a fact
    under (key, month), so no fact meets more ranges than a month has days. Spark
    broadcasts ranges that are small and splits a hot key otherwise. NULL keys and days meet nothing.
    """
    month = lambda d: F.trunc(d, "month")
    last = facts.agg(F.max(month(F.col(day).cast("date")))).first()[0]
    until = F.least(F.coalesce(month(F.date_sub("valid_to", 1)), F.lit(last)), F.lit(last)) if last else F.col("valid_from")
    months = ranges.where(month(F.col("valid_from")) <= until).select(
        F.col(key).alias("_k"), F.col(value).alias(value), F.col("valid_from").alias("_from"), F.col("valid_to").alias("_to"),
        F.explode(F.sequence(month(F.col("valid_from")), until, F.expr("interval 1 month"))).alias("_month"),
    )
    at = F.col(day).cast("date")
    met = (F.col(key) == F.col("_k")) & (month(at) == F.col("_month")) & (at >= F.col("_from")) & (F.col("_to").isNull() | (at < F.col("_to")))
    return facts.join(months, met, "left").select(*[F.col(c) for c in facts.columns], value)


def snapshot(events: DataFrame, key: str, day: str, order: str, value: str, as_of: str) -> DataFrame:
    """(snapshot_date, key, value): what holds at the end of ``as_of``, straight from the events."""
    at = F.lit(as_of).cast("date")
    last = F.max(F.struct(F.col(day).alias("d"), F.col(order).alias("o"), F.col(value).alias("v")))
    found = events.where(F.col(day) <= at).groupBy(key).agg(last.alias("_last"))
    return found.select(at.alias("snapshot_date"), key, F.col("_last.v").alias(value))


def write_snapshots(rows: DataFrame, path: str, days: Sequence[str], day_col: str = "snapshot_date") -> dict[str, int]:
    """Put the snapshots of ``days`` into the growing table at ``path``; returns the rows of each day.

    Each day is a partition. A rerun of a day replaces it, also by nothing, and other days
    stay as they are, untouched on disk. Rows of days that aren't listed are an error, so a
    wrong date can't replace a day unseen.
    """
    spark, listed = rows.sparkSession, sorted(set(days))
    counts = Observation()
    of_day = [F.count_if(F.col(day_col) == F.lit(d).cast("date")).alias(d) for d in listed]
    told = F.when(F.col(day_col).isin(*[F.lit(d).cast("date") for d in listed]), F.col(day_col)).otherwise(
        F.raise_error(F.concat(F.lit("a snapshot of a day that is not listed: "), F.coalesce(F.col(day_col).cast("string"), F.lit("NULL"))))
    )
    watched = rows.withColumn(day_col, told.cast("date")).observe(counts, *of_day)
    _replace_partitions(watched, path, day_col)
    written = {d: counts.get[d] for d in listed}
    for d in (d for d, n in written.items() if not n):
        remove_path(spark, f"{path}/{day_col}={d}")
    return written
