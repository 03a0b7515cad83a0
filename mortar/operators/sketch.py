"""Mergeable quantile sketch: a log-linear histogram kept as rows.

A value is counted in a bucket that keeps the first ``BITS + 1`` binary digits of its units
(hundredths, unless told otherwise), so buckets are exact for small values and a 128th wide
beyond. Sketches are rows (keys, metric, bucket, n): made by one aggregation, stored like any
table, and merged by adding counts, which gives exactly the sketch of all the rows. There are at
most 64 * 128 buckets of either sign, whatever the rows, so what ranks them is bounded.

Error: a quantile comes back as the middle of its bucket. It is off by 1/256 of itself at
most (1/2 unit for values below 256 units), and by nothing in rank but for values of that bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Binary digits kept after the first.
BITS = 7
#: Values are counted in units of 10 ** -SCALE.
SCALE = 2
#: Units beyond this are counted as this.
MOST = 1 << 62


def _shift(name: str, value: Column, by: Column) -> Column:
    return F.call_function(name, value, by.cast("int"))


def bucket_of(value: Column, scale: int = SCALE) -> Column:
    """The bucket of a number, in the order of the numbers; NULL for NULL and NaN."""
    units = F.round(value.cast("double") * F.lit(float(10**scale)))
    sized = F.when(F.abs(units) >= float(MOST), F.lit(MOST)).otherwise(F.abs(units)).cast("long")
    # digits beyond those that are kept; F.bin has the first one at the left
    shift = F.greatest(F.length(F.bin(sized)) - (BITS + 1), F.lit(0))
    place = _shift("shiftleft", shift.cast("long"), F.lit(BITS)) + _shift("shiftright", sized, shift)
    return F.when(value.isNull() | F.isnan(value.cast("double")), F.lit(None).cast("long")).when(units < 0, -place).otherwise(place)


def middle_of(bucket: Column, scale: int = SCALE) -> Column:
    """The number in the middle of a bucket."""
    place = F.abs(bucket)
    shift = F.greatest(_shift("shiftright", place, F.lit(BITS)) - 1, F.lit(0)).cast("int")
    low = _shift("shiftleft", place - _shift("shiftleft", shift.cast("long"), F.lit(BITS)), shift)
    middle = (low + (_shift("shiftleft", F.lit(1).cast("long"), shift) - 1) / 2) / F.lit(float(10**scale))
    return F.when(bucket < 0, -middle).otherwise(middle)


def sketch_of(df: DataFrame, keys: Sequence[str], metrics: Sequence[str], scale: int = SCALE) -> DataFrame:
    """(keys, metric, bucket, n) of each metric; bucket NULL counts NULLs and NaN.

    Equal values are counted first, so a bucket is worked out once a value and not once a row.
    """
    each = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics]))
    counted = df.select(*keys, each.alias("_m")).groupBy(*keys, "_m.metric", "_m.value").agg(F.count(F.lit(1)).alias("n"))
    return counted.select(*keys, "metric", bucket_of(F.col("value"), scale).alias("bucket"), "n").groupBy(*keys, "metric", "bucket").agg(F.sum("n").alias("n"))


def merge(sketches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sketches with coarser keys: as if they had been made of all the rows."""
    return sketches.groupBy(*keys, "metric", "bucket").agg(F.sum("n").alias("n"))


def trailing(sketches: DataFrame, day: str, days: int) -> DataFrame:
    """For every day of the sketches the merged one of it and the ``days`` - 1 days before."""
    ends = sketches.select(F.col(day).alias("_end")).distinct()
    moved = sketches.withColumn("_end", F.explode(F.transform(F.sequence(F.lit(0), F.lit(days - 1)), lambda i: F.date_add(F.col(day), i))))
    summed = moved.groupBy("_end", "metric", "bucket").agg(F.sum("n").alias("n"))
    return summed.join(ends, "_end", "left_semi").withColumnRenamed("_end", day)


def quantiles(sketches: DataFrame, keys: Sequence[str], wanted: dict[str, int], scale: int = SCALE) -> DataFrame:
    """(keys, metric, n_values, n_nulls, and each wanted quantile, given in thousandths).

    A quantile is the smallest value that at least so many of the values don't exceed.
    """
    group = Window.partitionBy(*keys, "metric")
    there = F.when(F.col("bucket").isNotNull(), F.col("n")).otherwise(F.lit(0))
    up_to = F.sum(there).over(group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranked = sketches.withColumn("_up", up_to).withColumn("_all", F.sum(there).over(group))
    reached = lambda q: F.col("bucket").isNotNull() & (F.col("_up") * 1000 >= F.col("_all") * q)
    return ranked.groupBy(*keys, "metric").agg(
        F.sum(there).alias("n_values"),
        F.sum(F.col("n") - there).alias("n_nulls"),
        *[middle_of(F.min(F.when(reached(q), F.col("bucket"))), scale).alias(name) for name, q in wanted.items()],
    )
