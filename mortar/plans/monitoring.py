"""Monitoring of a daily table: rows, NULLs, range and quantiles of metrics by day, and what is odd in them.

``metrics_by_day`` has exact quantiles of each day. ``sketched_quantiles`` has those of days and
of runs of days from one stored sketch. ``anomalies`` holds each of a day's figures
against the days before.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators import sketch
from ..sources.sinks import materialize

QUANTILES = {"q25": 0.25, "median": 0.5, "q75": 0.75}
#: Days before that a day's row count is held against, and how far off it may be.
LOOK_BACK, TOLERANCE = 7, 0.5


def metrics_by_day(daily: DataFrame, day: str, metrics: Sequence[str]) -> DataFrame:
    """One row a day and metric: n_rows, n_nulls, low, q25, median, q75, high, rows_outlier.

    Quantiles are exact: the smallest value that at least so many of the day's values don't
    exceed. Equal values of a day are counted before any shuffle of theirs, and the running
    counts go over distinct values only. ``rows_outlier`` tells days whose row count is off
    the mean of the seven days before by more than half of it.
    """
    each = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics]))
    counted = daily.select(day, each.alias("_m")).groupBy(day, "_m.metric", "_m.value").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(day, "metric")
    up_to = w.orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    there = F.when(F.col("value").isNotNull(), F.col("n")).otherwise(0)
    ranked = counted.withColumn("_up", F.sum(there).over(up_to)).withColumn("_all", F.sum(there).over(w))
    at_least = [F.min(F.when(F.col("value").isNotNull() & (F.col("_up") >= q * F.col("_all")), F.col("value"))).alias(name) for name, q in QUANTILES.items()]
    stats = ranked.groupBy(day, "metric").agg(
        F.sum("n").alias("n_rows"),
        F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("n_nulls"),
        F.min("value").alias("low"),
        *at_least,
        F.max("value").alias("high"),
    )
    # as many rows a metric as there are days
    before = Window.partitionBy("metric").orderBy(day).rowsBetween(-LOOK_BACK, -1)
    mean = F.avg("n_rows").over(before)
    off = F.coalesce(F.abs(F.col("n_rows") - mean) > TOLERANCE * mean, F.lit(False))
    return stats.withColumn("rows_outlier", off)


#: Lengths of the runs of days that quantiles are told for.
RUNS = (1, 7, 28)


def sketched_quantiles(daily: DataFrame, day: str, metrics: Sequence[str], runs: Sequence[int] = RUNS) -> DataFrame:
    """(day, days, metric, n_values, n_nulls, q25, median, q75) of each day and of the days up to it.

    The sketch of each day is made once and stored; a run of days adds up stored sketches and
    never reads the rows again. The error is the sketch's (see ``operators.sketch``).
    """
    stored = materialize(sketch.sketch_of(daily, [day], metrics), "daily-sketch")
    wanted = {name: round(1000 * q) for name, q in QUANTILES.items()}
    told = None
    for days in runs:
        merged = stored if days == 1 else sketch.trailing(stored, day, days)
        part = sketch.quantiles(merged.withColumn("days", F.lit(days)), [day, "days"], wanted)
        told = part if told is None else told.unionByName(part)
    return told


#: Days before that a figure is held against, the fewest that will do, and the score that is odd.
SCORE_DAYS, LEAST_DAYS, ODD = 28, 7, 3.5
#: Fixed value: makes the median absolute deviation of normal values comparable to their standard deviation.
NORMAL_MAD = 0.6745
FIGURES = ["n_rows", "n_nulls", "low", "q25", "median", "q75", "high"]


def _median(values: Column) -> Column:
    """Of an array without NULLs: the middle, or the mean of the two middles."""
    def of(a: Column) -> Column:
        n = F.size(a)
        return (F.get(a, F.floor((n - 1) / 2).cast("int")) + F.get(a, F.floor(n / 2).cast("int"))) / 2

    return F.element_at(F.transform(F.array(F.array_sort(values)), of), 1)


def anomalies(stats: DataFrame, day: str, key: str, figures: Sequence[str], days: int = SCORE_DAYS, least: int = LEAST_DAYS, odd: float = ODD) -> DataFrame:
    """(day, key, figure, value, center, spread, score, outlier), a row for each figure of each day.

    ``center`` and ``spread`` are the median and the median absolute deviation of the figure
    on the ``days`` days before that have one; neither is moved by a few outliers among
    those. ``score`` is how many deviations the value is off; more than ``odd`` of them
    make an outlier. Where the days before don't differ there is no score, and any other value
    is an outlier. With fewer than ``least`` days before, or no value, nothing is told. A
    window holds as many rows as there are days, and ``days`` values at a time.
    """
    each = F.explode(F.array(*[F.struct(F.lit(f).alias("figure"), F.col(f).cast("double").alias("value")) for f in figures]))
    rows = stats.select(day, key, each.alias("_f")).select(day, key, "_f.figure", "_f.value")
    before = Window.partitionBy(key, "figure").orderBy(day).rowsBetween(-days, -1)
    seen = rows.withColumn("_before", F.collect_list("value").over(before))
    enough = F.size("_before") >= least
    centered = seen.withColumn("center", F.when(enough, _median(F.col("_before"))))
    apart = F.transform("_before", lambda x: F.abs(x - F.col("center")))
    spread = centered.withColumn("spread", F.when(enough, _median(apart)))
    score = F.when(F.col("spread") > 0, F.lit(NORMAL_MAD) * (F.col("value") - F.col("center")) / F.col("spread"))
    off = F.when(F.col("spread") > 0, F.abs(score) > odd).otherwise(F.col("value") != F.col("center"))
    return spread.select(day, key, "figure", "value", "center", "spread", score.alias("score"), F.coalesce(off, F.lit(False)).alias("outlier"))
