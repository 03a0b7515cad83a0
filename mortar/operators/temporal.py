"""Daily-grain operators: date spines, entity x day grids, and interval joins
rewritten as running sums of deltas.

The reference joins each (entity, day) row to every interval that covers
the day (``day between start and end``) or to every earlier item
(``created <= day``). Such range joins produce rows proportional to
intervals x days and, with a hot entity, pile them onto one task. Here each
interval becomes two delta events (+ at its first day, - after its last),
events are summed per (entity, day) with partial aggregation, and the daily
state is a running sum over the entity's days. A day grid row per entity and
day is at most the spine length, so the per-entity window is bounded
whatever the skew in the event tables.
"""

from __future__ import annotations

import datetime as _dt
import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

IN_GRID = "_mortar_in_grid"

#: Rows of input that a task takes up where rows are dealt by entity; fewer, if there are cores to spare.
TASK_ROWS, LEAST_ROWS = 50_000, 20_000


def parts_for(*tables: DataFrame | None) -> int:
    """Tasks over which the rows of ``tables`` are dealt by entity: their number grows with the rows, which are counted.

    The session's number of shuffle partitions doesn't know the input, and AQE joins partitions
    by their compressed bytes, of which rows of many zeros have few: either way
    what a task holds would grow.
    """
    given = [t.select(F.lit(1).alias("_one")) for t in tables if t is not None]
    rows = reduce(DataFrame.unionAll, given).count()
    cores = given[0].sparkSession.sparkContext.defaultParallelism
    return max(1, math.ceil(rows / TASK_ROWS), min(cores, math.ceil(rows / LEAST_ROWS)))


#: Classes that entities fall into by a hash, and how many of the fullest are told apart at most.
CLASSES, MOST_CROWDED = 1 << 16, 1_000


def _class(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(CLASSES)).cast("int")


def crowded_classes(key: str, *tables: DataFrame | None) -> list[int]:
    """Classes with more rows of ``tables`` than a task takes up, the fullest ones first if there are very many.

    An entity with so many rows, or with a thousandth of them all, is in one of these. Rows are counted by class,
    so each task shuffles, and the driver gets, a bounded number whatever the input.
    """
    given = [t.where(F.col(key).isNotNull()).select(_class(key).alias("_class")) for t in tables if t is not None]
    counts = reduce(DataFrame.unionAll, given).groupBy("_class").agg(F.count(F.lit(1)).alias("_n"))
    return [r[0] for r in counts.where(F.col("_n") > TASK_ROWS).orderBy(F.desc("_n"), "_class").limit(MOST_CROWDED).collect()]


def counted_by_entity(rows: DataFrame, key: str, by: Sequence[str], counts: Sequence[Column], parts: int, crowded: Sequence[int] = ()) -> DataFrame:
    """Rows of an entity that are alike in ``by`` as one row with ``counts``, dealt by entity over ``parts`` tasks.

    Rows go to their entity's task as they are and are counted there: one shuffle. Those of the ``crowded``
    classes are counted before, each kind by itself, and then dealt, so a task gets a bounded number of
    rows of an entity that has very many.
    """
    counted = lambda df: df.groupBy(key, *by).agg(*counts)
    if not crowded:
        return counted(rows.repartition(parts, key))
    full = _class(key).isin(list(crowded))
    few, many = counted(rows.where(~full).repartition(parts, key)), counted(rows.where(full)).repartition(parts, key)
    return few.unionByName(many)


def _date(d: str | _dt.date) -> Column:
    return F.expr(f"date '{d}'")


def date_spine(spark: SparkSession, start: str, end: str) -> DataFrame:
    """One row per day in [start, end): ``date_day`` (end exclusive)."""
    return spark.range(1).select(
        F.explode(F.sequence(_date(start), F.date_sub(_date(end), 1))).alias("date_day")
    )


def entity_days(entities: DataFrame, key: str, since: str, start: str, end: str, out: str = "date") -> DataFrame:
    """Distinct (key, day) for every spine day on or after the entity's ``since`` date.

    Replaces ``select distinct k, d from entities cross join spine where d >= since``:
    a key repeated with several dates yields the days from its earliest one,
    so deduplicating to ``min(since)`` per key first is exact. NULL keys are
    one entity, as ``distinct`` has it. No cross product is formed; each key
    explodes its own day range.
    """
    first = entities.where(F.col(since).isNotNull()).groupBy(key).agg(F.min(since).alias("_since"))
    lo = F.greatest(F.col("_since").cast("date"), _date(start))
    hi = F.date_sub(_date(end), 1)
    return first.where(lo <= hi).select(key, F.explode(F.sequence(lo, hi)).alias(out))


def clamp_day(day: Column, start: str) -> Column:
    """Events before the spine act on its first day; a NULL day stays NULL (``greatest`` alone skips NULLs)."""
    return F.when(day.isNotNull(), F.greatest(day, _date(start)))


EventSpec = tuple  # (day: Column, condition: Column, values: dict[str, Column])


def interval_specs(
    lo: Column, hi_excl: Column, values: dict[str, Column], start: str, end: str, shift: int = 0
) -> list[EventSpec]:
    """Delta events of an interval [lo, hi_excl) (``hi_excl`` NULL = open).

    ``+values`` at the first covered spine day and ``-values`` at
    ``hi_excl`` when that is still inside the spine; intervals that end
    before the spine, start after it or have a NULL start (no day compares
    as covered) emit nothing. ``shift`` moves both
    events ``shift`` days later: a running sum of shifted events on day d is
    the unshifted state on day d - shift (a lag by days).
    """
    last = F.date_sub(_date(end), 1)
    a = clamp_day(lo, start)
    valid = (a <= last) & (hi_excl.isNull() | (hi_excl > a))
    plus_day = F.date_add(a, shift)
    minus_day = F.date_add(hi_excl, shift)
    return [
        (plus_day, valid & (plus_day <= last), values),
        (minus_day, valid & hi_excl.isNotNull() & (minus_day <= last), {n: -v for n, v in values.items()}),
    ]


def point_spec(day: Column, values: dict[str, Column], start: str, end: str, cond: Column | None = None) -> EventSpec:
    """An event that starts counting on ``day`` (clamped to the spine) and never stops."""
    last = F.date_sub(_date(end), 1)
    a = clamp_day(day, start)
    ok = a <= last
    return (a, ok if cond is None else (cond & ok), values)


def emit_events(df: DataFrame, key: str | Sequence[str], specs: Sequence[EventSpec], item: str | None = None) -> DataFrame:
    """All events of all specs from one pass over ``df``.

    Rows with a NULL key emit nothing: no entity equals a NULL key in a join. Events carry
    the column ``item``, which may be NULL.
    Each input row yields an array of event structs (one per spec, value
    columns missing from a spec are 0) filtered by the specs' conditions and
    exploded: one scan of the source however many event kinds it feeds.
    """
    keys = [key] if isinstance(key, str) else list(key)
    names: list[str] = []
    for _, _, values in specs:
        names += [n for n in values if n not in names]
    zero = F.lit(0).cast("long")
    no = F.lit(False)
    structs = []
    for day, cond, values in specs:
        fields = [day.alias("day"), F.coalesce(cond, no).alias("_ok")]
        fields += [(values[n].cast("long") if n in values else zero).alias(n) for n in names]
        structs.append(F.struct(*fields))
    kept = F.filter(F.array(*structs), lambda e: e["_ok"])
    for k in keys:
        df = df.where(F.col(k).isNotNull())
    keys += [item] if item else []
    rows = df.select(*[F.col(k) for k in keys], F.explode(kept).alias("_e"))
    return rows.select(*keys, F.col("_e.day").alias("day"), *[F.col(f"_e.{n}").alias(n) for n in names])


def interval_events(
    df: DataFrame,
    key: str | Sequence[str],
    lo: Column,
    hi_excl: Column,
    values: dict[str, Column],
    start: str,
    end: str,
    shift: int = 0,
) -> DataFrame:
    """Delta events of intervals (see ``interval_specs``), one row per event."""
    return emit_events(df, key, interval_specs(lo, hi_excl, values, start, end, shift))


def _transitions(df: DataFrame, key: str, item: str, spans: dict[str, tuple[Column, Column]], start: str, end: str) -> DataFrame:
    """(key, item, day, a column for each of ``spans``): 1 where the item's coverage by that span's intervals starts, -1 where it ends."""
    specs = [spec for out, (lo, hi) in spans.items() for spec in interval_specs(lo, hi, {out: F.lit(1)}, start, end)]
    per_item = emit_events(df.where(F.col(item).isNotNull()), [key, item], specs)
    agg = per_item.groupBy(key, item, "day").agg(*[F.sum(out).alias(out) for out in spans])
    w = Window.partitionBy(key, item).orderBy("day")
    up_to = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    active = agg.select(key, item, "day", *[(F.sum(out).over(up_to) > 0).cast("int").alias(out) for out in spans])
    changes = active.select(key, item, "day", *[(F.col(out) - F.coalesce(F.lag(out, 1).over(w), F.lit(0))).alias(out) for out in spans])
    return changes.where(reduce(lambda x, y: x | y, [F.col(out) != 0 for out in spans]))


def distinct_active_counts(df: DataFrame, key: str, item: str, spans: dict[str, tuple[Column, Column]], start: str, end: str) -> DataFrame:
    """Delta events of several counts of distinct items, each over intervals of its own (name -> (lo, hi_excl)).

    As ``distinct_active_events`` for each of them, in one pass over the items.
    """
    return _transitions(df, key, item, spans, start, end).select(key, "day", *spans)


def distinct_active_events(
    df: DataFrame,
    key: str,
    item: str,
    lo: Column,
    hi_excl: Column,
    start: str,
    end: str,
    out: str,
    lags: dict[str, int] | None = None,
    item_out: str | None = None,
) -> DataFrame:
    """Delta events of ``count(distinct item)`` over covering intervals.

    Overlapping intervals of the same (key, item) must count once, so the
    coverage count per (key, item) is run first and only its 0 -> >0 and
    >0 -> 0 transitions become +1 / -1 events. The per-(key, item) window
    runs over aggregated event days (at most spine length + 1 rows), so a hot
    key or item does not concentrate raw rows in one task. ``lags`` adds
    columns of the same events shifted by n days (name -> n). ``item_out``
    keeps the item column (per-item transitions, not summed per key).
    """
    last = F.date_sub(_date(end), 1)
    trans = _transitions(df, key, item, {"_d": (lo, hi_excl)}, start, end)
    if item_out:
        return trans.select(key, F.col(item).alias(item_out), "day", F.col("_d").alias(out))
    lags = lags or {}
    names = [out, *lags]
    zero = F.lit(0)
    # One output row per (transition, shift), from a single pass.
    variants = [F.struct(F.col("day").alias("day"), *[(F.col("_d") if m == out else zero).alias(m) for m in names])]
    for name, n in lags.items():
        variants.append(
            F.struct(F.date_add("day", n).alias("day"), *[(F.col("_d") if m == name else zero).alias(m) for m in names])
        )
    rows = trans.select(key, F.explode(F.array(*variants)).alias("_v"))
    return rows.select(key, "_v.*").where(F.col("day") <= last)


def sums_and_distinct_events(
    df: DataFrame, key: str, item: str, lo: Column, hi_excl: Column, values: dict[str, Column], start: str, end: str, out: str, lag: int
) -> DataFrame:
    """Delta events of sums of ``values`` and, as ``out``, of ``count(distinct item)`` over the same intervals.

    As ``interval_events`` and ``distinct_active_events``, from one pass over ``df``: its rows are shuffled
    once. The same events follow ``lag`` days later, in columns named ``*_lag``.
    """
    has_item = F.col(item).isNotNull().cast("int")
    per_item = emit_events(df, key, interval_specs(lo, hi_excl, {**values, "_cover": has_item}, start, end), item)
    daily = per_item.groupBy(key, item, "day").agg(*[F.sum(c).alias(c) for c in (*values, "_cover")])
    w = Window.partitionBy(key, item).orderBy("day")
    covered = F.sum("_cover").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)) > 0
    active = daily.select(key, item, "day", *values, covered.cast("int").alias("_active"))
    change = F.col("_active") - F.coalesce(F.lag("_active", 1).over(w), F.lit(0))
    events = active.select(key, "day", *values, change.cast("long").alias(out))
    names, zero = [*values, out], F.lit(0).cast("long")
    now = [F.col(c).alias(c) for c in names] + [zero.alias(f"{c}_lag") for c in names]
    later = [zero.alias(c) for c in names] + [F.col(c).alias(f"{c}_lag") for c in names]
    both = F.array(F.struct(F.col("day").alias("day"), *now), F.struct(F.date_add("day", lag).alias("day"), *later))
    return events.select(key, F.explode(both).alias("_v")).select(key, "_v.*").where(F.col("day") <= F.date_sub(_date(end), 1))


def entity_first_days(entities: DataFrame, key: str, since: str, start: str, end: str) -> DataFrame:
    """(key, first_day): the first spine day of each entity's grid (see ``entity_days``)."""
    first = entities.where(F.col(since).isNotNull()).groupBy(key).agg(F.min(since).alias("_since"))
    lo = F.greatest(F.col("_since").cast("date"), _date(start))
    return first.select(key, lo.alias("first_day")).where(F.col("first_day") <= F.date_sub(_date(end), 1))


def running_segments(
    firsts: DataFrame,
    key: str,
    events: Sequence[DataFrame],
    running: Sequence[str],
    point: Sequence[str] = (),
    end: str = "",
) -> DataFrame:
    """Sparse daily state: one row per (key, event day) covering dense days
    ``[_lo, _hi]`` over which the running columns are constant.

    ``firsts`` holds (key, first_day); every key's grid runs from its first
    day to the last spine day. ``running`` columns are summed over all events
    up to and including the row's day (events before the first day
    included); ``point`` columns are the day's own sums and apply to ``day``
    only. Events are aggregated per (key, event day) first, and the running
    sums are windowed over these sparse rows only (at most spine-length rows
    per key). Where ``firsts`` and all events come from rows dealt by
    ``repartition(n, key)`` with the same n, neither needs a shuffle.
    """
    last = F.date_sub(_date(end), 1)
    cols = [*running, *point]
    markers = firsts.select(F.col(key), F.col("first_day").alias("day"), F.lit(1).alias(IN_GRID))
    union = markers
    for e in events:
        union = union.unionByName(e.select(key, "day", *[c for c in cols if c in e.columns]), allowMissingColumns=True)
    # Many generated columns: written as SQL text, one JVM call each.
    daily = union.groupBy(key, "day").agg(
        F.expr(f"max({IN_GRID}) as {IN_GRID}"), *[F.expr(f"sum({c}) as {c}") for c in cols]
    )
    w = f"partition by {key} order by day"
    sparse = daily.selectExpr(
        key,
        "day",
        f"max(case when {IN_GRID} = 1 then day end) over ({w} rows between unbounded preceding and unbounded following)"
        " as first_day",
        f"lead(day) over ({w}) as _next",
        *[f"coalesce(sum({c}) over ({w} rows between unbounded preceding and current row), 0) as {c}" for c in running],
        *point,
    )
    lo = F.greatest(F.col("day"), F.col("first_day"))
    hi = F.least(F.coalesce(F.date_sub(F.col("_next"), 1), last), last)
    return (
        sparse.where(F.col("first_day").isNotNull())
        .withColumn("_lo", lo)
        .withColumn("_hi", hi)
        .where(F.col("_lo") <= F.col("_hi"))
        .drop("_next")
    )


def split_segments(seg: DataFrame, boundary: Column) -> DataFrame:
    """Cut each segment at its point day and at ``boundary`` (a date column).

    Output rows carry ``_pt`` (the piece is the row's own event day, where
    point columns apply) and ``_after`` (the piece lies on or after
    ``boundary``). At most four pieces per input row.
    """
    lo, hi = F.col("_lo"), F.col("_hi")
    is_pt = lo == F.col("day")
    b = boundary
    pt_hi = F.when(is_pt, lo).otherwise(F.date_sub(lo, 1))
    rest_lo = F.when(is_pt, F.date_add(lo, 1)).otherwise(lo)

    def piece(a, z, pt):
        return [
            F.struct(a.alias("a"), F.least(z, F.date_sub(b, 1)).alias("b"), F.lit(pt).alias("pt"), F.lit(False).alias("after")),
            F.struct(F.greatest(a, b).alias("a"), z.alias("b"), F.lit(pt).alias("pt"), F.lit(True).alias("after")),
        ]

    pieces = F.filter(F.array(*piece(lo, pt_hi, True), *piece(rest_lo, hi, False)), lambda x: x["a"] <= x["b"])
    out = seg.select("*", F.explode(pieces).alias("_piece"))
    return out.select(
        *[c for c in seg.columns if c not in ("_lo", "_hi")],
        F.col("_piece.a").alias("_lo"),
        F.col("_piece.b").alias("_hi"),
        F.col("_piece.pt").alias("_pt"),
        F.col("_piece.after").alias("_after"),
    )


def explode_segments(seg: DataFrame, date: str = "date") -> DataFrame:
    """Dense rows: each segment repeated for every day of ``[_lo, _hi]``."""
    return seg.select("*", F.explode(F.sequence("_lo", "_hi")).alias(date)).drop("_lo", "_hi")
