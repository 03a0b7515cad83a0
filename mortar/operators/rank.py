"""Ordering operators: per-key and global row numbers, running sums, top-1,
per-partition normalization.

``prefix_scan`` is the scalable form of ``row_number() over (partition by k
order by o)`` and ``sum(x) over (... rows unbounded preceding)``. A plain
window sends every row of a key to one task; with a hot key holding a third
of the data that task does a third of the work. Here the rows are
range-partitioned on (keys, order), so a hot key is cut into slices over
several tasks. Each (key, slice) is scanned locally, and the totals of the
key's earlier slices are added. Only a slice that continues a key from an
earlier partition needs such an offset, so the offset table has fewer rows
than there are partitions: a proven bound, hence broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir

_SLICE = "_mortar_slice"


def _once(df: DataFrame) -> DataFrame:
    """Materialize ``df`` in the shared checkpoint folder.

    Slice numbers come from range partitioning, whose bounds are sampled;
    two evaluations of the same plan over shuffled input can sample
    differently. The numbered rows are read by two consumers (the totals and
    the rows themselves), so they are computed once and checkpointed
    (reliably, in ``spark.checkpoint.dir``, which also cuts the lineage).
    """
    checkpoint_dir(df.sparkSession)
    # The write job after the eager count re-reads the range exchange's
    # shuffle files (the map stage is not rerun), so no cache is needed.
    return df.checkpoint(eager=True)


def _partitions(df: DataFrame, parts: int | None) -> int:
    if parts:
        return parts
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def prefix_scan(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    sums: dict[str, str] | None = None,
    row_number: str | None = None,
    parts: int | None = None,
) -> DataFrame:
    """Add running ``row_number`` and running sums per key, in ``order``.

    ``sums`` maps output column -> input column (sum ignores NULLs and is
    NULL until the first non-NULL value, as SQL's running ``sum``). NULL keys
    form one group (window semantics). Ties in ``order`` are broken
    arbitrarily, as in a ROWS frame.
    """
    sums = dict(sums or {})
    keys = list(keys)
    order = list(order)
    n = _partitions(df, parts)
    ranged = df.repartitionByRange(n, *keys, *order).withColumn(_SLICE, F.spark_partition_id())
    slice_keys = [*keys, _SLICE]
    w = Window.partitionBy(*slice_keys).orderBy(*order)
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rn_col = "_mortar_rn"
    local = ranged.withColumn(rn_col, F.row_number().over(w))
    for out, src in sums.items():
        local = local.withColumn(f"_mortar_s_{out}", F.sum(src).over(running))
    local = _once(local)

    # Totals per (key, slice), over the checkpointed rows of the window above.
    totals = local.groupBy(*slice_keys).agg(
        F.max(rn_col).alias("_mortar_n"), *[F.sum(src).alias(f"_mortar_t_{out}") for out, src in sums.items()]
    )
    before = Window.partitionBy(*keys).orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    join_names = [f"_mortar_j{i}" for i in range(len(slice_keys))]
    offsets = totals.select(
        *[F.col(c).alias(j) for c, j in zip(slice_keys, join_names)],
        F.sum("_mortar_n").over(before).alias("_mortar_on"),
        *[F.sum(f"_mortar_t_{out}").over(before).alias(f"_mortar_o_{out}") for out in sums],
    ).where(F.col("_mortar_on").isNotNull())
    # At most (partitions - 1) rows: one per partition boundary a key crosses.
    cond = [F.col(c).eqNullSafe(F.col(j)) for c, j in zip(slice_keys, join_names)]
    joined = local.join(F.broadcast(offsets), on=cond, how="left").drop(*join_names)

    result = joined
    if row_number:
        result = result.withColumn(
            row_number, (F.col(rn_col) + F.coalesce(F.col("_mortar_on"), F.lit(0))).cast("long")
        )
    for out in sums:
        loc, off = F.col(f"_mortar_s_{out}"), F.col(f"_mortar_o_{out}")
        result = result.withColumn(
            out, F.when(loc.isNull() & off.isNull(), None).otherwise(F.coalesce(loc, F.lit(0)) + F.coalesce(off, F.lit(0)))
        )
    drop = [_SLICE, rn_col, "_mortar_on", *[f"_mortar_s_{o}" for o in sums], *[f"_mortar_o_{o}" for o in sums]]
    return result.drop(*drop)


def global_row_number(df: DataFrame, order: Sequence[str | Column], out: str = "row_number", parts: int | None = None) -> DataFrame:
    """``row_number() over (order by ...)`` without a single-partition window.

    Range-partition and sort, number rows inside each partition from the
    monotonically increasing id, then add the row counts of all earlier
    partitions (a table with one row per partition, broadcast). The result
    stays range-partitioned and sorted on ``order``, so a following
    ``orderBy(order)`` needs no further exchange.
    """
    order = list(order)
    n = _partitions(df, parts)
    ranged = (
        df.repartitionByRange(n, *order)
        .sortWithinPartitions(*order)
        .withColumn("_mortar_mid", F.monotonically_increasing_id())
        .withColumn(_SLICE, F.shiftright(F.col("_mortar_mid"), 33).cast("int"))
    )
    ranged = _once(ranged)
    counts = ranged.groupBy(_SLICE).agg(F.count(F.lit(1)).alias("_mortar_cnt"))
    # One row per partition: a single-partition window over it is trivial.
    offsets = counts.select(
        _SLICE,
        F.coalesce(
            F.sum("_mortar_cnt").over(Window.orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("_mortar_off"),
    )
    local_index = F.col("_mortar_mid") - F.shiftleft(F.col(_SLICE).cast("long"), 33)
    return (
        ranged.join(F.broadcast(offsets), on=_SLICE, how="inner")
        .withColumn(out, (F.col("_mortar_off") + local_index + 1).cast("long"))
        .drop(_SLICE, "_mortar_mid", "_mortar_off")
    )


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``qualify row_number() over (partition by keys order by order desc) = 1``.

    Written as a top-1 aggregate: ``max(struct(order..., row))`` per key has
    partial aggregation, so a hot key is reduced map-side before the shuffle.
    Ties on ``order`` resolve to the greatest remaining columns.
    """
    keys = list(keys)
    order = list(order)
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)], *[F.col(c) for c in rest])
    top = df.groupBy(*keys).agg(F.max(packed).alias("_mortar_top"))
    return top.select(
        *keys, *[F.col(f"_mortar_top._o{i}").alias(c) for i, c in enumerate(order)], *[F.col(f"_mortar_top.{c}") for c in rest]
    ).select(*df.columns)


def group_min_max(df: DataFrame, partition: Sequence[str], value: str) -> DataFrame:
    """Per-partition min and max of ``value`` as a small table (partial aggregation)."""
    return df.groupBy(*partition).agg(F.min(value).alias("_mortar_min"), F.max(value).alias("_mortar_max"))
