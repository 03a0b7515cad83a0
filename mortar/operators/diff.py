"""Row-level difference of two large tables by hash trees.

The rows of a table are dealt into leaves by ranges of their key's hash, and each leaf keeps
how many rows it has and two order-blind sums of row hashes; sixteen leaves make a node, and so on
up to a root. Trees are small tables that can be stored with the data. Two trees are compared
from the root down, looking only below nodes that differ; rows are then read of leaves that
differ and nothing else is compared row by row. Repeated keys and repeated rows count as often as they
occur, as in ``EXCEPT ALL``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.sinks import materialize

#: Children of a node, in bits; and the rows that a leaf has on average.
FANOUT, LEAF_ROWS = 4, 4096
#: Bits of the deepest leaf number.
MOST_BITS = 48
_DIGEST = ["n", "h1", "h2"]


def depth_for(rows: int, leaf_rows: int = LEAF_ROWS) -> int:
    """Levels below the root at which leaves have about ``leaf_rows`` rows."""
    return min(MOST_BITS // FANOUT, max(0, math.ceil(math.log2(max(1, rows / leaf_rows)) / FANOUT)))


def _row_hash(columns: Sequence[str], seed: int) -> Column:
    """Of all columns, and of which are NULL, as NULL alone leaves a hash as it was."""
    parts = [p for c in columns for p in (F.col(c), F.col(c).isNull())]
    return F.xxhash64(F.lit(seed), *parts).cast("decimal(28,0)")


def leaf_of(keys: Sequence[str], depth: int) -> Column:
    bits = FANOUT * depth
    return F.call_function("shiftrightunsigned", F.xxhash64(*keys), F.lit(64 - bits)) if bits else F.lit(0).cast("long")


def hash_tree(df: DataFrame, keys: Sequence[str], depth: int) -> DataFrame:
    """(level, node, n, h1, h2), level 0 the root; written to the shared folder.

    Rows are summed by leaf before any shuffle, so a hot key is one row a task. Keys that
    are NULL have a leaf like others. Two tables can be compared by trees of the same depth
    and the same columns.
    """
    columns = sorted(df.columns)
    sums = lambda n, h1, h2: (F.sum(n).cast("long").alias("n"), F.sum(h1).cast("decimal(38,0)").alias("h1"), F.sum(h2).cast("decimal(38,0)").alias("h2"))
    rows = df.select(leaf_of(keys, depth).alias("node"), F.lit(1).alias("n"), _row_hash(columns, 1).alias("h1"), _row_hash(columns, 2).alias("h2"))
    level = materialize(rows.groupBy("node").agg(*sums("n", "h1", "h2")), f"tree-{depth}")
    tree = level.withColumn("level", F.lit(depth))
    for d in reversed(range(depth)):
        level = level.groupBy(F.call_function("shiftright", F.col("node"), F.lit(FANOUT)).alias("node")).agg(*sums("n", "h1", "h2"))
        tree = tree.unionByName(level.withColumn("level", F.lit(d)))
    return materialize(tree, "tree", partition_by=["level"])


def differing_leaves(a: DataFrame, b: DataFrame, depth: int) -> DataFrame | None:
    """(node) of the leaves in which two trees differ; None if their roots don't.

    One join a level, of the children of nodes that differ; the others are not looked at.
    """
    below = None
    for level in range(depth + 1):
        x, y = (t.where(F.col("level") == level).select("node", F.struct(*_DIGEST).alias(s)) for t, s in ((a, "_a"), (b, "_b")))
        if below is not None:
            parent = F.call_function("shiftright", F.col("node"), F.lit(FANOUT))
            x, y = (t.withColumn("_p", parent).join(below.withColumnRenamed("node", "_p"), "_p", "left_semi").drop("_p") for t in (x, y))
        off = x.join(y, "node", "full_outer").where(~F.col("_a").eqNullSafe(F.col("_b"))).select("node")
        below = materialize(off, f"off-{level}")
        if below.isEmpty():
            return None
    return below


def diff_tables(a: DataFrame, b: DataFrame, keys: Sequence[str], leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """The rows that one table has more often than the other: (columns of ``a``, side, copies).

    ``side`` is 'a' or 'b' and ``copies`` how many more it has, so with copies written out the
    result is ``a EXCEPT ALL b`` and ``b EXCEPT ALL a``; equal tables give no rows. Both must
    have the same columns (maps can't be compared); NULLs are equal. Each table is read
    once for its tree and once more in the leaves that differ; give tables that are stored.
    """
    keys, names = list(keys), a.columns
    if sorted(names) != sorted(b.columns):
        raise ValueError("the tables have different columns")
    depth = depth_for(max(a.count(), b.count()), leaf_rows)
    leaves = differing_leaves(hash_tree(a, keys, depth), hash_tree(b, keys, depth), depth)

    def suspects(df: DataFrame, sign: int) -> DataFrame:
        rows = df.select(*names, F.lit(sign).alias("_sign"), leaf_of(keys, depth).alias("_leaf"))
        if leaves is None:
            return rows.where(F.lit(False)).drop("_leaf")
        return rows.join(leaves.withColumnRenamed("node", "_leaf"), "_leaf", "left_semi").drop("_leaf")

    both = suspects(a, 1).unionByName(suspects(b, -1))
    more = both.groupBy(*names).agg(F.sum("_sign").alias("_more")).where(F.col("_more") != 0)
    return more.select(*names, F.when(F.col("_more") > 0, "a").otherwise("b").alias("side"), F.abs("_more").alias("copies"))
