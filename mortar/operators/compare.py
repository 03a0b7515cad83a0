"""Table comparison: set-level and column-level audits of two relations.

``compare_relations`` reports how many distinct rows are in both, only in
a, only in b (with INTERSECT / EXCEPT semantics, NULLs equal) from one
aggregation over the tagged union, instead of three set operations.
``compare_all_columns`` counts, per column, rows of a key that match, are
NULL in both, differ, or exist on one side only.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import round_ratio
from ..sources.sinks import materialize


def compare_relations(a: DataFrame, b: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """(in_a, in_b, count, percent_of_total) over distinct rows."""
    cols = [c for c in a.columns if c not in exclude]
    tagged = a.select(*cols, F.lit(True).alias("_a"), F.lit(False).alias("_b")).unionByName(
        b.select(*cols, F.lit(False).alias("_a"), F.lit(True).alias("_b"))
    )
    rows = tagged.groupBy(*cols).agg(F.max("_a").alias("in_a"), F.max("_b").alias("in_b"))
    stats = rows.groupBy("in_a", "in_b").agg(F.count(F.lit(1)).alias("count"))
    # At most three rows: a window over all of them is trivial.
    total = F.sum("count").over(Window.partitionBy())
    return stats.select(
        "in_a", "in_b", "count", round_ratio(F.col("count") * 100, total, 2).alias("percent_of_total")
    )


_KINDS = ["perfect_match", "null_in_both", "conflicting", "missing_from_a", "missing_from_b"]


def _joined_counts(a: DataFrame, b: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """The counts of ``compare_all_columns`` in one row, from a join."""
    la = a.select(*keys, *[F.col(c).alias(f"_a_{c}") for c in cols], F.lit(True).alias("_in_a"))
    lb = b.select(*keys, *[F.col(c).alias(f"_b_{c}") for c in cols], F.lit(True).alias("_in_b"))
    j = la.join(lb, keys, "full_outer")
    both = F.col("_in_a").isNotNull() & F.col("_in_b").isNotNull()
    missing = {"missing_from_a": F.count_if(F.col("_in_a").isNull()), "missing_from_b": F.count_if(F.col("_in_b").isNull())}
    return _wide(j.withColumn("_odd", F.lit(False)), cols, both, missing)


def _wide(rows: DataFrame, cols: Sequence[str], both: Column, missing: dict[str, Column]) -> DataFrame:
    aggs = []
    for c in cols:
        x, y = F.col(f"_a_{c}"), F.col(f"_b_{c}")
        told = {
            "perfect_match": F.count_if(both & x.isNotNull() & (x == y)),
            "null_in_both": F.count_if(both & x.isNull() & y.isNull()),
            "conflicting": F.count_if(both & ~x.eqNullSafe(y)),
            **missing,
        }
        aggs += [told[k].alias(f"{c}|{k}") for k in _KINDS]
    return rows.agg(*aggs, F.count_if("_odd").alias("_odd"))


def compare_all_columns(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per column: perfect_match, null_in_both, conflicting, missing_from_a, missing_from_b.

    As a full outer join on the keys has them: NULL keys match nothing, repeated ones every
    row of the other side. The rows of both tables are put side by side by one aggregation on the
    keys, which needs no exchange where both lie dealt by some of the keys. Only keys that one
    side repeats and both have are joined, in a second pass, if there are any.
    """
    keys = list(keys)
    cols = [c for c in a.columns if c not in keys]
    sides = [
        df.select(*keys, *[(F.col(c) if side == own else F.lit(None).cast(df.schema[c].dataType)).alias(f"_{own}_{c}") for own in "ab" for c in cols],
                  F.lit(int(side == "a")).alias("_na"), F.lit(int(side == "b")).alias("_nb"))
        for side, df in (("a", a), ("b", b))
    ]
    by_key = sides[0].unionByName(sides[1]).groupBy(*keys).agg(
        F.sum("_na").alias("_na"), F.sum("_nb").alias("_nb"), *[F.max(f"_{own}_{c}").alias(f"_{own}_{c}") for own in "ab" for c in cols]
    )
    na, nb = F.col("_na"), F.col("_nb")
    there = reduce(lambda x, y: x & y, [F.col(k).isNotNull() for k in keys])
    met = there & (na > 0) & (nb > 0)
    odd = met & ((na > 1) | (nb > 1))
    total = lambda n: F.coalesce(F.sum(F.when(~met, n)), F.lit(0))
    wide = materialize(_wide(by_key.withColumn("_odd", odd), cols, met & ~odd, {"missing_from_a": total(nb), "missing_from_b": total(na)}), "compared")
    if wide.first()["_odd"]:
        repeated = materialize(by_key.where(odd).select(*keys), "repeated-keys")
        some = _joined_counts(*(df.join(repeated, keys, "left_semi") for df in (a, b)), keys, cols)
        wide = wide.unionByName(some).agg(*[F.sum(F.col(f"`{n}`")).alias(n) for n in wide.columns])
    rows = F.explode(
        F.array(
            *[
                F.struct(F.lit(c).alias("column_name"), *[F.col(f"`{c}|{k}`").cast("long").alias(k) for k in _KINDS])
                for c in cols
            ]
        )
    )
    return wide.select(rows.alias("r")).select("r.*")
