"""Reshaping aggregates: conditional pivots (long -> wide) and detail + total
unions.

Spark's ``groupBy().pivot()`` fills absent cells with NULL where the reference
expects 0 for counts, and needs its value list anyway; these operators build
the conditional aggregates explicitly.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pivot_count_distinct(
    df: DataFrame, keys: Sequence[str], column: str, values: Sequence[str], counted: str, suffix: str = ""
) -> DataFrame:
    """``count(distinct case when column = v then counted end)`` per value.

    Spark plans several distinct aggregates with an Expand that copies every
    row once per value. Deduplicating (keys, column, counted) first and
    counting per value afterwards needs no copies, and both steps aggregate
    partially before their shuffle.
    """
    keys = list(keys)
    dedup = df.select(*keys, column, counted).distinct()
    aggs = [
        F.count(F.when((F.col(column) == v) & F.col(counted).isNotNull(), F.lit(1))).alias(f"{v}{suffix}")
        for v in values
    ]
    return dedup.groupBy(*keys).agg(*aggs)
