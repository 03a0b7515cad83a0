"""Data-quality checks, as distributed DataFrames of violations.

Each ``check_*`` returns the violating rows (never collected); ``run_checks``
runs a model's declared tests and returns one summary row per test
(``test``, ``column_name``, ``failures``), computed with aggregations and
anti joins on the cluster. Column-level tests that only need a count
(not_null, accepted_values, expression) share one pass over the table.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.sinks import materialize


#: Values that one task counts where they are dealt by their hash.
TASK_VALUES = 2_000_000


def check_unique(df: DataFrame, column: str, by_hash: bool = False) -> DataFrame:
    """Values occurring more than once (NULLs ignored): (value, n_records).

    ``by_hash`` is for long values that hardly repeat: 64-bit hashes are shuffled in
    their place, over tasks that grow with the rows, and only values whose hash
    comes twice are compared themselves. It reads ``df`` three times.
    """
    df = df.where(F.col(column).isNotNull())
    if by_hash:
        hashes = df.select(F.xxhash64(column).alias("_h")).repartition(max(1, math.ceil(df.count() / TASK_VALUES)), "_h")
        twice = materialize(hashes.groupBy("_h").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1).select("_h"), "hashes-twice")
        df = df.join(twice, F.xxhash64(column) == F.col("_h"), "left_semi")
    return (
        df.groupBy(F.col(column).alias("unique_field"))
        .agg(F.count(F.lit(1)).alias("n_records"))
        .where(F.col("n_records") > 1)
    )


def check_not_null(df: DataFrame, column: str) -> DataFrame:
    """Rows where the column is NULL."""
    return df.where(F.col(column).isNull())


def check_accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Values outside the list, with their counts (NULL is not a violation)."""
    return (
        df.where(~F.col(column).isin(list(values)))
        .groupBy(F.col(column).alias("value_field"))
        .agg(F.count(F.lit(1)).alias("n_records"))
    )


@dataclass
class Tests:
    """Declared tests of one model."""

    not_null: list[str] = field(default_factory=list)
    unique: list[str] = field(default_factory=list)
    unique_by_hash: list[str] = field(default_factory=list)  # see check_unique
    accepted: dict[str, list] = field(default_factory=dict)
    expressions: dict[str, tuple[str, Column]] = field(default_factory=dict)  # name -> (column, condition)
    relationships: dict[str, tuple[DataFrame, str]] = field(default_factory=dict)  # column -> (parent, field)


def run_checks(df: DataFrame, tests: Tests) -> DataFrame:
    """One summary row per declared test: (test, column_name, failures).

    ``failures`` is the number of rows the test's query returns: violating
    rows for not_null, expressions and relationships, distinct offending
    values for unique and accepted_values.
    """
    counted = []
    for c in tests.not_null:
        counted.append(("not_null", c, F.col(c).isNull()))
    for name, (c, cond) in tests.expressions.items():
        counted.append((name, c, ~cond))
    parts = []
    if counted:
        one_pass = df.agg(
            *[F.count_if(F.coalesce(bad, F.lit(False))).alias(f"_t{i}") for i, (_, _, bad) in enumerate(counted)]
        )
        stack = F.explode(
            F.array(
                *[
                    F.struct(F.lit(t).alias("test"), F.lit(c).alias("column_name"), F.col(f"_t{i}").alias("failures"))
                    for i, (t, c, _) in enumerate(counted)
                ]
            )
        )
        parts.append(one_pass.select(stack.alias("r")).select("r.*"))
    grouped = [("unique", c, check_unique(df, c)) for c in tests.unique]
    grouped += [("unique", c, check_unique(df, c, by_hash=True)) for c in tests.unique_by_hash]
    grouped += [("accepted_values", c, check_accepted_values(df, c, v)) for c, v in tests.accepted.items()]
    for t, c, v in grouped:
        parts.append(
            v.agg(F.count(F.lit(1)).alias("failures")).select(
                F.lit(t).alias("test"), F.lit(c).alias("column_name"), "failures"
            )
        )
    for c, (parent, fld) in tests.relationships.items():
        # Child keys are counted first (partial aggregation), so a hot key
        # reaches the anti join as one row.
        keys = df.where(F.col(c).isNotNull()).groupBy(F.col(c).alias("from_field")).agg(
            F.count(F.lit(1)).alias("_n")
        )
        parents = parent.select(F.col(fld).alias("_mortar_parent")).distinct()
        orphans = keys.join(parents, F.col("from_field") == F.col("_mortar_parent"), "left_anti")
        parts.append(
            orphans.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("failures")).select(
                F.lit("relationships").alias("test"), F.lit(c).alias("column_name"), "failures"
            )
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("test", "column_name", F.col("failures").cast("long").alias("failures"))
