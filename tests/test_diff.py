"""Difference of tables by hash trees against EXCEPT ALL both ways."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from mortar.operators import diff

SCHEMA = "k long, s string, x double"
row = st.tuples(st.one_of(st.none(), st.integers(0, 6)), st.sampled_from(["a", "b", None, ""]), st.sampled_from([0.0, -0.0, 1.5, None, float("nan")]))


def table(spark, rows, parts=3):
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def written_out(found, side):
    """The rows of one side, as often as they are more."""
    some = found.where(F.col("side") == side)
    return some.select("k", "s", "x", F.explode(F.sequence(F.lit(1), F.col("copies")))).drop("col")


def same(x, y):
    return x.exceptAll(y).count() == 0 and y.exceptAll(x).count() == 0


def check(a, b, leaf_rows=2):
    found = diff.diff_tables(a, b, ["k"], leaf_rows).cache()
    try:
        return same(written_out(found, "a"), a.exceptAll(b)) and same(written_out(found, "b"), b.exceptAll(a))
    finally:
        found.unpersist()


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(row, max_size=60), st.lists(row, max_size=60))
def test_equals_except_all_both_ways(spark, left, right):
    assert check(table(spark, left), table(spark, right + left[: len(left) // 2]))


def rows_of(n):
    rnd = random.Random(1)
    return [(rnd.randint(0, n // 2), rnd.choice("abc"), rnd.random()) for _ in range(n)]


def test_only_leaves_that_differ_are_looked_into(spark):
    rows = rows_of(6000)
    changed = list(rows)
    changed[17] = (changed[17][0], "changed", 0.5)
    changed.append(rows[40])  # one copy more
    del changed[99]
    a, b = table(spark, rows), table(spark, changed)
    depth = diff.depth_for(6000, 8)
    trees = [diff.hash_tree(t, ["k"], depth) for t in (a, b)]
    leaves = diff.differing_leaves(*trees, depth)
    assert 1 <= leaves.count() <= 3 and trees[0].where(F.col("level") == depth).count() > 500
    # each level adds up to the table
    assert {r[1] for r in trees[0].groupBy("level").agg(F.sum("n")).collect()} == {6000}
    assert check(a, b, 8)


def test_equal_tables_stop_at_the_root(spark):
    rows = rows_of(500) + [(None, None, None)] * 3
    a, b = table(spark, rows, 2), table(spark, rows[::-1], 7).select("x", "k", "s")
    depth = diff.depth_for(len(rows), 4)
    assert depth and diff.differing_leaves(diff.hash_tree(a, ["k"], depth), diff.hash_tree(b, ["k"], depth), depth) is None
    assert diff.diff_tables(a, b, ["k"], 4).count() == 0


def test_nulls_tell_columns_apart(spark):
    pair = "k long, s string, t string"
    a, b = spark.createDataFrame([(1, None, "v")], pair), spark.createDataFrame([(1, "v", None)], pair)
    assert sorted(r["side"] for r in diff.diff_tables(a, b, ["k"]).collect()) == ["a", "b"]


def test_a_hot_key_and_repeated_rows(spark):
    rows = [(1, "hot", float(i % 50)) for i in range(2000)] + rows_of(500)
    assert check(table(spark, rows), table(spark, rows[7:] + [(1, "hot", 3.0)] * 5), 16)


def test_empty_tables_and_other_columns(spark):
    none, some = table(spark, []), table(spark, rows_of(5))
    assert check(none, some) and check(some, none) and check(none, none)
    with pytest.raises(ValueError):
        diff.diff_tables(some, some.drop("x"), ["k"])
