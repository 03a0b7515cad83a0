"""Operator-level tests: scans against plain windows, exact rounding,
similarity against DuckDB, spines against cross joins."""

import datetime as dt
import random
from decimal import ROUND_HALF_UP, Decimal

import duckdb
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from mortar.functions.columns import pct_change, round_half_up, round_ratio, surrogate_key
from mortar.functions.similarity import jaro_winkler, similarity_score
from mortar.operators.rank import global_row_number, latest_per_key, prefix_scan
from mortar.operators.shape import pivot_count_distinct
from mortar.operators.temporal import date_spine, entity_days


def _skewed(spark, n=4000):
    rnd = random.Random(7)
    rows = []
    for i in range(n):
        k = "hot" if rnd.random() < 0.6 else (None if rnd.random() < 0.05 else f"k{rnd.randint(0, 30)}")
        v = None if rnd.random() < 0.1 else rnd.randint(-50, 50)
        rows.append((k, i, v))
    return spark.createDataFrame(rows, "k string, o long, v long")


def test_prefix_scan_matches_window_on_hot_key(spark):
    df = _skewed(spark)
    got = prefix_scan(df, ["k"], ["o"], sums={"cum": "v"}, row_number="rn", parts=16)
    w = Window.partitionBy("k").orderBy("o")
    want = df.select(
        "k", "o", "v",
        F.row_number().over(w).cast("long").alias("rn"),
        F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("cum"),
    )
    assert got.select(*want.columns).exceptAll(want).count() == 0
    assert want.exceptAll(got.select(*want.columns)).count() == 0
    # the hot key really spans several slices
    hot = df.where("k = 'hot'").repartitionByRange(16, "k", "o").select(F.spark_partition_id().alias("p")).distinct()
    assert hot.count() > 1


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(-5, 5)), min_size=1, max_size=60))
def test_prefix_scan_property(spark, rows):
    data = [(k, i, v) for i, (k, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "k int, o long, v long")
    got = {r["o"]: (r["rn"], r["cum"]) for r in prefix_scan(df, ["k"], ["o"], {"cum": "v"}, "rn", parts=5).collect()}
    seen, acc = {}, {}
    for k, o, v in data:
        seen[k] = seen.get(k, 0) + 1
        acc[k] = acc.get(k, 0) + v
        assert got[o] == (seen[k], acc[k])


def test_global_row_number(spark):
    df = _skewed(spark).select("o").orderBy(F.rand(3))
    got = global_row_number(df, ["o"], out="rn", parts=7)
    assert got.where(F.col("rn") != F.col("o") + 1).count() == 0
    assert got.count() == 4000


def test_latest_per_key(spark):
    df = spark.createDataFrame(
        [("a", dt.date(2024, 1, 1), 1), ("a", dt.date(2024, 1, 3), 2), ("b", dt.date(2024, 1, 2), 3)],
        "k string, d date, x int",
    )
    got = {r["k"]: (r["d"], r["x"]) for r in latest_per_key(df, ["k"], ["d"]).collect()}
    assert got == {"a": (dt.date(2024, 1, 3), 2), "b": (dt.date(2024, 1, 2), 3)}


def _half_up(num, den, digits):
    return float((Decimal(num) / Decimal(den)).quantize(Decimal(1).scaleb(-digits), rounding=ROUND_HALF_UP))


def test_round_ratio_exact(spark):
    rnd = random.Random(1)
    pairs = [(1, 8), (-1, 8), (5, 1000), (-5, 1000), (1005, 100000), (3, 0), (0, 7), (2, 3), (-2, 3)]
    pairs += [(rnd.randint(-10**6, 10**6), rnd.randint(1, 10**4)) for _ in range(300)]
    df = spark.createDataFrame(pairs, "n long, d long")
    rows = df.select("n", "d", round_ratio("n", "d", 2).alias("r")).collect()
    for r in rows:
        if r["d"] == 0:
            assert r["r"] is None
        else:
            assert r["r"] == _half_up(r["n"], r["d"], 2), (r["n"], r["d"], r["r"])


def test_round_half_up_and_pct_change(spark):
    df = spark.createDataFrame([(1.005, 4, 0), (2.675, 3, 4), (-1.005, None, 2)], "x double, cur long, prev long")
    got = df.select(round_half_up("x", 2).alias("r"), pct_change("cur", "prev").alias("p")).collect()
    assert [g["r"] for g in got] == [1.01, 2.68, -1.01]
    assert [g["p"] for g in got] == [None, -25.0, -100.0]


def test_surrogate_key_matches_md5(spark):
    import hashlib

    df = spark.createDataFrame([("c1", dt.date(2024, 1, 2)), (None, dt.date(2024, 1, 2))], "c string, d date")
    got = [r[0] for r in df.select(surrogate_key("c", "d")).collect()]
    want = [hashlib.md5(b"c1-2024-01-02").hexdigest(), hashlib.md5(b"_dbt_utils_surrogate_key_null_-2024-01-02").hexdigest()]
    assert got == want


def _scored(spark, pairs):
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a string, b string").repartition(8)
    got = df.select("i", jaro_winkler(F.col("a"), F.col("b")).alias("jw"), similarity_score(F.col("a"), F.col("b")).alias("s")).collect()
    return [(r["jw"], r["s"]) for r in sorted(got, key=lambda r: r["i"])]


def test_jaro_winkler_matches_duckdb_on_ascii(spark):
    con = duckdb.connect()
    rnd = random.Random(5)
    pairs = []
    for _ in range(1500):
        alpha = rnd.choice(["abcde 13#", "ab", "brand pizza", "xyz"])
        pairs.append(tuple("".join(rnd.choice(alpha) for _ in range(rnd.randint(0, 18))) for _ in range(2)))
    for (a, b), (jw, _) in zip(pairs, _scored(spark, pairs)):
        d = con.execute("select jaro_winkler_similarity(?, ?)", [a, b]).fetchone()[0]
        assert abs(jw - d) < 1e-12, (a, b)
    assert [s for _, s in _scored(spark, [(None, "x"), ("x", None), ("brand13", "brand13"), ("", "x")])] == [None, None, 100, 0]


def test_jaro_winkler_is_character_based(spark):
    # Characters, not bytes: 4 of 6 characters match in 'święta' / 'swieta'.
    assert round(_scored(spark, [("święta", "swieta")])[0][0], 3) == 0.778


def test_entity_days_matches_cross_join(spark):
    ents = spark.createDataFrame(
        [("a", dt.date(2024, 12, 1)), ("a", dt.date(2024, 12, 20)), ("b", dt.date(2025, 1, 1)), ("c", dt.date(2022, 1, 1))],
        "k string, since date",
    )
    got = entity_days(ents, "k", "since", "2024-12-01", "2025-01-01")
    spine = date_spine(spark, "2024-12-01", "2025-01-01")
    want = ents.crossJoin(spine).where(F.col("date_day") >= F.col("since")).select("k", F.col("date_day").alias("date")).distinct()
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert spine.count() == 31  # end exclusive


def test_pivot_count_distinct_counts_absent_as_zero(spark):
    df = spark.createDataFrame([(1, "a", 10), (1, "a", 10), (1, "b", 11), (2, "b", None)], "k int, s string, id int")
    got = {r["k"]: (r["a_n"], r["b_n"], r["c_n"]) for r in pivot_count_distinct(df, ["k"], "s", ["a", "b", "c"], "id", "_n").collect()}
    assert got == {1: (1, 1, 0), 2: (0, 0, 0)}
