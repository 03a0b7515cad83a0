"""Similarity join and dictionary scoring of search terms."""

import random

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from mortar.functions.similarity import similarity_score
from mortar.operators import similar, text
from mortar.plans import search


def strings(seed, n, alphabet="abcdefgh ", longest=14):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, longest))) for _ in range(n)]


def frames(spark, left, right):
    one = lambda values, name: spark.createDataFrame([(v,) for v in values], f"{name} string").repartition(3)
    return one(left, "a"), one(right, "b")


def got(x, y, threshold):
    return {tuple(r) for r in similar.similar_pairs(x, "a", y, "b", threshold).collect()}


@pytest.mark.parametrize("threshold", [0, 40, 70, 85, 99])
def test_every_pair_over_the_threshold(spark, threshold):
    left = strings(1, 250) + ["", None, "aaaa", "a" * 60, "the and", "the and"]
    right = strings(2, 90) + ["", None, "aaa", "a", "a" * 60, "the and"]
    pa, pb = (pd.DataFrame({c: [v for v in vs if v]}) for c, vs in (("a", left), ("b", right)))  # noqa: F841
    want = duckdb.sql(
        f"select distinct a, b, floor(100 * jaro_winkler_similarity(a, b))::int from pa, pb where floor(100 * jaro_winkler_similarity(a, b)) > {threshold}"
    ).fetchall()
    out = [tuple(r) for r in similar.similar_pairs(*frames(spark, left, right)[:1], "a", frames(spark, left, right)[1], "b", threshold).collect()]
    assert len(out) == len(set(out)) and set(out) == set(want)


def test_characters_beyond_ascii(spark):
    x, y = frames(spark, strings(3, 60, "äéß日本𝄞ab ", 9), strings(4, 40, "äéß日本𝄞ab ", 9))
    score = similarity_score(F.col("a"), F.col("b"))
    want = {tuple(r) for r in x.distinct().crossJoin(y.distinct()).select("a", "b", score.alias("s")).where("s > 70").collect()}
    assert got(x, y, 70) == want


def test_candidates_are_few_and_each_is_met_once(spark):
    left, right = strings(5, 400, "abcdefghijklmnopqrstuvwxyz", 20), strings(6, 150, "abcdefghijklmnopqrstuvwxyz", 20)
    x, y = frames(spark, left, right)
    found = {}
    for threshold in (70, 85, 95):
        rows = [tuple(r) for r in similar.candidates(x, "a", y, "b", threshold).collect()]
        assert len(rows) == len(set(rows)) and {(a, b) for a, b, _ in got(x, y, threshold)} <= set(rows)
        found[threshold] = len(rows)
    pairs = len(set(left)) * len(set(right))
    assert found[70] < pairs / 4 and found[85] < pairs / 100 and found[95] <= found[85]


def test_a_hot_key_is_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(similar, "KEY_ROWS", 7)
    left, right = ["brand" + s for s in strings(7, 120, "abc", 6)], ["brand" + s for s in strings(8, 30, "abc", 6)] + ["brand"]
    x, y = frames(spark, left, right)
    small = got(x, y, 80)
    monkeypatch.setattr(similar, "KEY_ROWS", 10**6)
    assert small == got(x, y, 80) and small


def test_empty_sides_and_bad_thresholds(spark):
    x, y = frames(spark, ["abc"], ["abd"])
    none = y.where("b is null")
    assert got(x, none, 70) == set() and got(none.withColumnRenamed("b", "a"), y, 70) == set()
    for threshold in (-1, 100):
        with pytest.raises(ValueError):
            similar.similar_pairs(x, "a", y, "b", threshold)


def searches(spark):
    rnd = random.Random(9)
    rows = [("hot term", "www.hotterm.com", i) for i in range(3000)]
    rows += [(rnd.choice(["brand one", "one", None, "é", ""]), rnd.choice(["www.brandone.com", "www.x.com", None]), i) for i in range(200)]
    rows += [(f"term {i}", "www.term.com", i) for i in range(1500)]
    return spark.createDataFrame(rows, "search_term string, domain string, n long").repartition(5)


@pytest.mark.parametrize("broadcast,small", [("10m", 8 << 20), ("10m", 0), ("-1", 0)])
def test_classified_like_each_row_alone(spark, broadcast, small, monkeypatch):
    monkeypatch.setattr(text, "SMALL_BYTES", small)
    df = searches(spark)
    score = similarity_score(F.lower("search_term"), text.brand_of_domain(F.col("domain"))).cast("long")
    want = df.select("*", score.alias("brand_similarity_score")).withColumn(
        "search_type", F.when(F.col("brand_similarity_score") > 70, "Branded").otherwise("Unbranded")
    )
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        out = text.classify_terms(df, "search_term", "domain")
        assert out.columns == want.columns and out.count() == df.count()
        assert out.exceptAll(want).count() == 0 and want.exceptAll(out).count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_each_pair_is_scored_once_and_rows_stay_where_they_are(spark):
    df = searches(spark)
    scores = text.brand_scores(df, "search_term", "domain")
    assert scores.count() == df.select("search_term", "domain").distinct().count() < df.count() / 2
    assert scores.agg(F.sum("n")).first()[0] == df.count()
    plan = text.classify_terms(df, "search_term", "domain")._jdf.queryExecution().executedPlan().toString()
    # df itself is dealt out by the test; nothing else moves its rows
    assert plan.count("RoundRobinPartitioning") == 1 and "hashpartitioning" not in plan


def test_other_brands(spark):
    rows = [
        (1, "www.luigi.com", "luigi", 3, 10), (1, "www.luigi.com", "Mario", 4, 20), (1, "www.luigi.com", "Mario", None, 5),
        (2, "www.mario.com", "mario pizza", 1, 2), (3, None, "mario", 7, 9), (4, "www.zzz.com", None, 1, 1), (4, "www.zzz.com", "", 1, 1),
    ]
    terms = spark.createDataFrame(rows, "restaurant_id int, domain string, search_term string, clicks int, impressions int")
    out = sorted(tuple(r) for r in search.other_brand_terms(terms).select("restaurant_id", "search_term", "other_domain", "n_rows", "clicks", "impressions").collect())
    assert out == [(1, "Mario", "www.mario.com", 2, 4, 25), (3, "mario", "www.mario.com", 1, 7, 9)]
