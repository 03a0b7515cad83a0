"""Invariants of the model outputs on driver data."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from mortar.registry import QUERIES


def test_risk_score_within_range(spark):
    d = QUERIES["daily_metrics"](spark, SF_SMALL)
    bad = d.where((F.col("customer_risk_score") < 0) | (F.col("customer_risk_score") > 100)).count()
    assert bad == 0
    # every day with more than one distinct raw score reaches both 0 and 100
    per_day = d.groupBy("date").agg(F.min("customer_risk_score").alias("lo"), F.max("customer_risk_score").alias("hi"),
                                    F.countDistinct("customer_risk_score_raw").alias("n"))
    assert per_day.where((F.col("n") > 1) & ((F.col("lo") != 0) | (F.col("hi") != 100))).count() == 0


def test_top_n_are_cumulative_and_types_add_up(spark):
    r = QUERIES["restaurant_metrics"](spark, SF_SMALL)
    for t in ("overall", "branded", "unbranded"):
        assert r.where(F.col(f"{t}_terms_top_3") > F.col(f"{t}_terms_top_10")).count() == 0
        assert r.where(F.col(f"{t}_terms_top_10") > F.col(f"{t}_terms_top_20")).count() == 0
        assert r.where(F.col(f"{t}_clicks_top_3") > F.col(f"{t}_clicks_top_20")).count() == 0
    for m in ("clicks", "impressions", "unique_terms", "clicks_top_3", "terms_top_20"):
        total = F.coalesce(F.col(f"branded_{m}"), F.lit(0)) + F.coalesce(F.col(f"unbranded_{m}"), F.lit(0))
        assert r.where(total != F.col(f"overall_{m}")).count() == 0


def test_daily_grid_is_dense_and_unique(spark):
    d = QUERIES["daily_metrics"](spark, SF_SMALL)
    per = d.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n"), F.min("date").alias("a"), F.max("date").alias("b"))
    assert per.where(F.col("n") != F.datediff("b", "a") + 1).count() == 0
    assert d.select("record_key").distinct().count() == d.count()
