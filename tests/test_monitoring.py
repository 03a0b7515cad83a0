"""Quantile sketches and anomaly scores."""

import datetime as dt
import math
import random
import statistics

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from mortar.operators import sketch
from mortar.plans import monitoring

START = dt.date(2024, 1, 1)
WANTED = {"q01": 10, "q25": 250, "median": 500, "q99": 990, "top": 1000}


def daily(spark, rows):
    return spark.createDataFrame([(START + dt.timedelta(days=d), v) for d, v in rows], "date date, x double").repartition(4)


def exact(values, thousandths):
    known = sorted(v for v in values if v is not None and not math.isnan(v))
    return next((v for i, v in enumerate(known) if (i + 1) * 1000 >= len(known) * thousandths), None)


def near(got, want):
    """The stated error: 1/256 of the value, or half a unit."""
    return got is None if want is None else abs(got - want) <= max(abs(want) / 256, 0.005) + 1e-9 * abs(want)


numbers = st.one_of(st.none(), st.floats(-1e6, 1e6).map(lambda x: round(x, 2)), st.integers(-300, 300).map(lambda x: x / 100), st.floats(-1e12, 1e12))


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(numbers, min_size=1, max_size=80))
def test_quantiles_stay_in_the_stated_error(spark, values):
    got = sketch.quantiles(sketch.sketch_of(daily(spark, [(0, v) for v in values]), ["date"], ["x"]), ["date"], WANTED).collect()
    assert len(got) == 1 and got[0]["n_values"] == sum(v is not None for v in values) and got[0]["n_nulls"] == values.count(None)
    assert all(near(got[0][name], exact(values, q)) for name, q in WANTED.items())


def test_order_of_buckets_and_odd_numbers(spark):
    values = sorted({s * x for x in [0.0, 0.01, 1.27, 1.28, 2.55, 2.56, 2.57, 5.11, 5.12, 1e3, 1e9, 1e17] for s in (1, -1)})
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    got = [r["b"] for r in df.select("x", sketch.bucket_of(F.col("x")).alias("b")).orderBy("x").collect()]
    assert got == sorted(got) and len(set(got)) > len(got) - 6
    odd = spark.createDataFrame([(math.nan,), (math.inf,), (-math.inf,), (None,), (1e300,)], "x double")
    (row,) = sketch.quantiles(sketch.sketch_of(odd.withColumn("k", F.lit(1)), ["k"], ["x"]), ["k"], {"low": 1, "top": 1000}).collect()
    assert (row["n_values"], row["n_nulls"]) == (3, 2) and row["low"] == -row["top"] < -1e16


def test_merged_days_are_the_sketch_of_all(spark):
    rnd = random.Random(1)
    df = daily(spark, [(rnd.randint(0, 9), rnd.choice([None, rnd.lognormvariate(3, 2), -rnd.random()])) for _ in range(3000)])
    by_day = sketch.sketch_of(df, ["date"], ["x"])
    merged, whole = sketch.merge(by_day, []).select("metric", "bucket", "n"), sketch.sketch_of(df, [], ["x"]).select("metric", "bucket", "n")
    assert merged.exceptAll(whole).count() == whole.exceptAll(merged).count() == 0
    # 256 exact buckets, 128 for each binary digit more; negative values go to -100 units, and one is for NULL
    digits = int(df.agg(F.max("x")).first()[0] * 100).bit_length()
    assert by_day.count() < df.count() and whole.count() <= 256 + 128 * (digits - 8) + 101 + 1


def test_runs_of_days_read_the_stored_sketch(spark):
    rnd = random.Random(2)
    rows = [(d, rnd.choice([None, round(rnd.gauss(50, 30), 2)])) for d in [0, 1, 2, 5, 6, 9] for _ in range(60)]
    got = {(r["date"], r["days"]): r for r in monitoring.sketched_quantiles(daily(spark, rows), "date", ["x"], (1, 3)).collect()}
    assert len(got) == 12  # days without rows have none
    for d in (0, 1, 2, 5, 6, 9):
        for days in (1, 3):
            values = [v for e, v in rows if d - days < e <= d]
            r = got[START + dt.timedelta(days=d), days]
            assert r["n_values"] + r["n_nulls"] == len(values)
            assert near(r["q25"], exact(values, 250)) and near(r["q75"], exact(values, 750))


def series(spark, values, key="m"):
    return spark.createDataFrame([(START + dt.timedelta(days=i), key, v) for i, v in enumerate(values)], "date date, metric string, q double").repartition(3)


def told(spark, values, **more):
    rows = monitoring.anomalies(series(spark, values), "date", "metric", ["q"], **more).orderBy("date").collect()
    return [(r["score"], r["outlier"]) for r in rows]


def test_planted_outliers_are_found_and_others_left_alone(spark):
    rnd = random.Random(3)
    values = [100 + rnd.uniform(-3, 3) for _ in range(120)]
    planted = {40: 160.0, 41: 20.0, 90: 140.0}
    for i, v in planted.items():
        values[i] = v
    got = told(spark, values)
    assert {i for i, (_, out) in enumerate(got) if out} == set(planted)
    for i, (score, _) in enumerate(got):
        before = values[max(0, i - 28) : i]
        if len(before) < 7:
            assert score is None
        else:
            center = statistics.median(before)
            assert math.isclose(score, 0.6745 * (values[i] - center) / statistics.median(abs(x - center) for x in before), rel_tol=1e-12)


def test_flat_short_and_missing_series(spark):
    assert told(spark, [5.0] * 10 + [5.0, 6.0]) == [(None, False)] * 11 + [(None, True)]
    assert told(spark, [1.0, 900.0, 1.0]) == [(None, False)] * 3
    gaps = told(spark, [1.0, 2.0, None, 3.0, None, 2.0, 1.0, 3.0, 2.0, None, 99.0])
    assert gaps[9] == (None, False) and gaps[10][1] and not any(out for _, out in gaps[:9])
    assert told(spark, []) == []
