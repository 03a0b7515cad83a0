"""Clustered tables, daily segments kept up to date, and distinct users of trailing windows."""

import datetime as dt
import os
import random

from pyspark.sql import functions as F

from conftest import SF_SMALL
from mortar.plans import customers as saas
from mortar.operators.rank import latest_per_key
from mortar.sources import fixtures as fx
from mortar.sources.sinks import clustered_table
from mortar.sources.tables import Sources


def same(x, y):
    return x.exceptAll(y).count() == 0 and y.exceptAll(x).count() == 0


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_clustered_tables_join_and_aggregate_without_an_exchange(spark):
    rnd = random.Random(1)
    rows = spark.createDataFrame([(rnd.choice([None, *range(40)]), i, rnd.choice("xyz")) for i in range(900)], "customer_id int, day int, v string")
    people = spark.createDataFrame([(i, f"n{i}") for i in range(45)] + [(None, "none")], "customer_id int, name string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tables = [clustered_table(df, "test_clustered", ["customer_id"], order, buckets=4) for df, order in ((people, []), (rows, ["day"]))]
        joined = lambda p, r: p.join(latest_per_key(r, ["customer_id"], ["day"]), "customer_id", "left")
        stored, plain = joined(*tables), joined(people, rows)
        assert "Exchange" in plan_of(plain) and "Exchange" not in plan_of(stored)
        assert same(stored, plain)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def inputs(spark):
    s = Sources(spark, SF_SMALL)
    return fx.saas_customers(s), fx.saas_subscriptions(s), fx.saas_login_events(s), fx.saas_support_tickets(s)


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.startswith("part-")}


def test_refreshed_segments_equal_a_rebuild(spark, tmp_path):
    path = str(tmp_path / "segments")
    c, subs, logins, tickets = inputs(spark)
    saas.refresh_segments(path, c, c, subs, logins, tickets)
    before = files(path)
    ids = ["cust000003", "cust000010"]
    # corrected subscriptions of one customer, another one that is gone
    changed = spark.createDataFrame([(i,) for i in ids], "customer_id string")
    subs2 = subs.withColumn("arr", F.when(F.col("customer_id") == ids[0], 4999).otherwise(F.col("arr")))
    c2 = c.where(~F.col("customer_id").eqNullSafe(F.lit(ids[1])))
    assert 1 <= saas.refresh_segments(path, changed, c2, subs2, logins, tickets) <= 2
    folders = {os.path.dirname(f) for f in before.keys() ^ files(path).keys()}
    assert len(folders) <= 2 and len({os.path.dirname(f) for f in before}) > 10
    assert same(saas.stored_daily_metrics(spark, path), saas.daily_metrics(c2, subs2, logins, tickets))
    # nothing changed, nothing written
    kept = files(path)
    assert saas.refresh_segments(path, changed.where(F.lit(False)), c2, subs2, logins, tickets) == 0 and files(path) == kept


def test_a_folder_without_customers_goes(spark, tmp_path):
    path = str(tmp_path / "segments")
    c, subs, logins, tickets = (df.where(F.col("customer_id") == "cust000003") for df in inputs(spark))
    saas.refresh_segments(path, c, c, subs, logins, tickets)
    assert files(path)
    saas.refresh_segments(path, c, c.where(F.lit(False)), subs, logins, tickets)
    assert not files(path)


def test_distinct_users_of_the_window(spark):
    rnd = random.Random(5)
    start, day = dt.date(2023, 1, 1), lambda n: dt.date(2023, 1, 1) + dt.timedelta(days=n)
    events = [(rnd.choice(["u1", "u2", "u3", None]), rnd.choice(["a", "b"]), "admin", None if rnd.random() < 0.05 else rnd.randint(-200, 500)) for _ in range(120)]
    events += [("u9", "a", "admin", 100)] * 40  # a user who logs in often counts once
    logins = spark.createDataFrame(
        [(u, c, t, None if d is None else dt.datetime.combine(day(d), dt.time(9))) for u, c, t, d in events], "user_id string, customer_id string, user_type string, login_timestamp timestamp_ntz"
    )
    people = spark.createDataFrame([("a", start), ("b", day(250)), ("c", start)], "customer_id string, acquisition_date date")
    out = saas.daily_logins(people, logins, logins_mode="distinct").collect()
    users = lambda c, n, first, last: len({u for u, k, _, d in events if k == c and u and d is not None and n - first <= d <= n - last}) or None
    assert len(out) > 1500
    for r in out:
        n = (r["date"] - start).days
        assert r["num_unique_users_last_3m"] == users(r["customer_id"], n, 90, 0)
        assert r["num_unique_users_prev_3m"] == users(r["customer_id"], n, 180, 91)
