"""What a task holds and what is shuffled as the daily tables' input grows."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from mortar import registry
from mortar.operators import checks, sketch, temporal
from mortar.operators.compare import compare_all_columns, compare_relations
from mortar.plans import customers as saas
from mortar.sources.sinks import clustered_table, stored_folders, write_folders

START = dt.date(2023, 1, 1)
DAY = lambda n: None if n is None else START + dt.timedelta(days=n)
AT = lambda n: None if n is None else dt.datetime.combine(DAY(n), dt.time(9))


def same(x, y):
    return x.exceptAll(y).count() == 0 and y.exceptAll(x).count() == 0


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def built(spark, n=60, rows=400):
    """Customers, subscriptions, logins and tickets with NULLs, repeated rows and ids that don't exist."""
    rnd = random.Random(n)
    day = lambda lo=-200, hi=900: None if rnd.random() < 0.05 else rnd.randint(lo, hi)
    who = lambda: rnd.choice([None, "none", *[f"c{i}" for i in range(n)]])
    people = [(f"c{i}", DAY(day(0, 700)), "east", "retail") for i in range(n)] + [(None, START, "west", "retail"), ("c1", DAY(5), "east", "retail")]
    subs = [(who(), rnd.choice([None, "p1", "p2"]), DAY(a), DAY(None if rnd.random() < 0.2 else rnd.randint(1, 900)), rnd.choice([None, 999, 4999])) for a in (day() for _ in range(rows))]
    logins = [(rnd.choice([None, "u1", "u2", "u3"]), who(), rnd.choice([None, "guest", "admin", "advanced", "standard"]), AT(day())) for _ in range(rows)]
    tickets = [(f"t{i}", who(), rnd.choice([None, "open", "lost", "closed"]), AT(a), rnd.choice([None, "bug", "incident", "question"]), AT(day())) for i, a in enumerate(day() for _ in range(rows))]
    return (
        spark.createDataFrame(people, "customer_id string, acquisition_date date, region string, industry string"),
        spark.createDataFrame(subs + subs[:50], "customer_id string, product_id string, start_date date, end_date date, arr int"),
        spark.createDataFrame(logins + logins[:50], "user_id string, customer_id string, user_type string, login_timestamp timestamp_ntz"),
        spark.createDataFrame(tickets + tickets[:50], "ticket_id string, customer_id string, status string, created_date timestamp_ntz, ticket_category string, closed_date timestamp_ntz"),
    )


@pytest.mark.parametrize("mode", ["literal", "trailing", "distinct"])
def test_segments_are_made_by_as_many_tasks_as_the_input_needs(spark, monkeypatch, mode):
    c, subs, logins, tickets = built(spark)
    few = saas.metric_segments(c, subs, logins, tickets, logins_mode=mode, parts=2)
    monkeypatch.setattr(temporal, "TASK_ROWS", 100)
    assert temporal.parts_for(c, subs, logins, tickets) == 15
    many = saas.metric_segments(c, subs, logins, tickets, logins_mode=mode)
    assert same(few, many)
    # the rows are dealt by customer below the window, and by nothing after that
    before = plan_of(many).split("Window")[0]
    assert "Exchange" not in before and many.rdd.getNumPartitions() == 15


@pytest.fixture
def no_broadcast(spark):
    """As Spark plans when its estimates are over the broadcast threshold."""
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {n: spark.conf.get(n, None) for n in names}
    for n in names:
        spark.conf.set(n, "-1")
    yield
    for n, v in before.items():
        spark.conf.unset(n) if v is None else spark.conf.set(n, v)


def exchanges(df):
    return plan_of(df).count("Exchange hashpartitioning")


def test_days_are_not_shuffled_to_meet_their_bounds(spark, no_broadcast):
    plan = plan_of(saas.daily_metrics(*built(spark)))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert plan.count("Exchange hashpartitioning") == 1  # a row a day and task, for the bounds


def test_clustered_days_need_no_exchange(spark, no_broadcast, monkeypatch):
    c, *inputs = built(spark)
    monkeypatch.setattr(registry, "_saas", lambda spark, sf_dir: (c, *inputs))
    out = registry.q_customers_enriched_clustered(spark, "")
    assert exchanges(out) == 1  # for the bounds
    plain = saas.customers_enriched(c, saas.daily_metrics(c, *inputs), as_of=registry.AS_OF)
    assert same(out, plain) and out.count() == c.count()


@pytest.mark.parametrize("parts", [1, 4, 128])
def test_a_refresh_writes_one_file_a_task_and_folder_at_most(spark, tmp_path, monkeypatch, parts):
    monkeypatch.setattr(saas, "parts_for", lambda *tables: parts)
    path = str(tmp_path / "segments")
    c, subs, logins, tickets = built(spark)
    late = F.crc32("customer_id") % 3 == 0
    saas.refresh_segments(path, c, c, subs, logins.where(~F.coalesce(late, F.lit(False))), tickets)
    changed = logins.where(late).select("customer_id").unionByName(spark.createDataFrame([(None,)], "customer_id string"))
    saas.refresh_segments(path, changed, c, subs, logins, tickets)
    files = [os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.startswith("part-")]
    assert len(files) <= max(parts, len({os.path.dirname(f) for f in files}))
    assert same(saas.stored_daily_metrics(spark, path), saas.daily_metrics(c, subs, logins, tickets))


def test_audits_compare_in_place(spark, no_broadcast, monkeypatch):
    c, *inputs = built(spark)
    monkeypatch.setattr(registry, "_saas", lambda spark, sf_dir: (c, *inputs))
    alone, full = registry._ticket_plans(spark, "")
    told = compare_relations(alone, full)
    # one each for the bounds, the customers, the tickets and the three rows of the result
    assert plan_of(told).count("ENSURE_REQUIREMENTS") <= 6 and "SortMergeJoin" not in plan_of(told)
    assert sorted(map(tuple, told.collect()), key=str) == sorted(map(tuple, compare_relations(*(df.localCheckpoint() for df in (alone, full))).collect()), key=str)
    diff = registry.q_diff_open_tickets(spark, "")
    a, b = alone.localCheckpoint(), full.localCheckpoint()
    want = a.exceptAll(b).withColumn("side", F.lit("a")).unionByName(b.exceptAll(a).withColumn("side", F.lit("b")))
    assert same(diff.drop("copies"), want) and want.count() > 0


def test_columns_of_repeated_and_null_keys_compare_as_joined(spark):
    rnd = random.Random(3)
    rows = lambda n: [(rnd.choice([None, *range(12)]), rnd.choice([None, 1, 2]), rnd.choice([None, "x", "y"]), rnd.choice([None, True, False])) for _ in range(n)]
    a, b = (spark.createDataFrame(rows(n), "k int, l int, v string, f boolean") for n in (40, 55))
    for x, y in ((a, b), (a.dropDuplicates(["k", "l"]), b.dropDuplicates(["k", "l"])), (a, b.limit(0))):
        x, y = x.localCheckpoint(), y.localCheckpoint()
        j = x.toDF("k", "l", "av", "af").withColumn("ia", F.lit(1)).join(y.toDF("k", "l", "bv", "bf").withColumn("ib", F.lit(1)), ["k", "l"], "full_outer").collect()
        met = [r for r in j if r["ia"] and r["ib"]]
        want = set()
        for c in "vf":
            pairs = [(r["a" + c], r["b" + c]) for r in met]
            same_, none = sum(p == q and p is not None for p, q in pairs), sum(p is None and q is None for p, q in pairs)
            want.add((c, same_, none, len(pairs) - same_ - none, sum(not r["ia"] for r in j), sum(not r["ib"] for r in j)))
        assert {tuple(r) for r in compare_all_columns(x, y, ["k", "l"]).collect()} == want


def test_columns_of_dealt_tables_compare_without_an_exchange(spark, no_broadcast):
    rows = spark.range(300).selectExpr("id % 7 as k", "id as d", "id % 3 as v")
    a, b = rows.repartition(3, "k"), clustered_table(rows, "test_compared", ["k"], ["d"], buckets=3)
    stages = []
    real = checks.materialize

    def kept(df, *args, **kw):
        stages.append(plan_of(df).count("ENSURE_REQUIREMENTS"))
        return real(df, *args, **kw)

    import mortar.operators.compare as compare

    before, compare.materialize = compare.materialize, kept
    try:
        assert [tuple(r) for r in compare_all_columns(a, b, ["k", "d"]).collect()] == [("v", 300, 0, 0, 0, 0)]
    finally:
        compare.materialize = before
    assert stages == [1]  # the counts of the tasks


def test_unique_by_hash_counts_like_unique(spark, monkeypatch):
    monkeypatch.setattr(checks, "TASK_VALUES", 10)
    df = spark.createDataFrame([(None if i % 9 == 0 else f"v{i % 40}" if i < 60 else f"w{i}",) for i in range(100)], "v string")
    plain, hashed = checks.check_unique(df, "v"), checks.check_unique(df, "v", by_hash=True)
    assert plain.count() > 0 and same(plain, hashed)
    assert checks.check_unique(df.distinct(), "v", by_hash=True).count() == 0
    told = checks.run_checks(df, checks.Tests(unique_by_hash=["v"])).collect()
    assert [tuple(r) for r in told] == [("unique", "v", plain.count())]


def test_a_sketch_works_out_buckets_of_counted_values(spark):
    df = spark.range(500).selectExpr("id % 5 as k", "case when id % 11 = 0 then null when id % 13 = 0 then double('nan') else id % 3 * 0.25D end as v", "cast(id % 2 as int) as w")
    made = sketch.sketch_of(df, ["k"], ["v", "w"])
    assert plan_of(made).count("HashAggregate") == 4  # values, then buckets
    each = df.selectExpr("k", "inline(array(struct('v' as metric, v as x), struct('w' as metric, cast(w as double) as x)))")
    want = each.select("k", "metric", sketch.bucket_of(F.col("x")).alias("bucket")).groupBy("k", "metric", "bucket").agg(F.count(F.lit(1)).alias("n"))
    assert same(made, want)


def exchanges_of(plan):
    return plan.count("Exchange hashpartitioning")


def test_rows_are_shuffled_once_to_their_customer(spark, no_broadcast):
    plan = plan_of(saas.metric_segments(*built(spark), parts=4))
    # one each for subscriptions, logins and tickets; customers are summed, then dealt
    assert exchanges_of(plan) == 5


@pytest.mark.parametrize("mode, rows, most", [("literal", 100, 1000), ("distinct", 1, 2)])
def test_customers_with_very_many_rows_are_counted_first(spark, monkeypatch, mode, rows, most):
    c, subs, logins, tickets = built(spark)
    hot = lambda df, n: df.unionAll(spark.range(n).crossJoin(df.where("customer_id = 'c7'").limit(1)).drop("id"))
    logins, tickets = hot(logins, 300), hot(tickets, 200)
    few = saas.metric_segments(c, subs, logins, tickets, logins_mode=mode, parts=3).localCheckpoint()
    assert temporal.crowded_classes("customer_id", subs, logins, tickets) == []
    monkeypatch.setattr(temporal, "TASK_ROWS", 100)
    c7 = spark.createDataFrame([("c7",)], "customer_id string").select(temporal._class("customer_id")).first()[0]
    assert temporal.crowded_classes("customer_id", subs, logins, tickets) == [c7]
    monkeypatch.setattr(temporal, "TASK_ROWS", rows)
    monkeypatch.setattr(temporal, "MOST_CROWDED", most)
    assert len(temporal.crowded_classes("customer_id", subs, logins, tickets)) == min(most, rows == 1 and 61 or 1)
    assert same(few, saas.metric_segments(c, subs, logins, tickets, logins_mode=mode, parts=3))


def test_sums_and_distinct_items_in_one_pass(spark):
    subs = built(spark)[1]
    lo, hi, span = F.col("start_date"), F.date_add("end_date", 1), ("2023-01-01", "2024-12-31")
    values = {"n": F.lit(1), "arr": F.coalesce("arr", F.lit(0))}
    summed = lambda df: df.groupBy("customer_id", "day").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n", "arr", "items", "n_lag", "arr_lag", "items_lag")])
    one = temporal.sums_and_distinct_events(subs, "customer_id", "product_id", lo, hi, values, *span, "items", 90)
    late = {f"{c}_lag": v for c, v in values.items()}
    apart = temporal.interval_events(subs, "customer_id", lo, hi, values, *span).unionByName(
        temporal.interval_events(subs, "customer_id", lo, hi, late, *span, shift=90), allowMissingColumns=True
    )
    items = temporal.distinct_active_events(subs, "customer_id", "product_id", lo, hi, *span, out="items", lags={"items_lag": 90})
    assert same(summed(one), summed(apart.unionByName(items, allowMissingColumns=True))) and one.count() > 500


def test_stored_folders_are_read_without_an_exchange(spark, tmp_path, no_broadcast):
    rows = spark.range(500).selectExpr("case when id % 9 = 0 then null else concat('k', id % 40) end as k", "id as v").withColumn("f", F.pmod(F.hash("k"), F.lit(8)).cast("int"))
    path, tables = str(tmp_path / "it's stored"), spark.catalog.listTables()
    write_folders(rows.repartition(16, "k"), path, "f", "k", 8)
    gone = spark.createDataFrame([("k3",), ("k8",), (None,)], "_k string").repartition(8, "_k").hint("shuffle_hash")
    with stored_folders(spark, path, rows.schema, "f", "k", 8) as stored:
        kept = stored.where("f < 6").join(gone, F.col("k") == F.col("_k"), "left_anti")
        assert plan_of(kept).count("Exchange") == 1  # of the ids
        assert same(kept.select(rows.columns), rows.where("f < 6 and (k is null or k not in ('k3', 'k8'))"))
    assert spark.catalog.listTables() == tables


def test_a_refresh_leaves_nothing_but_its_folders(spark, tmp_path, no_broadcast, monkeypatch):
    path = str(tmp_path / "segments")
    c, subs, logins, tickets = built(spark)
    changed = spark.createDataFrame([(f"c{i}",) for i in range(0, 60, 3)], "customer_id string")
    names, plans, tables = (*saas._WRITING,), [], spark.catalog.listTables()
    before = {n: spark.conf.get(n, None) for n in names}
    real = saas.write_folders

    def kept(df, *args):
        plans.append(plan_of(df))
        assert {n: spark.conf.get(n) for n in names} == saas._WRITING
        return real(df, *args)

    monkeypatch.setattr(saas, "write_folders", kept)
    monkeypatch.setattr(saas, "scratch_path", lambda spark, name: str(tmp_path / name))
    saas.refresh_segments(path, c, c, subs, logins, tickets)
    saas.refresh_segments(path, changed, c, subs, logins.limit(300).localCheckpoint(), tickets)
    # of the store, only the changed ids are dealt to meet it; their customers' folders are not
    assert exchanges_of(plans[1]) - exchanges_of(plans[0]) == 1
    assert {n: spark.conf.get(n, None) for n in names} == before
    assert os.listdir(tmp_path) == ["segments"] and not [n for n in os.listdir(path) if n.startswith("_new")]
    assert spark.catalog.listTables() == tables
