"""Ranges merged in batches, growing snapshots, values on a day."""

import datetime as dt
import os
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from mortar.plans import history

NAMES = ("k", "day", "seq", "v")
SCHEMA = "k string, day date, seq long, v string"
START = dt.date(2024, 1, 1)


def events_of(spark, rows):
    return spark.createDataFrame([(k, None if d is None else START + dt.timedelta(days=d), s, v) for k, d, s, v in rows], SCHEMA)


def ranges(df):
    return sorted(map(tuple, df.select("k", "v", "valid_from", "valid_to").collect()), key=repr)


def merged(spark, path, batches, **more):
    for rows in batches:
        history.merge_changes(path, events_of(spark, rows), *NAMES, **more)
    return ranges(history.read_ranges(spark, path, "k", "v")) if os.path.exists(path) else []


row = st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 9), st.integers(0, 50), st.sampled_from(["x", "y", None]))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(row, min_size=1, max_size=30), cuts=st.lists(st.integers(0, 30), max_size=2))
def test_any_batches_give_what_one_batch_gives(spark, tmp_path_factory, rows, cuts):
    path = str(tmp_path_factory.mktemp("store") / "ranges")
    edges = [0, *sorted(min(c, len(rows)) for c in cuts), len(rows)]
    batches = [rows[a:b] for a, b in zip(edges, edges[1:]) if a < b]
    assert merged(spark, path, batches, buckets=2) == ranges(history.validity_ranges(events_of(spark, rows), *NAMES))


def test_a_late_event_splits_extends_and_replaces(spark, tmp_path):
    day = lambda n: START + dt.timedelta(days=n)
    path = str(tmp_path / "r")
    assert merged(spark, path, [[("a", 1, 1, "x"), ("a", 5, 2, "x"), ("a", 8, 3, "y")]]) == [("a", "x", day(1), day(8)), ("a", "y", day(8), None)]
    # splits x, which a later event on day 5 had confirmed
    assert merged(spark, path, [[("a", 3, 9, "z")]]) == [("a", "x", day(1), day(3)), ("a", "x", day(5), day(8)), ("a", "y", day(8), None), ("a", "z", day(3), day(5))]
    # the same day: the later by seq wins, an earlier one changes nothing
    assert merged(spark, path, [[("a", 3, 10, "x"), ("a", 8, 2, "x")]]) == [("a", "x", day(1), day(8)), ("a", "y", day(8), None)]
    # before everything: extends to the front
    assert merged(spark, path, [[("a", 0, 11, "x")]])[0] == ("a", "x", day(0), day(8))
    # nothing, or events without a day
    assert history.merge_changes(path, events_of(spark, []), *NAMES) == 0
    assert history.merge_changes(path, events_of(spark, [("a", None, 99, "q")]), *NAMES) == 0


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.startswith("part-")}


def test_only_folders_of_changed_keys_are_written(spark, tmp_path):
    path, rnd = str(tmp_path / "r"), random.Random(1)
    rows = [(f"k{rnd.randint(0, 300)}", rnd.randint(0, 30), i, rnd.choice("xyz")) for i in range(2000)]
    merged(spark, path, [rows])
    before = files(path)
    assert history.merge_changes(path, events_of(spark, [("k7", 3, 9999, "late"), ("k8", 4, 9999, "late")]), *NAMES) <= 2
    after = files(path)
    folders = lambda fs: {os.path.dirname(f) for f in fs}
    assert len(folders(before.keys() - after.keys())) <= 2 and len(before.keys() & after.keys()) > len(before) / 2
    late = [("k7", 3, 9999, "late"), ("k8", 4, 9999, "late")]
    assert ranges(history.read_ranges(spark, path, "k", "v")) == ranges(history.validity_ranges(events_of(spark, rows + late), *NAMES))


def snapshots(spark, path):
    return sorted((str(r[0]), r[1], r[2]) for r in spark.read.parquet(path).select("snapshot_date", "k", "v").collect())


def taken(spark, rows):
    return spark.createDataFrame([(dt.date.fromisoformat(d), k, v) for d, k, v in rows], "snapshot_date date, k string, v string")


def test_a_rerun_replaces_its_day_alone(spark, tmp_path):
    path = str(tmp_path / "s")
    assert history.write_snapshots(taken(spark, [("2024-01-01", "a", "x"), ("2024-01-01", "b", None)]), path, ["2024-01-01"]) == {"2024-01-01": 2}
    history.write_snapshots(taken(spark, [("2024-01-02", "a", "y"), ("2024-01-03", "a", "y")]), path, ["2024-01-02", "2024-01-03"])
    before = files(path)
    history.write_snapshots(taken(spark, [("2024-01-02", "c", "z")]), path, ["2024-01-02"])
    assert snapshots(spark, path) == [("2024-01-01", "a", "x"), ("2024-01-01", "b", None), ("2024-01-02", "c", "z"), ("2024-01-03", "a", "y")]
    assert {f: t for f, t in files(path).items() if "2024-01-02" not in f} == {f: t for f, t in before.items() if "2024-01-02" not in f}
    # a day that has nothing any more
    assert history.write_snapshots(taken(spark, []), path, ["2024-01-01"]) == {"2024-01-01": 0}
    assert {d for d, _, _ in snapshots(spark, path)} == {"2024-01-02", "2024-01-03"}


@pytest.mark.parametrize("day", ["2024-01-02", None])
def test_days_that_are_not_listed_are_refused(spark, tmp_path, day):
    path = str(tmp_path / "s")
    history.write_snapshots(taken(spark, [("2024-01-02", "a", "x")]), path, ["2024-01-02"])
    rows = spark.createDataFrame([(None if day is None else dt.date.fromisoformat(day), "a", "q")], "snapshot_date date, k string, v string")
    with pytest.raises(PySparkException):
        history.write_snapshots(rows, path, ["2024-01-03"])
    assert snapshots(spark, path) == [("2024-01-02", "a", "x")]


def test_value_on_day(spark):
    rows = [("a", 0, 1, "x"), ("a", 40, 2, None), ("a", 100, 3, "y"), ("b", 10, 4, "z"), (None, 0, 5, "n")]
    r = history.validity_ranges(events_of(spark, rows), *NAMES)
    facts = [(k, START + dt.timedelta(days=d)) for k in ("a", "b", "c") for d in (-5, 0, 10, 39, 40, 41, 99, 100, 400)] + [("a", None), (None, START)]
    out = history.value_on_day(spark.createDataFrame(facts, "k string, at date"), "at", r, "k", "v").collect()
    plain = lambda k, d: next((v for key, f, _, v in sorted((x for x in rows if x[0] == k), key=lambda x: -x[1]) if d is not None and d >= START + dt.timedelta(days=f)), None) if k else None
    assert sorted(map(tuple, out), key=repr) == sorted(((k, d, plain(k, d)) for k, d in facts), key=repr)
    assert history.value_on_day(spark.createDataFrame([], "k string, at date"), "at", r, "k", "v").count() == 0
