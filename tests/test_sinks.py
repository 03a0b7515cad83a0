import os

import pytest

from mortar.session import remove_scratch, scratch_path
from mortar.sources.generate import generate_rows
from mortar.sources.sinks import materialize


def test_table_is_rebuilt_whole_and_partitioned(spark, tmp_path):
    spark.sql(f"create database if not exists sinks_test location '{tmp_path}/db'")
    try:
        rows = generate_rows(spark, 10, "t").selectExpr("t", "t % 3 as part")
        first = materialize(rows, "sinks_test.kept", kind="table", partition_by=["part"])
        assert first.count() == 10
        again = materialize(rows.where("t <= 4"), "sinks_test.kept", kind="table", partition_by=["part"])
        assert sorted(r["t"] for r in again.collect()) == [1, 2, 3, 4]
        assert any(d.startswith("part=") for d in os.listdir(f"{tmp_path}/db/kept"))
    finally:
        spark.sql("drop database if exists sinks_test cascade")


def test_view_follows_its_source(spark):
    view = materialize(generate_rows(spark, 3, "t"), "sinks_view", kind="view")
    assert view.count() == spark.sql("select * from sinks_view").count() == 3
    with pytest.raises(ValueError):
        materialize(view, "x", kind="other")


def test_scratch_is_removed(spark):
    remove_scratch(spark)
    kept = materialize(generate_rows(spark, 5, "t"), "sinks_scratch")
    assert kept.count() == 5
    folder = kept.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
    assert os.path.isdir(folder)
    scratch_path(spark, "never-written")
    assert remove_scratch(spark) == 1 and not os.path.exists(folder)
