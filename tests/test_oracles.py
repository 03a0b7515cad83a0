"""Every registered query against its DuckDB oracle (exact values)."""

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from mortar.oracle import ORACLES
from mortar.registry import QUERIES
from mortar.verify import compare


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_all_queries_are_registered():
    assert QUERIES.items() <= entry.queries().items() and ORACLES.items() <= entry.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck_small, name):
    df = QUERIES[name](spark, SF_SMALL)
    res = compare(df, ORACLES[name], duck_small)
    assert res["columns_match"], res
    assert res["spark_rows"] == res["oracle_rows"], res
    assert res["exact"], res


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == entry.entry(spark).columns
