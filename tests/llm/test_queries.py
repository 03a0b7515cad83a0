"""Registered queries of this subpackage against their DuckDB SQL."""

import pytest
from llm_fixtures import SF_SMALL

from mortar.llm.queries import ORACLES, QUERIES
from mortar.verify import compare


def test_thirteen_operators():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck_small, name):
    got = compare(QUERIES[name](spark, SF_SMALL), ORACLES[name], duck_small)
    assert got["columns_match"] and got["spark_rows"] == got["oracle_rows"] and got["exact"], got
