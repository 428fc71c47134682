"""The text queries that SQL can express, against DuckDB on whole tables."""

import pytest
from tests.conftest import SF01
from tests.oracle_check import compare, duck_connection
from tripmart.llm.queries import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_duckdb(spark, name):
    result = compare(spark, duck_connection(SF01), name, QUERIES[name], ORACLE_SQL[name], SF01)
    assert result["ok"] and result["exact"], result


def test_one_query_per_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
