"""Every registered query against its DuckDB text at sf0.01 (the correctness gate)."""

import pytest

from tests.oracle_check import compare, duck_connection
from tests.conftest import SF01

from __spark_entry__ import entry
from tripmart.oracle import oracle_sql
from tripmart.queries import QUERIES

SQL = oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return duck_connection(SF01)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_duckdb(spark, duck, name):
    result = compare(spark, duck, name, QUERIES[name], SQL[name], SF01)
    assert result["columns_match"], (result.get("spark_columns"), result.get("duck_columns"))
    assert result["spark_rows"] == result["duck_rows"]
    assert result["ok"], result.get("examples")
    assert result["exact"], "values agree only within tolerance, not exactly"


def test_entry_smoke(spark):
    df = entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["day_type", "is_precipitation", "temp_bucket", "total_trips", "distinct_hours", "avg_trips_per_hour"]
