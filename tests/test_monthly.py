import glob
import os

import pytest
from pyspark.sql import functions as F

from tripmart.operators import staging
from tripmart.plans import medallion, monthly, rollup
from tripmart.sources import testdata as T
from tests.conftest import SF001

CALENDAR = monthly.HalfMonths()


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.fixture(scope="module")
def inputs(spark):
    return T.raw_trips(spark, SF001), T.raw_hourly(spark, SF001), T.raw_zones(spark, SF001), T.trip_rules()


@pytest.fixture(scope="module")
def one_pass(spark, inputs):
    raw, hourly, zones, rules = inputs
    g = medallion.gate(raw, rules)
    cells = rollup.hourly_rollup(staging.stage_trips(g.tagged, "rejection_reason"), "rejection_reason")
    joined = rollup.enrich_rollup(cells.filter("rejection_reason IS NULL"), staging.stage_weather(hourly), staging.stage_zones(zones))
    return {**{name: rows(fn(joined)) for name, fn in rollup.ROLLUP_MARTS.items()}, "dq_quarantine_trend": rows(rollup.quarantine_trend(cells))}


def test_months_published_one_after_another_equal_one_pass(spark, inputs, one_pass, scratch):
    raw, hourly, zones, rules = inputs
    parts = monthly.touched_parts(raw, calendar=CALENDAR)
    assert len(parts) >= 3 and monthly.Months.unknown in parts
    for k, part in enumerate(parts):
        # only the part's own rows are given: what is there of the others is not read again
        mine = raw.filter(monthly.in_parts("tpep_pickup_datetime", [part], CALENDAR))
        marts = monthly.publish_months(mine, hourly, zones, rules, [part], scratch, gold_db="gold_monthly", calendar=CALENDAR)
        if k == 0:
            assert marts["payment_mix"].agg(F.sum("trip_count")).first()[0] < raw.count()
    assert {name: rows(df) for name, df in marts.items()} == one_pass


def test_a_refresh_replaces_its_months_only(spark, inputs, one_pass, scratch):
    raw, hourly, zones, rules = inputs
    weather, zone = staging.stage_weather(hourly), staging.stage_zones(zones)
    parts = monthly.touched_parts(raw, calendar=CALENDAR)
    monthly.refresh_months(raw, weather, zone, rules, parts, scratch, calendar=CALENDAR)
    before = {f: os.path.getmtime(f) for f in glob.glob(f"{scratch}/cells/_part={parts[0]}/*.parquet")}
    fewer = raw.filter("payment_type = 1")
    stores = monthly.refresh_months(fewer, weather, zone, rules, parts[1:], scratch, calendar=CALENDAR)
    assert before and before == {f: os.path.getmtime(f) for f in glob.glob(f"{scratch}/cells/_part={parts[0]}/*.parquet")}
    left = stores.checked.groupBy("_part").agg(F.count_if(F.col("payment_type") == 1).alias("ones"), F.count("*").alias("n")).collect()
    assert all(r.ones == r.n for r in left if r._part != parts[0]) and any(r.ones < r.n for r in left)
    # the whole bronze again, and all is as in one pass; a month without rows is empty
    monthly.refresh_months(raw.filter("false"), weather, zone, rules, parts[:1], scratch, calendar=CALENDAR)
    assert not glob.glob(f"{scratch}/cells/_part={parts[0]}/*.parquet")
    stores = monthly.refresh_months(raw, weather, zone, rules, parts, scratch, calendar=CALENDAR)
    assert {name: rows(df) for name, df in monthly.merged_marts(stores, weather, zone).items()} == one_pass


def test_a_month_is_a_range_that_reaches_the_scan(spark, inputs, scratch):
    raw = inputs[0]
    path = os.path.join(scratch, "bronze")
    raw.write.parquet(path)
    bronze = spark.read.parquet(path).filter(monthly.in_parts("tpep_pickup_datetime", ["2024-01", "2023-12"], monthly.Months()))
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    pushed = bronze._jdf.queryExecution().executedPlan().toString().split("PushedFilters")[-1]
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(tpep_pickup_datetime,2024-01-01" in pushed and "LessThan(tpep_pickup_datetime,2024-02-01" in pushed, pushed
    assert bronze.count() == raw.filter("date_format(tpep_pickup_datetime, 'yyyy-MM') IN ('2024-01', '2023-12')").count()


def test_hours_of_overlapping_parts_count_once(spark, inputs):
    raw, hourly, zones, rules = inputs
    valid = medallion.gate(raw, rules).valid
    weather, zone = staging.stage_weather(hourly), staging.stage_zones(zones)
    cells = lambda trips: rollup.enrich_rollup(rollup.hourly_rollup(staging.stage_trips(trips)), weather, zone)
    halves = [monthly.hour_sets(cells(valid.filter(f"PULocationID % 2 = {k}"))) for k in range(2)]
    merged = monthly.weather_impact_of_sets(halves[0].unionByName(halves[1]))
    assert rows(merged) == rows(rollup.weather_impact(cells(valid)))


def test_month_bounds():
    calendar = monthly.Months()
    assert [str(d) for d in calendar.bounds("2024-12")] == ["2024-12-01", "2025-01-01"]
    assert [str(d) for d in CALENDAR.bounds("2024-02-b")] == ["2024-02-16", "2024-03-01"]
    assert CALENDAR.unknown == "unknown_month"
