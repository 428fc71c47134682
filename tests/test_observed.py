"""Counts observed while tables are written, against the operators that scan."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF001, SF01
from tripmart.operators import expect, gate as G, observed, staging
from tripmart.plans import medallion, rollup
from tripmart.session import stored
from tripmart.sources import testdata as T


@pytest.fixture(scope="module")
def published(spark):
    return medallion.publish_all(
        T.raw_trips(spark, SF01), T.raw_hourly(spark, SF01), T.raw_zones(spark, SF01), T.trip_rules(),
        silver_db="silver_observed", gold_db="gold_observed", match_rate_threshold=0.6,
    )


def test_report_and_breakdown_equal_the_scanning_ones(spark, published):
    checked = spark.table("silver_observed.trips_checked")
    report, expected = published.report, G.gate_report(checked, medallion.COPIES_COL)
    assert report.schema.simpleString() == expected.schema.simpleString() and report.collect() == expected.collect()
    assert published.breakdown.collect() == G.quarantine_breakdown(spark.table("silver_observed.quarantine")).collect()


def test_report_of_no_rows(spark):
    empty = G.tag_first_failure(T.raw_trips(spark, SF001).limit(0).withColumn("_copies", F.lit(1)), T.trip_rules())
    watched, counts = observed.watch(empty, G.report_counts("_copies"))
    watched.write.format("noop").mode("overwrite").save()
    assert G.report_of_counts(spark, counts.get()).collect() == G.gate_report(empty, "_copies").collect()
    assert G.breakdown_of_counts(spark, {"late": 0}).collect() == []


def test_report_and_expectations_scan_no_trips(published):
    for df in (published.report, published.breakdown, published.expectations):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "trips_checked" not in plan and "trip_distance" not in plan


def test_failing_counts_are_observed(spark):
    df = spark.createDataFrame([(1, None), (2, "a"), (None, "b"), (None, None)], "k int, v string")
    watched, counts = observed.watch(df, {"k": observed.nulls("k"), "any v": observed.any_null(F.col("v")), "none": observed.any_null(F.col("v"), F.col("k") > 5)})
    stored(watched, "observed_test")
    assert counts.get() == {"k": 2, "any v": 1, "none": 0}
    rows = observed.summaries(spark, counts.get())
    assert rows.columns == expect.summarize("x", df).columns and rows.dtypes == expect.summarize("x", df).dtypes
    assert [tuple(r) for r in rows.collect()] == [("k", 2, False), ("any v", 1, False), ("none", 0, True)]


def test_expectations_of_a_broken_publish(spark):
    raw = T.raw_trips(spark, SF001)
    hourly = T.raw_hourly(spark, SF001)
    twice = hourly.unionByName(hourly.filter("weather_hour_local IS NOT NULL"))
    zones = T.raw_zones(spark, SF001).withColumn("LocationID", F.lit(1))
    run = medallion.publish_all(raw, twice, zones, T.trip_rules(), silver_db="silver_broken", gold_db="gold_broken", match_rate_threshold=1.01)
    failing = {r.expectation: r.failing_rows for r in run.expectations.collect() if not r.passed}
    hours = hourly.filter("weather_hour_local IS NOT NULL").count()
    assert failing == {"unique:stg_weather.weather_hour_local": hours, "unique:stg_zones.location_id": 1, medallion.MATCH_RATE_TEST: 1}
    # the trend counts trips, however often a dimension key stands there
    assert spark.table("gold_broken.dq_quarantine_trend").agg(F.sum("quarantined_count")).first()[0] == run.report.first().quarantined_rows


@pytest.mark.parametrize("mart", ["daily_weather_ridership", "revenue_efficiency_by_hour", "weather_impact", "weather_speed_impact"])
def test_mart_keys_are_those_of_the_mart(spark, mart):
    g = medallion.gate(T.raw_trips(spark, SF01), T.trip_rules())
    cells = rollup.enriched_rollup(staging.stage_trips(g.valid), staging.stage_weather(T.raw_hourly(spark, SF01)), staging.stage_zones(T.raw_zones(spark, SF01)))
    keys = rollup.mart_keys(cells, mart)
    whole = rollup.ROLLUP_MARTS[mart](cells).select(*keys.columns)
    assert sorted(map(str, keys.collect())) == sorted(map(str, whole.collect()))
