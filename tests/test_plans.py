"""Physical-plan properties that matter at scale, checked on every registered query."""

import pytest
from pyspark.sql import functions as F

from tripmart.operators import staging
from tripmart.plans import medallion, rollup
from tripmart.queries import QUERIES
from tripmart.sources import testdata as T
from tests.conftest import SF001

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "SortAggregate", "BatchEvalPython", "ArrowEvalPython")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


#: Sorted aggregates of what is bounded: bitmaps of hours per weather group.
BOUNDED = {"weather_impact_merged": {"SortAggregate"}}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_sort_aggregate_or_python(spark, name):
    plan = _plan(QUERIES[name](spark, SF001))
    assert not [f for f in FORBIDDEN if f in plan and f not in BOUNDED.get(name, ())], plan


def test_enrichment_broadcasts_both_dimensions_and_prunes_the_scan(spark):
    plan = QUERIES["enriched_trips"](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") >= 2 and "SortMergeJoin" not in plan
    events_scans = [line for line in plan.splitlines() if "events.parquet" in line or "FileScan parquet" in line]
    assert events_scans and not any("props" in line for line in events_scans)


def test_marts_aggregate_partially_before_the_shuffle(spark):
    plan = _plan(QUERIES["payment_mix"](spark, SF001))
    assert "partial_count" in plan or "partial_sum" in plan


def test_rollup_reads_only_the_valid_partition(spark):
    result = medallion.publish_all(
        T.raw_trips(spark, SF001), T.raw_hourly(spark, SF001), T.raw_zones(spark, SF001), T.trip_rules(),
        silver_db="silver_plans", gold_db="gold_plans",
    )
    assert result.report.first().valid_rows == 859
    checked = spark.table("silver_plans.trips_checked")
    valid = spark.table("silver_plans.trips_input")
    assert valid.count() + spark.table("silver_plans.quarantine").count() == checked.count()
    assert valid.columns == [c for c in T.raw_trips(spark, SF001).columns]
    plan = _plan(rollup.hourly_rollup(staging.stage_trips(valid)))
    assert "PartitionFilters: [isnotnull(_gate_status" in plan or "_gate_status=valid" in plan
    assert "passenger_count" not in plan.split("ReadSchema")[-1].split("\n")[0]


def test_marts_run_no_jobs_while_they_are_built(spark):
    """Built from a path read before, a mart query submits nothing."""
    names = ("enriched_trips", "trips_by_hour_weekday", "daily_ridership", "weather_impact", "demand_by_borough", "payment_mix",
             "revenue_efficiency", "speed_impact", "borough_summary", "dry_vs_wet", "temp_by_daytype", "pivot_hour_weekday",
             "pivot_speed", "expect_match_rate")
    QUERIES["payment_mix"](spark, SF001)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "mart queries")
    try:
        for name in names:
            QUERIES[name](spark, SF001)
        assert list(tracker.getJobIdsForGroup("building")) == []
    finally:
        spark.sparkContext.setJobGroup("default", "")


def test_two_databases_do_not_disturb_each_other(spark):
    hourly, zones, rules = T.raw_hourly(spark, SF001), T.raw_zones(spark, SF001), T.trip_rules()
    raw = T.raw_trips(spark, SF001)
    medallion.publish_all(raw, hourly, zones, rules, silver_db="silver_one", gold_db="gold_one")
    n = spark.table("silver_one.trips_input").count()
    medallion.publish_all(raw.filter("payment_type = 1"), hourly, zones, rules, silver_db="silver_two", gold_db="gold_two")
    other = spark.newSession()
    assert other.table("silver_one.trips_input").count() == n > other.table("silver_two.trips_input").count()
    for view in ("stg_trips", "stg_weather", "stg_zone_lookup", "stg_quarantine", "int_trips_weather", "quarantine"):
        assert other.table(f"silver_one.{view}").count() > 0
    assert other.table("silver_one.int_trips_weather").columns == QUERIES["enriched_trips"](spark, SF001).columns


def test_payloads_are_parsed_once(spark):
    for name in ("hourly_payload_rows", "bad_payload_days"):
        plan = _plan(QUERIES[name](spark, SF001)).lower()
        assert plan.count("parsejson") == 1 and "get_json_object" not in plan and "from_json" not in plan


def test_a_dimension_too_large_to_broadcast_is_joined_with_its_hot_key_split(spark):
    from tripmart.operators import enrich

    trips = spark.range(300_000).select(
        F.when(F.col("id") % 3 > 0, F.timestamp_seconds(F.lit(1704067200))).otherwise(F.timestamp_seconds(1704067200 + F.col("id") % 900 * 3600)).alias("pickup_ts"),
        F.col("id").alias("payload"), F.sha2(F.col("id").cast("string"), 256).alias("text"))
    hours = spark.range(900).select(F.timestamp_seconds(1704067200 + F.col("id") * 3600).alias("weather_hour_local"),
                                    *[F.col("id").cast("double").alias(v) for v in staging.HOURLY_VARIABLES])
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1000000", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "500000"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        joined = enrich.join_hourly(trips, hours, max_broadcast_rows=None)
        assert joined.agg(F.count("temperature_2m"), F.sum("payload")).first() == (300_000, 299_999 * 150_000)
        assert "SortMergeJoin" in _plan(joined)
        final = joined._jdf.queryExecution().executedPlan()
        joined._jdf.queryExecution().toRdd().count()
        assert "skew=true" in final.toString(), final.toString()
    finally:
        for key in settings:
            spark.conf.unset(key)
