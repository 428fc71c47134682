"""Findings, pivots, expectations and the end-to-end publishing run."""

from datetime import datetime

from pyspark.sql import functions as F

from tripmart.operators import analysis, expect, pivots
from tripmart.plans import medallion
from tripmart.sources import testdata as T
from tests.conftest import SF01

IMPACT = "day_type string, is_precipitation boolean, temp_bucket string, avg_trips_per_hour double"


def test_quarantine_rate_months_without_rejections_are_zero(spark):
    tagged = spark.createDataFrame(
        [(datetime(2026, 1, 5), None), (datetime(2026, 1, 6), "x"), (datetime(2026, 2, 1), None), (None, "null_timestamp")],
        "pickup_ts timestamp, rejection_reason string",
    )
    rows = {r.trip_month: tuple(r)[1:] for r in analysis.quarantine_rate_by_month(tagged).collect()}
    assert rows == {"2026-01": (2, 1, 50.0), "2026-02": (1, 0, 0.0), "unknown_month": (1, 1, 100.0)}


def test_month_report_and_reason_share(spark):
    trend = spark.createDataFrame(
        [("2026-04", "a", 1), ("2026-05", "a", 3), ("2026-05", "b", 7)],
        "trip_month string, rejection_reason string, quarantined_count bigint",
    )
    assert [tuple(r) for r in analysis.quarantine_for_month(trend, "2026-05").collect()] == [("b", 7), ("a", 3)]
    share = {(r.trip_month, r.rejection_reason): r.share_pct for r in analysis.reason_share_by_month(trend).collect()}
    assert share == {("2026-04", "a"): 25.0, ("2026-05", "a"): 75.0, ("2026-05", "b"): 100.0}
    matrix = pivots.pivot_month_reason(trend.union(spark.createDataFrame([("unknown_month", "a", 9)], trend.schema)))
    assert matrix.columns == ["trip_month", "a", "b"]
    assert [tuple(r) for r in matrix.collect()] == [("2026-04", 1, 0), ("2026-05", 3, 7)]


def test_mean_of_group_means_missing_flag_is_zero(spark):
    mart = spark.createDataFrame(
        [("weekday", False, "cold", 10.0), ("weekend", False, "cold", 13.3)], IMPACT
    )
    row = analysis.mean_of_group_means(mart).first()
    assert (row.dry_avg_trips_per_hour, row.wet_avg_trips_per_hour, row.change_pct) == (11.65, 0.0, -100.0)


def test_temp_by_daytype_keeps_absent_buckets(spark):
    mart = spark.createDataFrame(
        [("weekday", False, "cold", 10.0), ("weekday", True, "cold", 12.0), ("weekend", False, "warm", 5.0)], IMPACT
    )
    rows = [tuple(r) for r in analysis.temp_by_daytype(mart).collect()]
    assert rows == [("freezing", None, None), ("cold", 11.0, None), ("mild", None, None), ("warm", None, 5.0)]


def test_pivot_speed_grid(spark):
    speed = spark.createDataFrame(
        [(False, "cold", "weekday", 12.5, 3), (True, "cold", "weekday", 10.0, 2)],
        "is_precipitation boolean, temp_bucket string, day_type string, avg_speed_mph double, trip_count bigint",
    )
    rows = [tuple(r) for r in pivots.pivot_speed(speed, "weekday").collect()]
    assert rows == [
        ("weekday", "freezing", None, None), ("weekday", "cold", 12.5, 10.0),
        ("weekday", "mild", None, None), ("weekday", "warm", None, None),
    ]
    assert pivots.pivot_speed(speed).count() == 8


def test_pivot_hour_weekday_calendar_order(spark):
    mart = spark.createDataFrame([(8, "Sunday", 3), (8, "Monday", 2)], "hour_of_day int, weekday string, trip_count bigint")
    out = pivots.pivot_hour_weekday(mart)
    assert out.columns == ["hour_of_day", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
    assert tuple(out.first()) == (8, 2, None, None, None, None, None, 3)


def test_ratio_outliers_and_code_share_guard_zero(spark):
    trips = spark.createDataFrame(
        [(0.0, 50.0, 0), (0.5, 80.0, 0), (2.0, 10.0, 1), (None, 5.0, None)],
        "trip_distance double, total_amount double, payment_type int",
    )
    row = analysis.ratio_outliers(trips, threshold=100.0).first()
    assert (row.outlier_trips, row.total_trips, row.pct) == (1, 4, 25.0)
    share = analysis.code_share(trips, 0).first()
    assert (share.code_trips, share.total_trips, share.share_pct) == (2, 4, 50.0)
    counts = {r.payment_type: r.cnt for r in analysis.payment_code_counts(trips).collect()}
    assert counts == {0: 2, 1: 1, None: 1}


def test_expectations(spark):
    df = spark.createDataFrame([(1, "weekday"), (1, "holiday"), (None, None), (2, "weekend")], "k int, day_type string")
    assert expect.expect_not_null(df, "k").count() == 1
    assert [tuple(r) for r in expect.expect_unique(df, "k").collect()] == [(1, 2)]
    assert [tuple(r) for r in expect.expect_values(df, "day_type", ["weekday", "weekend"]).collect()] == [("holiday", 1)]
    assert expect.expect_match_rate(df, "k", 0.7).count() == 0       # 3 matched of 4: 3 < 2.8 is false
    assert expect.expect_match_rate(df, "k", 0.8).count() == 1       # 3 < 3.2 fails
    assert expect.expect_match_rate(df.filter("false"), "k", 0.95).count() == 0   # empty input passes
    suite = expect.run_expectations([("nn", expect.expect_not_null(df, "k")), ("u", expect.expect_unique(df, "day_type"))])
    assert {r.expectation: (r.failing_rows, r.passed) for r in suite.collect()} == {"nn": (1, False), "u": (0, True)}


def test_publish_all_end_to_end(spark):
    result = medallion.publish_all(
        T.raw_trips(spark, SF01), T.raw_hourly(spark, SF01), T.raw_zones(spark, SF01), T.trip_rules(),
        silver_db="silver_e2e", gold_db="gold_e2e", match_rate_threshold=0.6,
    )
    report = result.report.first()
    assert (report.total_rows, report.deduped_rows, report.valid_rows) == (10_104, 10_000, 8_455)
    breakdown = {r.rejection_reason: r.quarantined_count for r in result.breakdown.collect()}
    assert breakdown == {
        "null_timestamp": 68, "dropoff_before_pickup": 25, "pickup_outside_range": 1_028,
        "non_positive_distance": 153, "negative_total_amount": 271,
    }
    assert set(result.marts) == {
        "trips_by_hour_weekday", "daily_weather_ridership", "weather_impact", "demand_by_borough",
        "payment_mix", "revenue_efficiency_by_hour", "weather_speed_impact", "dq_quarantine_trend",
    }
    assert spark.table("gold_e2e.weather_impact").count() == 16
    assert spark.table("gold_e2e.payment_mix").count() == 8
    checks = {r.expectation: r.passed for r in result.expectations.collect()}
    assert len(checks) == 16 and all(checks.values())
    assert spark.table("silver_e2e.trips_checked").filter(F.col("_gate_status") == "valid").count() == 8_455


def test_monthly_files_to_gold(spark, scratch):
    """Monthly files -> idempotent bronze load (string ingest metadata) -> gate -> marts."""
    import os

    from tripmart.sources import ingest

    raw = T.raw_trips(spark, SF01)
    src = os.path.join(scratch, "landing")
    # two deliveries stand in for two monthly files; the second re-sends some rows
    raw.filter("_ingest_batch = 0").drop("_ingest_batch").write.parquet(os.path.join(src, "trips_2024-01.parquet"))
    raw.filter("_ingest_batch = 1").drop("_ingest_batch").write.parquet(os.path.join(src, "trips_2024-02.parquet"))
    bronze_path = os.path.join(scratch, "bronze")
    loaded = ingest.load_months(spark, ["2024-01", "2024-02"], os.path.join(src, "trips_{month}.parquet"), bronze_path)
    assert loaded.loaded == ["2024-01", "2024-02"]
    bronze = spark.read.parquet(bronze_path)
    assert {"_source_file", "_ingested_at", "_month"} <= set(bronze.columns)

    result = medallion.publish_all(
        bronze, T.raw_hourly(spark, SF01), T.raw_zones(spark, SF01), T.trip_rules(),
        silver_db="silver_files", gold_db="gold_files",
    )
    report = result.report.first()
    assert (report.total_rows, report.deduped_rows, report.valid_rows) == (10_104, 10_000, 8_455)
    silver = spark.table("silver_files.trips_checked")
    # every survivor keeps whole metadata from one delivered copy
    assert silver.filter(F.col("_source_file").isNull() | F.col("_month").isNull()).count() == 0
    months = {r._month for r in silver.select("_month").distinct().collect()}
    # most rows exist only in the first delivery; re-sent rows keep one deterministic copy
    assert "2024-01" in months and months <= {"2024-01", "2024-02"}
    assert spark.table("gold_files.weather_impact").count() == 16


def test_readme_flow_from_files(spark, scratch):
    """read_months + read_hourly (nanosecond file) + read_zone_csv -> publish_all, as in the README."""
    import os

    from tripmart.operators import staging
    from tripmart.sources import ingest

    raw = T.raw_trips(spark, SF01)
    for batch, month in ((0, "2024-01"), (1, "2024-02")):
        raw.filter(F.col("_ingest_batch") == batch).drop("_ingest_batch").write.parquet(
            os.path.join(scratch, f"trips_{month}.parquet")
        )
    hourly_path = os.path.join(scratch, "weather_hourly.parquet")
    T.raw_hourly(spark, SF01).toPandas().to_parquet(hourly_path, index=False)   # datetime64[ns] -> NANOS
    zones_path = os.path.join(scratch, "zones_csv")
    T.raw_zones(spark, SF01).coalesce(1).write.option("header", True).csv(zones_path)

    trips = ingest.read_months(spark, ["2024-01", "2024-02"], os.path.join(scratch, "trips_{month}.parquet"))
    hourly = ingest.read_hourly(spark, hourly_path, nanos=True)
    zones = ingest.read_zone_csv(spark, zones_path)
    run = medallion.publish_all(trips, hourly, zones, T.trip_rules(), silver_db="silver_readme", gold_db="gold_readme",
                                match_rate_threshold=0.6)

    report = run.report.first()
    assert (report.total_rows, report.deduped_rows, report.valid_rows) == (10_104, 10_000, 8_455)
    assert all(r.passed for r in run.expectations.collect())
    expected = {tuple(r) for r in T.raw_hourly(spark, SF01).collect() if r.weather_hour_local is not None}
    assert {tuple(r) for r in staging.stage_weather(hourly).collect()} == expected
    assert spark.table("gold_readme.weather_impact").count() == 16
