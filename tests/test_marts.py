"""Enrichment and mart semantics on edge rows; single-pass rollup equals the per-mart plans."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tripmart.operators import enrich, marts, staging
from tripmart.plans import joins, medallion, rollup
from tripmart.sources import testdata as T
from tests.conftest import SF01

TRIPS = (
    "vendor_id int, pickup_ts timestamp, dropoff_ts timestamp, passenger_count bigint, trip_distance double, "
    "pickup_location_id int, dropoff_location_id int, payment_type int, fare_amount double, tip_amount double, "
    "total_amount double"
)
WEATHER = (
    "weather_hour_local timestamp, temperature_2m double, precipitation double, snowfall double, "
    "wind_speed_10m double, weather_code bigint"
)
ZONES = "location_id int, borough string, zone string, service_zone string"
H = datetime(2026, 3, 2, 8, 0, 0)  # a Monday


def trip(pu, minutes, dist=1.0, loc=1, pay=1, fare=10.0, tip=1.0, total=12.0):
    return (1, pu, pu + timedelta(minutes=minutes), 1, dist, loc, 2, pay, fare, tip, total)


@pytest.fixture()
def dims(spark):
    weather = spark.createDataFrame(
        [
            (H, 0.0, 0.1, 0.0, 3.0, 1),                                 # 0 C is cold, 0.1 mm is dry
            (H + timedelta(hours=1), 10.0, 0.2, 0.0, 3.0, 1),           # mild, wet
            (H + timedelta(hours=2), 20.0, 0.0, 0.0, 3.0, 1),           # warm
            (H + timedelta(hours=2), -1.0, 0.0, 0.0, 3.0, 1),           # duplicated hour: fans out
        ],
        WEATHER,
    )
    zones = spark.createDataFrame([(1, "Manhattan", "Midtown", "Yellow Zone")], ZONES)
    return weather, zones


def test_enrichment_left_joins_and_fan_out(spark, dims):
    weather, zones = dims
    trips = spark.createDataFrame(
        [trip(H + timedelta(minutes=5), 10), trip(H + timedelta(hours=2, minutes=5), 10),
         trip(H + timedelta(hours=5), 10, loc=99)],
        TRIPS,
    )
    itw = enrich.enrich_trips(trips, weather, zones)
    rows = itw.collect()
    assert len(rows) == 4                                  # the duplicated hour doubles its trip
    no_context = [r for r in rows if r.pickup_location_id == 99][0]
    assert no_context.temperature_2m is None and no_context.pickup_borough is None
    assert no_context.is_precipitation is False and no_context.weekday == "Monday"
    impact = {(r.temp_bucket, r.is_precipitation): r.total_trips for r in marts.weather_impact(itw).collect()}
    assert impact == {("cold", False): 1, ("warm", False): 2, ("freezing", False): 1}


def test_minutes_speed_and_thresholds(spark, dims):
    weather, zones = dims
    base = H + timedelta(hours=1)
    trips = spark.createDataFrame(
        [
            trip(base, 0),                                  # 0 min: out of revenue and speed windows
            trip(base, 1, dist=0.5),                        # 1 min, 30 mph: in both
            trip(base, 180, dist=3.0),                      # 180 min: speed yes (inclusive), revenue no
            trip(base, 10, dist=10.0),                      # exactly 60 mph: dropped by speed < 60
            trip(base, 10, dist=0.0),                       # zero distance: not in the speed mart
        ],
        TRIPS,
    )
    itw = enrich.enrich_trips(trips, weather, zones)
    rev = marts.revenue_efficiency_by_hour(itw).collect()
    assert [(r.hour_of_day, r.trip_count) for r in rev] == [(9, 3)]
    speed = marts.weather_speed_impact(itw).collect()
    assert [(r.temp_bucket, r.is_precipitation, r.trip_count, r.avg_speed_mph) for r in speed] == [
        ("mild", True, 2, 15.5)
    ]


def test_trip_minutes_truncates_fractional_seconds(spark):
    df = spark.createDataFrame(
        [(datetime(2026, 1, 1, 0, 0, 0, 100000), datetime(2026, 1, 1, 0, 1, 30, 900000))],
        "pickup_ts timestamp, dropoff_ts timestamp",
    )
    assert enrich.add_trip_attributes(df.withColumn("precipitation", F.lit(None).cast("double"))).first().trip_minutes == 1.5


def test_payment_labels_and_tip_ratio(spark, dims):
    weather, zones = dims
    trips = spark.createDataFrame(
        [
            trip(H, 5, pay=None, fare=0.0, tip=1.0),        # NULL code -> Other; fare 0 -> ratio skipped
            trip(H, 5, pay=7, fare=10.0, tip=2.0),          # unknown code -> Other
            trip(H, 5, pay=0, fare=10.0, tip=1.0),
            trip(H, 5, pay=2, fare=10.0, tip=0.0),
        ],
        TRIPS,
    )
    mix = {r.payment_type_label: r for r in marts.payment_mix(enrich.enrich_trips(trips, weather, zones)).collect()}
    assert set(mix) == {"Other", "Undocumented code (0)", "Cash"}
    assert mix["Other"].trip_count == 2 and mix["Other"].avg_tip_pct == 20.0 and mix["Other"].avg_tip == 1.5
    assert mix["Undocumented code (0)"].avg_tip_pct == 10.0


def test_broadcast_only_within_bound(spark, dims):
    weather, _ = dims
    assert joins.within_bound([weather], 4) == [True] and joins.within_bound([weather], 3) == [False]
    assert joins.within_bound([weather], 4, max_bytes=10) == [False]
    hinted = joins.broadcast_if_bounded(weather, 10)
    unhinted = joins.broadcast_if_bounded(weather, 2)
    assert "ResolvedHint" in hinted._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" not in unhinted._jdf.queryExecution().analyzed().toString()


def test_enrichment_without_broadcast_gives_same_rows(spark):
    gate = medallion.gate(T.raw_trips(spark, SF01), T.trip_rules())
    hourly, zones = T.raw_hourly(spark, SF01), T.raw_zones(spark, SF01)
    a = medallion.enriched(gate.valid, hourly, zones)
    b = medallion.enriched(gate.valid, hourly, zones, max_broadcast_rows=1)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize("name", sorted(rollup.ROLLUP_MARTS))
def test_rollup_marts_equal_per_mart_plans(spark, name):
    gate = medallion.gate(T.raw_trips(spark, SF01), T.trip_rules())
    hourly, zones = T.raw_hourly(spark, SF01), T.raw_zones(spark, SF01)
    expected = marts.MARTS[name](medallion.enriched(gate.valid, hourly, zones))
    built = rollup.build_marts(
        staging.stage_trips(gate.valid), staging.stage_weather(hourly), staging.stage_zones(zones), materialize=False
    )[name]
    assert built.columns == expected.columns
    key = [c for c, t in expected.dtypes if t not in ("double",)]
    exp = sorted((tuple(r) for r in expected.collect()), key=lambda r: str([r[expected.columns.index(k)] for k in key]))
    got = sorted((tuple(r) for r in built.collect()), key=lambda r: str([r[built.columns.index(k)] for k in key]))
    assert len(exp) == len(got)
    for e, g in zip(exp, got):
        assert e == g  # every published column is exact, so the two plans agree digit for digit


def test_weekday_name_matches_date_format(spark):
    from tripmart.functions import exprs as X

    df = spark.range(0, 24 * 15).select(F.timestamp_add("HOUR", F.col("id"), F.lit("2026-02-25").cast("timestamp")).alias("ts"))
    mismatched = df.filter(X.weekday_name("ts") != F.date_format("ts", "EEEE")).count()
    nulls = df.select(X.weekday_name(F.lit(None).cast("timestamp")).alias("w")).first().w
    assert mismatched == 0 and nulls is None


def test_within_bound_checks_several_frames_in_one_job(spark, dims):
    weather, zones = dims
    assert joins.within_bound([weather, zones, weather.filter("false")], 3) == [False, True, True]
    hinted = joins.broadcast_all_if_bounded([weather, zones], 3)
    assert "ResolvedHint" not in hinted[0]._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" in hinted[1]._jdf.queryExecution().analyzed().toString()


def test_hot_hour_without_broadcast_uses_skew_join(spark):
    """A third of the trips in one hour, dimension over the bound: AQE splits the hot partition."""
    base = datetime(2026, 3, 2, 0, 0, 0)
    rows = [trip(base + timedelta(hours=5, seconds=i % 3000), 10) for i in range(3000)]
    rows += [trip(base + timedelta(hours=i % 24, minutes=i % 50), 10) for i in range(6000)]
    trips = spark.createDataFrame(rows, TRIPS).repartition(8)
    weather = spark.createDataFrame(
        [(base + timedelta(hours=h), float(h), 0.0, 0.0, 1.0, 1) for h in range(24)], WEATHER
    )
    zones = spark.createDataFrame([(1, "Manhattan", "Midtown", "Yellow Zone")], ZONES)
    conf = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1024",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        itw = enrich.enrich_trips(trips, weather, zones, max_broadcast_rows=1)
        assert len(itw.collect()) == 9000                   # runs itw's own adaptive plan
        final_plan = itw._jdf.queryExecution().executedPlan().toString()
        counts = {r.hour_of_day: r.trip_count for r in marts.trips_by_hour_weekday(itw).collect()}
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    # the 24-row hourly series is over the bound of 1: a shuffle join, split where it is skewed
    smj = [line for line in final_plan.splitlines() if "SortMergeJoin" in line and "pickup_hour" in line]
    assert smj and "skew=true" in smj[0]
    assert counts[5] == 3000 + 250 and sum(counts.values()) == 9000


@pytest.mark.parametrize("trips", [10**10, 10**12])
def test_rollup_marts_hold_very_many_trips_per_label(spark, trips):
    """A rollup whose cells stand for ``trips`` trips of $10 and 600 s each."""
    cell = spark.range(1, 2).select(
        F.timestamp_seconds(F.lit(1_700_000_000)).alias("pickup_hour"), F.lit(1).alias("pickup_location_id"),
        F.lit(1).alias("payment_type"), (F.lit(trips) * F.col("id")).alias("n"),
    )
    for name, unit in (("amount_units", 10**7), ("tip_units", 10**6), ("tip_ratio_units", 10**8), ("rev_per_minute_units", 10**9),
                       ("rev_amount_units", 10**7), ("speed_units", 2 * 10**10), ("seconds", 600), ("rev_seconds", 600)):
        cell = cell.withColumn(f"{name}_sum", (F.lit(unit).cast("decimal(38,0)") * F.col("n")).cast("decimal(38,0)"))
        cell = cell.withColumn(f"{name}_n", F.col("n")).withColumn(f"{name}_special", F.lit(None).cast("double"))
    cell = cell.withColumn("rev_n", F.col("n")).withColumn("speed_n", F.col("n"))
    joined = cell.select(
        "*", F.lit(5.0).alias("temperature_2m"), F.lit(0.0).alias("precipitation"), F.lit("Monday").alias("weekday"),
        F.lit(False).alias("is_precipitation"), F.lit("X").alias("pickup_borough"),
    )
    payment = rollup.payment_mix(joined).first()
    assert (payment.trip_count, payment.avg_fare, payment.avg_tip, payment.avg_tip_pct) == (trips, 10.0, 1.0, 10.0)
    revenue = rollup.revenue_efficiency_by_hour(joined).first()
    assert (revenue.avg_trip_minutes, revenue.avg_revenue_per_minute, revenue.total_revenue) == (10.0, 1.0, 10.0 * trips)
    assert rollup.weather_speed_impact(joined).first().avg_speed_mph == 20.0
    daily = rollup.daily_weather_ridership(joined).first()
    assert (daily.total_revenue, daily.avg_temp_c) == (10.0 * trips, 5.0)
