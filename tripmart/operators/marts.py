"""Gold marts over the enriched trip fact (O-34..O-37, O-43..O-53).

Each mart is one hash aggregate with a small output (hours, days, labels), so
Spark's partial aggregation shrinks every map task's output to at most one
row per group before the shuffle.  Averages of per-trip ratios (tip share,
revenue per minute, speed) are means of ratios, not ratios of sums.

Sums and means of amounts, precipitation, temperature, durations and per-trip
ratios are computed exactly (``functions.exact``), so a published digit never
depends on how the input happened to be split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.functions import exprs as X
from tripmart.functions.exact import exact_avg, exact_avg_minutes, exact_avg_scaled, exact_sum, rounded_ratio


def _n() -> F.Column:
    return F.count(F.lit(1))


def _seconds() -> F.Column:
    """Trip duration in whole seconds, the exact numerator of ``trip_minutes``."""
    return X.seconds_between("pickup_ts", "dropoff_ts")


def with_conditions(df: DataFrame) -> DataFrame:
    """Add ``day_type`` and ``temp_bucket`` (NULL temperature -> ``warm``)."""
    return df.withColumns({
        "day_type": X.day_type("weekday"),
        "temp_bucket": X.temperature_bucket("temperature_2m"),
    })


def trips_by_hour_weekday(itw: DataFrame) -> DataFrame:
    """Trips, mean fare and mean minutes per hour of day and weekday (O-43)."""
    return itw.groupBy(X.hour_of_day("pickup_hour").alias("hour_of_day"), "weekday").agg(
        _n().alias("trip_count"),
        exact_avg(F.col("total_amount"), 2).alias("avg_fare"),
        exact_avg_minutes(_seconds(), 1).alias("avg_trip_minutes"),
    )


def daily_weather_ridership(itw: DataFrame) -> DataFrame:
    """Per day: trips, revenue, trip-weighted temperature and precipitation (O-44).

    ``total_precip_mm`` adds each trip's hourly precipitation, so it weights
    rainfall by trips rather than measuring it.
    """
    return (
        itw.groupBy(X.calendar_date("pickup_ts").alias("trip_date"))
        .agg(
            _n().alias("trip_count"),
            exact_sum(F.col("total_amount"), 2).alias("total_revenue"),
            exact_avg(F.col("temperature_2m"), 1).alias("avg_temp_c"),
            exact_sum(F.col("precipitation"), 1).alias("total_precip_mm"),
        )
        .orderBy("trip_date")
    )


def weather_impact(itw: DataFrame) -> DataFrame:
    """Trips per distinct active hour by day type, precipitation and temperature (O-45, O-51).

    The denominator counts hours that have at least one trip in the group;
    the ratio of the two counts is rounded exactly (NULL for a group without
    any hour, instead of an ANSI division error).
    """
    return (
        with_conditions(itw)
        .groupBy("day_type", "is_precipitation", "temp_bucket")
        .agg(
            _n().alias("total_trips"),
            F.count_distinct("pickup_hour").alias("distinct_hours"),
        )
        .withColumn(
            "avg_trips_per_hour",
            rounded_ratio(F.col("total_trips"), F.col("distinct_hours"), 1),
        )
        .orderBy("day_type", "is_precipitation", "temp_bucket")
    )


def demand_by_borough(itw: DataFrame) -> DataFrame:
    """Trips and revenue per pickup borough and hour, known boroughs only (O-34, O-46)."""
    return (
        itw.filter(F.col("pickup_borough").isNotNull())
        .groupBy("pickup_borough", X.hour_of_day("pickup_hour").alias("hour_of_day"))
        .agg(
            _n().alias("trip_count"),
            exact_avg(F.col("total_amount"), 2).alias("avg_fare"),
            exact_sum(F.col("total_amount"), 2).alias("total_revenue"),
        )
        .orderBy("pickup_borough", "hour_of_day")
    )


def dq_quarantine_trend(stg_quarantine: DataFrame) -> DataFrame:
    """Quarantined rows per month label (or ``unknown_month``) and reason (O-47)."""
    return (
        stg_quarantine.groupBy(X.month_start("pickup_ts").alias("month_start"), "rejection_reason")
        .agg(_n().alias("quarantined_count"))
        .select(
            X.month_label_or_unknown("month_start").alias("trip_month"), "rejection_reason", "quarantined_count"
        )
        .orderBy("trip_month", "rejection_reason")
    )


def payment_mix(itw: DataFrame) -> DataFrame:
    """Per payment label: trips, mean fare and tip, mean tip share of fare in % (O-48, O-52, O-53)."""
    return (
        itw.groupBy(X.payment_label("payment_type").alias("payment_type_label"))
        .agg(
            _n().alias("trip_count"),
            exact_avg(F.col("total_amount"), 2).alias("avg_fare"),
            exact_avg(F.col("tip_amount"), 2).alias("avg_tip"),
            exact_avg_scaled(X.ratio_where_positive("tip_amount", "fare_amount"), 100, 1).alias("avg_tip_pct"),
        )
        .orderBy(F.desc("trip_count"))
    )


def revenue_efficiency_by_hour(itw: DataFrame) -> DataFrame:
    """Per hour, trips lasting strictly between 0 and 180 minutes (O-35, O-49)."""
    minutes = F.col("trip_minutes")
    return (
        itw.filter((minutes > 0) & (minutes < 180))
        .groupBy(X.hour_of_day("pickup_hour").alias("hour_of_day"))
        .agg(
            exact_avg_minutes(_seconds(), 1).alias("avg_trip_minutes"),
            exact_avg_scaled(X.ratio_where_positive("total_amount", "trip_minutes"), 1, 2).alias("avg_revenue_per_minute"),
            exact_sum(F.col("total_amount"), 0).alias("total_revenue"),
            _n().alias("trip_count"),
        )
        .orderBy("hour_of_day")
    )


def weather_speed_impact(itw: DataFrame) -> DataFrame:
    """Mean speed by precipitation, temperature and day type (O-36, O-37, O-50).

    Trips of 1..180 minutes (inclusive) with positive distance; the speed
    filter ``< 60`` is applied after derivation, so NULL and NaN speeds drop.
    """
    minutes = F.col("trip_minutes")
    return (
        with_conditions(
            itw.filter(minutes.between(1, 180) & (F.col("trip_distance") > 0))
        )
        .withColumn("speed_mph", X.speed_mph("trip_distance", "trip_minutes"))
        .filter(F.col("speed_mph") < 60)
        .groupBy("is_precipitation", "temp_bucket", "day_type")
        .agg(
            exact_avg_scaled(F.col("speed_mph"), 1, 1).alias("avg_speed_mph"),
            _n().alias("trip_count"),
        )
        .orderBy("day_type", "temp_bucket", "is_precipitation")
    )


MARTS = {
    "trips_by_hour_weekday": trips_by_hour_weekday,
    "daily_weather_ridership": daily_weather_ridership,
    "weather_impact": weather_impact,
    "demand_by_borough": demand_by_borough,
    "payment_mix": payment_mix,
    "revenue_efficiency_by_hour": revenue_efficiency_by_hour,
    "weather_speed_impact": weather_speed_impact,
}
"""The seven marts built from the enriched fact; ``dq_quarantine_trend`` reads the quarantine."""
