"""All enriched marts from one scan: an hourly rollup with the joins after the aggregate.

Every mart over the enriched fact groups by attributes of the pickup hour
(hour of day, weekday, date, the hour's weather), of the pickup location
(borough) or of the payment code, and every measure is a count, a sum or a
mean, which decomposes into sums and counts.  So instead of joining each trip
to the dimensions and scanning the fact once per mart:

1. one aggregate of the staged trips at the grain
   (``pickup_hour``, ``pickup_location_id``, ``payment_type``) carries the
   partial sums and counts of every mart, with the per-trip filters of the
   revenue and speed marts folded in as conditional sums.  Map-side partial
   aggregation means a hot cell never reaches a single reducer as raw rows;
2. the rollup (bounded by hours x locations x payment codes, independent of
   the trip count) is materialised once with a reliable checkpoint;
3. the hourly context and the location lookup are left-joined to the rollup,
   not to the trips, so the joins touch one row per cell, whichever join the
   planner picks.  A duplicated
   dimension key multiplies the cell exactly as it would multiply its trips;
4. each mart is a small aggregate over the joined rollup.

The results equal the per-mart functions of ``operators.marts`` up to the
association order of floating-point sums.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.functions import exprs as X
from tripmart.functions.exact import RATIO_DIGITS, UNIT_DIGITS, rounded_ratio, special, units, wide
from tripmart.operators import observed
from tripmart.operators.marts import with_conditions
from tripmart.operators.staging import HOURLY_VARIABLES
from tripmart.session import ensure_checkpoint_dir, stored

GRAIN = ("pickup_hour", "pickup_location_id", "payment_type")


def _sum_count(prefix: str, value: Column) -> list[Column]:
    return [F.sum(value).alias(f"{prefix}_sum"), F.count(value).alias(f"{prefix}_n")]


def _unit_sums(prefix: str, value: Column, digits: int = UNIT_DIGITS) -> list[Column]:
    """Sum and count of the units of ``value``, and the sum of its NaN and infinite values (NULL without any)."""
    return [*_sum_count(prefix, units(value, digits)), F.sum(special(value)).alias(f"{prefix}_special")]


def hourly_rollup(stg_trips: DataFrame, reason_col: str | None = None) -> DataFrame:
    """Partial sums and counts of every enriched mart per (pickup hour, location, payment code).

    Amounts are carried as exact integer units and durations as whole
    seconds (``functions.exact``), so the marts derived from the rollup
    publish the same digits as the per-trip plans.  With ``reason_col`` the
    trips are gated ones: the reason joins the grain, and measures are taken of
    the valid trips (reason NULL) only.
    """
    seconds = X.seconds_between("pickup_ts", "dropoff_ts")
    by = [*GRAIN, *([reason_col] if reason_col else [])]
    if reason_col:
        ok = F.col(reason_col).isNull()
        measures = ("trip_distance", "fare_amount", "tip_amount", "total_amount")
        stg_trips = stg_trips.withColumns({c: F.when(ok, F.col(c)) for c in measures})
        seconds = F.when(ok, seconds)
    t = stg_trips.select(
        X.hour_bucket("pickup_ts").alias("pickup_hour"),
        "pickup_location_id",
        "payment_type",
        *by[len(GRAIN):],
        F.col("dropoff_ts").isNull().alias("no_dropoff"),
        "trip_distance",
        "fare_amount",
        "tip_amount",
        "total_amount",
        seconds.alias("trip_seconds"),
        (seconds / 60).alias("trip_minutes"),
    )
    m, amount, secs = F.col("trip_minutes"), F.col("total_amount"), F.col("trip_seconds")
    in_revenue_window = (m > 0) & (m < 180)
    speed = X.speed_mph("trip_distance", "trip_minutes")
    in_speed_window = m.between(1, 180) & (F.col("trip_distance") > 0) & (speed < 60)
    return t.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if("no_dropoff").alias("no_dropoff_n"),
        *_unit_sums("amount_units", amount),
        *_sum_count("seconds", secs.cast("decimal(28,0)")),
        *_unit_sums("tip_units", F.col("tip_amount")),
        *_unit_sums("tip_ratio_units", X.ratio_where_positive("tip_amount", "fare_amount"), RATIO_DIGITS),
        F.count_if(in_revenue_window).alias("rev_n"),
        *_sum_count("rev_seconds", F.when(in_revenue_window, secs.cast("decimal(28,0)"))),
        *_unit_sums("rev_per_minute_units", F.when(in_revenue_window, X.ratio_where_positive(amount, m)), RATIO_DIGITS),
        *_unit_sums("rev_amount_units", F.when(in_revenue_window, amount)),
        F.count_if(in_speed_window).alias("speed_n"),
        *_unit_sums("speed_units", F.when(in_speed_window, speed), RATIO_DIGITS),
    )


def enrich_rollup(rollup: DataFrame, stg_weather: DataFrame, stg_zones: DataFrame) -> DataFrame:
    """Left-join the hourly context and the location lookup to the rollup cells."""
    weather = stg_weather.select(F.col("weather_hour_local").alias("w_hour"), *HOURLY_VARIABLES)
    zones = stg_zones.select(
        F.col("location_id").alias("z_id"), F.col("borough").alias("pickup_borough"), F.col("zone").alias("pickup_zone")
    )
    joined = (
        rollup.join(weather, rollup.pickup_hour == weather.w_hour, "left")
        .join(zones, rollup.pickup_location_id == zones.z_id, "left")
        .drop("w_hour", "z_id")
    )
    return joined.withColumns({
        "weekday": X.weekday_name("pickup_hour"),
        "is_precipitation": X.is_precipitation("precipitation"),
    })


def _or_special(prefix: str, exact: Column) -> Column:
    """The exact result, unless NaN or infinite values took part."""
    return F.coalesce(F.sum(f"{prefix}_special"), exact)


def _exact_avg(prefix: str, digits: int, scale: int = 1, unit_digits: int = UNIT_DIGITS) -> Column:
    """Exact ``round(mean * scale, digits)`` from a units sum and its count."""
    count = wide(F.sum(f"{prefix}_n")) * (10 ** unit_digits)
    return _or_special(prefix, rounded_ratio(wide(F.sum(f"{prefix}_sum")) * scale, count, digits))


def _exact_ratio_avg(prefix: str, scale: int, digits: int) -> Column:
    """The same of a per-trip ratio carried in nanounits."""
    return _exact_avg(prefix, digits, scale, RATIO_DIGITS)


def _exact_total(prefix: str, digits: int) -> Column:
    return _or_special(prefix, rounded_ratio(F.sum(f"{prefix}_sum"), F.lit(10 ** UNIT_DIGITS), digits))


def _exact_minutes(prefix: str, digits: int) -> Column:
    return rounded_ratio(F.sum(f"{prefix}_sum"), wide(F.sum(f"{prefix}_n")) * 60, digits)


def _total_trips() -> Column:
    return F.sum("n").cast("bigint")


def trips_by_hour_weekday(r: DataFrame) -> DataFrame:
    return r.groupBy(X.hour_of_day("pickup_hour").alias("hour_of_day"), "weekday").agg(
        _total_trips().alias("trip_count"),
        _exact_avg("amount_units", 2).alias("avg_fare"),
        _exact_minutes("seconds", 1).alias("avg_trip_minutes"),
    )


def daily_weather_ridership(r: DataFrame) -> DataFrame:
    """Trip-weighted hourly measures: each cell's value counts once per trip in it."""
    temp, rain, n = F.col("temperature_2m"), F.col("precipitation"), wide(F.col("n"))
    return (
        r.groupBy(X.calendar_date("pickup_hour").alias("trip_date"))
        .agg(
            _total_trips().alias("trip_count"),
            _exact_total("amount_units", 2).alias("total_revenue"),
            F.coalesce(F.sum(special(temp)), rounded_ratio(
                F.sum(units(temp) * n), wide(F.sum(F.when(temp.isNotNull(), n))) * (10 ** UNIT_DIGITS), 1
            )).alias("avg_temp_c"),
            F.coalesce(F.sum(special(rain)), rounded_ratio(
                F.sum(units(rain) * n), F.lit(10 ** UNIT_DIGITS), 1
            )).alias("total_precip_mm"),
        )
        .orderBy("trip_date")
    )


def weather_impact(r: DataFrame) -> DataFrame:
    return (
        with_conditions(r)
        .groupBy("day_type", "is_precipitation", "temp_bucket")
        .agg(
            _total_trips().alias("total_trips"),
            F.count_distinct("pickup_hour").alias("distinct_hours"),
        )
        .withColumn(
            "avg_trips_per_hour",
            rounded_ratio(F.col("total_trips"), F.col("distinct_hours"), 1),
        )
        .orderBy("day_type", "is_precipitation", "temp_bucket")
    )


def demand_by_borough(r: DataFrame) -> DataFrame:
    return (
        r.filter(F.col("pickup_borough").isNotNull())
        .groupBy("pickup_borough", X.hour_of_day("pickup_hour").alias("hour_of_day"))
        .agg(
            _total_trips().alias("trip_count"),
            _exact_avg("amount_units", 2).alias("avg_fare"),
            _exact_total("amount_units", 2).alias("total_revenue"),
        )
        .orderBy("pickup_borough", "hour_of_day")
    )


def payment_mix(r: DataFrame) -> DataFrame:
    return (
        r.groupBy(X.payment_label("payment_type").alias("payment_type_label"))
        .agg(
            _total_trips().alias("trip_count"),
            _exact_avg("amount_units", 2).alias("avg_fare"),
            _exact_avg("tip_units", 2).alias("avg_tip"),
            _exact_ratio_avg("tip_ratio_units", 100, 1).alias("avg_tip_pct"),
        )
        .orderBy(F.desc("trip_count"))
    )


def revenue_efficiency_by_hour(r: DataFrame) -> DataFrame:
    return (
        r.filter(F.col("rev_n") > 0)
        .groupBy(X.hour_of_day("pickup_hour").alias("hour_of_day"))
        .agg(
            _exact_minutes("rev_seconds", 1).alias("avg_trip_minutes"),
            _exact_ratio_avg("rev_per_minute_units", 1, 2).alias("avg_revenue_per_minute"),
            _exact_total("rev_amount_units", 0).alias("total_revenue"),
            F.sum("rev_n").cast("bigint").alias("trip_count"),
        )
        .orderBy("hour_of_day")
    )


def weather_speed_impact(r: DataFrame) -> DataFrame:
    return (
        with_conditions(r.filter(F.col("speed_n") > 0))
        .groupBy("is_precipitation", "temp_bucket", "day_type")
        .agg(
            _exact_ratio_avg("speed_units", 1, 1).alias("avg_speed_mph"),
            F.sum("speed_n").cast("bigint").alias("trip_count"),
        )
        .orderBy("day_type", "temp_bucket", "is_precipitation")
    )


ROLLUP_MARTS = {
    "trips_by_hour_weekday": trips_by_hour_weekday,
    "daily_weather_ridership": daily_weather_ridership,
    "weather_impact": weather_impact,
    "demand_by_borough": demand_by_borough,
    "payment_mix": payment_mix,
    "revenue_efficiency_by_hour": revenue_efficiency_by_hour,
    "weather_speed_impact": weather_speed_impact,
}


def mart_keys(r: DataFrame, mart: str) -> DataFrame:
    """The key columns of a mart's rows, without its measures: what the tests of the keys read."""
    if mart == "daily_weather_ridership":
        return r.select(X.calendar_date("pickup_hour").alias("trip_date")).distinct()
    if mart == "revenue_efficiency_by_hour":
        return r.filter(F.col("rev_n") > 0).select(X.hour_of_day("pickup_hour").alias("hour_of_day")).distinct()
    if mart == "weather_impact":
        return with_conditions(r).select("day_type", "is_precipitation", "temp_bucket").distinct()
    if mart == "weather_speed_impact":
        return with_conditions(r.filter(F.col("speed_n") > 0)).select("is_precipitation", "temp_bucket", "day_type").distinct()
    raise ValueError(f"no tested keys in {mart!r}")


def match_rate(enriched: DataFrame, threshold: float, column: str = "temperature_2m") -> DataFrame:
    """Share of trips whose hour found context, from the joined rollup (same columns as ``expect.match_rate``)."""
    counts = enriched.agg(
        F.sum("n").cast("bigint").alias("total"),
        F.coalesce(F.sum(F.when(F.col(column).isNotNull(), F.col("n"))), F.lit(0)).cast("bigint").alias("matched_rows"),
    )
    return counts.select(
        "total",
        "matched_rows",
        rounded_ratio(F.col("matched_rows"), F.col("total"), 4).alias("match_rate"),
        F.lit(float(threshold)).alias("threshold"),
        (~(F.col("matched_rows") < F.col("total") * float(threshold))).alias("passed"),
    )


def enriched_rollup(stg_trips: DataFrame, stg_weather: DataFrame, stg_zones: DataFrame, materialize: bool = True) -> DataFrame:
    """The rollup of the staged trips joined to both dimensions.

    With ``materialize`` the rollup is written once to the session's
    checkpoint directory (a shared file system on a cluster), which also cuts
    the lineage back to the fact scan; everything built on it reads that copy.
    Without it nothing runs until the result is used; several marts in one
    plan still share its shuffle through Spark's exchange reuse.
    """
    rollup = hourly_rollup(stg_trips)
    if materialize:
        ensure_checkpoint_dir(rollup.sparkSession)
        rollup = rollup.checkpoint(eager=True)
    return enrich_rollup(rollup, stg_weather, stg_zones)


def match_counts(column: str = "temperature_2m") -> dict[str, Column]:
    """Trips in all and trips whose hour found context, as aggregates of the joined cells."""
    return {"total": F.sum("n"), "matched_rows": F.sum(F.when(F.col(column).isNotNull(), F.col("n")))}


def failing_match_rate(counts: Mapping[str, int], threshold: float) -> int:
    """1 if fewer than ``threshold`` of the trips matched, else 0."""
    return int(counts["matched_rows"] < counts["total"] * float(threshold))


def stored_enriched(
    cells: DataFrame, stg_weather: DataFrame, stg_zones: DataFrame, more: Mapping[str, Column] | None = None,
    reason_col: str = "rejection_reason",
) -> tuple[DataFrame, observed.Counts]:
    """The valid cells of gated trips joined to both dimensions, stored once for all marts, with the match counts of that write."""
    valid = cells.filter(F.col(reason_col).isNull()).drop(reason_col)
    joined, counts = observed.watch(enrich_rollup(valid, stg_weather, stg_zones), {**match_counts(), **(more or {})})
    return stored(joined, "enriched_cells"), counts


def build_marts(stg_trips: DataFrame, stg_weather: DataFrame, stg_zones: DataFrame, materialize: bool = True) -> dict[str, DataFrame]:
    """The seven enriched marts from one scan of the staged trips."""
    enriched = enriched_rollup(stg_trips, stg_weather, stg_zones, materialize)
    return {name: fn(enriched) for name, fn in ROLLUP_MARTS.items()}


def quarantine_trend(cells: DataFrame, reason_col: str = "rejection_reason") -> DataFrame:
    """``dq_quarantine_trend`` from the cells of gated trips."""
    return (
        cells.filter(F.col(reason_col).isNotNull())
        .groupBy(X.month_label_or_unknown("pickup_hour").alias("trip_month"), reason_col)
        .agg(F.sum("n").alias("quarantined_count"))
        .orderBy("trip_month", reason_col)
    )
