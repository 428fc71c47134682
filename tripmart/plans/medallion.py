"""Lazy bronze -> silver -> enriched lineage shared by queries, bench and the publishing run.

``gate`` deduplicates once (``HashAggregate`` with partial aggregation), tags
the survivors, and derives the valid and quarantine branches as filters of
that one result.  ``enriched`` stages the valid trips and joins the two
dimensions, by broadcast while their sizes allow it.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.functions import exprs as X
from tripmart.operators import enrich, expect, gate as G, observed, staging
from tripmart.plans import rollup
from tripmart.session import stored
from tripmart.sources.catalog import publish_tables, publish_view

COPIES_COL = "_copies"


@dataclass(frozen=True)
class GateResult:
    checked: DataFrame
    """Deduplicated rows with ``rejection_reason`` and ``_copies`` (raw rows per survivor)."""
    deduped: DataFrame
    """Deduplicated rows in the raw schema."""
    tagged: DataFrame
    """Deduplicated rows with ``rejection_reason``."""
    valid: DataFrame
    quarantine: DataFrame


def gate(raw: DataFrame, rules: Sequence[G.Rule], keys: Sequence[str] | None = None, weight_col: str | None = None) -> GateResult:
    """Dedup on the business keys, then tag with the first failing rule and split.

    ``weight_col`` counts the raw rows that a row of ``raw`` stands for already.
    """
    deduped = G.drop_duplicate_rows(raw, keys=keys, copies_col=COPIES_COL, weight_col=weight_col)
    checked = G.tag_first_failure(deduped, rules)
    tagged = checked.drop(COPIES_COL)
    valid, quarantine = G.split(tagged)
    return GateResult(checked, deduped.drop(COPIES_COL), tagged, valid, quarantine)


def enriched(
    valid: DataFrame,
    raw_hourly: DataFrame,
    raw_zones: DataFrame,
    max_broadcast_rows: int | None = None,
    materialize_dims: bool = False,
) -> DataFrame:
    """Staged valid trips with hourly context, location and derived columns."""
    return enrich.enrich_trips(
        staging.stage_trips(valid),
        staging.stage_weather(raw_hourly),
        staging.stage_zones(raw_zones),
        max_broadcast_rows=max_broadcast_rows,
        materialize_dims=materialize_dims,
    )


STATUS_COL = "_gate_status"
MONTH_COL = "_pickup_month"


def staging_views(silver_db: str) -> dict[str, str]:
    """The staged models and the enriched fact as SELECTs over the published silver tables, in publishing order."""
    db = f"`{silver_db}`"
    hourly = ", ".join(staging.HOURLY_VARIABLES)
    return {
        "stg_trips": f"""
            SELECT VendorID AS vendor_id, CAST(tpep_pickup_datetime AS TIMESTAMP) AS pickup_ts,
                   CAST(tpep_dropoff_datetime AS TIMESTAMP) AS dropoff_ts, passenger_count, trip_distance,
                   PULocationID AS pickup_location_id, DOLocationID AS dropoff_location_id,
                   payment_type, fare_amount, tip_amount, total_amount
            FROM {db}.trips_input""",
        "stg_weather": f"SELECT weather_hour_local, {hourly} FROM {db}.weather_input WHERE weather_hour_local IS NOT NULL",
        "stg_zone_lookup": f"""
            SELECT CAST(LocationID AS INT) AS location_id, Borough AS borough, Zone AS zone, service_zone FROM {db}.zone_lookup""",
        "stg_quarantine": f"""
            SELECT {G.REASON_COL}, tpep_pickup_datetime AS pickup_ts, trip_distance, total_amount FROM {db}.quarantine""",
        "int_trips_weather": f"""
            SELECT t.*, {", ".join(f"w.{v}" for v in staging.HOURLY_VARIABLES)}, z.borough AS pickup_borough, z.zone AS pickup_zone,
                   (unix_timestamp(t.dropoff_ts) - unix_timestamp(t.pickup_ts)) / 60 AS trip_minutes,
                   date_format(t.pickup_ts, 'EEEE') AS weekday,
                   coalesce(w.precipitation > {X.PRECIPITATION_THRESHOLD_MM}, false) AS is_precipitation
            FROM (SELECT *, date_trunc('hour', pickup_ts) AS pickup_hour FROM {db}.stg_trips) t
            LEFT JOIN {db}.stg_weather w ON t.pickup_hour = w.weather_hour_local
            LEFT JOIN {db}.stg_zone_lookup z ON t.pickup_location_id = z.location_id""",
    }


@dataclass(frozen=True)
class PublishResult:
    report: DataFrame
    breakdown: DataFrame
    marts: dict[str, DataFrame]
    expectations: DataFrame


def publish_all(
    raw: DataFrame,
    raw_hourly: DataFrame,
    raw_zones: DataFrame,
    rules: Sequence[G.Rule],
    silver_db: str = "silver",
    gold_db: str = "gold",
    match_rate_threshold: float = 0.95,
    pickup_col: str = "tpep_pickup_datetime",
    dropoff_col: str = "tpep_dropoff_datetime",
) -> PublishResult:
    """Bronze -> silver -> gold: two passes over the fact data, one that writes it and one that reads it.

    1. Gate: dedup + tag, written once as ``silver.trips_checked`` partitioned
       by pickup month and ``_gate_status``; ``silver.trips_input`` and
       ``silver.quarantine`` are persistent views of its partitions, so both
       branches come from one computation.  The staged models and the enriched
       fact are views over those.  The report, the breakdown and the tests of
       the trips are counts observed by that write.
    2. Rollup: one scan of that table into hourly cells, with the rejection
       reason in the grain.  The marts and the quarantine trend are aggregates
       of the stored cells; their tests are observed while the joined cells
       are stored and the marts are written.

    The written silver table cuts the lineage: a lost executor during the
    mart stage recomputes from silver, not from bronze.
    """
    spark = raw.sparkSession
    result = gate(raw, rules)
    reason = F.col(G.REASON_COL)
    status = F.when(reason.isNull(), F.lit("valid")).otherwise(F.lit("quarantine"))
    reasons = G.reason_counts(rules)
    checked, gate_counts = observed.watch(
        result.checked.withColumns({MONTH_COL: X.month_label_or_unknown(pickup_col), STATUS_COL: status}),
        {**G.report_counts(COPIES_COL), **{f"reason:{label}": c for label, c in reasons.items()},
         "not_null:stg_trips.pickup_ts": F.count_if(reason.isNull() & F.col(pickup_col).isNull()),
         "not_null:stg_trips.dropoff_ts": F.count_if(reason.isNull() & F.col(dropoff_col).isNull())},
    )
    hourly, hourly_counts = observed.watch(
        G.drop_null(raw_hourly, "weather_hour_local"), {"not_null:stg_weather.weather_hour_local": observed.nulls("weather_hour_local")})
    checked_name = f"{silver_db}.trips_checked"
    silver = publish_tables(
        {checked_name: checked, f"{silver_db}.weather_input": hourly, f"{silver_db}.zone_lookup": raw_zones},
        partition_by={checked_name: [MONTH_COL, STATUS_COL]},
    )
    taken = gate_counts.get()
    report = G.report_of_counts(spark, taken)
    breakdown = G.breakdown_of_counts(spark, {label: taken[f"reason:{label}"] for label in reasons})

    with ThreadPoolExecutor(1) as pool:  # catalog calls, while the cells are computed
        views = pool.submit(_publish_views, spark, silver_db)
        cells = stored(rollup.hourly_rollup(staging.stage_trips(silver[checked_name], G.REASON_COL), G.REASON_COL), "cells")
        views.result()
    stg_weather, stg_zones = spark.table(f"{silver_db}.stg_weather"), spark.table(f"{silver_db}.stg_zone_lookup")
    joined, cell_counts = rollup.stored_enriched(cells, stg_weather, stg_zones)
    built = {name: fn(joined) for name, fn in rollup.ROLLUP_MARTS.items()}
    built["dq_quarantine_trend"] = rollup.quarantine_trend(cells)
    watched = {name: observed.watch(df, _mart_tests(name)) if _mart_tests(name) else (df, None) for name, df in built.items()}
    published = publish_tables({f"{gold_db}.{name}": df for name, (df, _) in watched.items()})
    gold = {name: published[f"{gold_db}.{name}"] for name in built}

    failing = {name: n for name, n in taken.items() if name.startswith("not_null:")}
    for counts in (hourly_counts, *(c for _, c in watched.values() if c)):
        failing.update(counts.get())
    failing[MATCH_RATE_TEST] = rollup.failing_match_rate(cell_counts.get(), match_rate_threshold)
    day_types = [X.DAY_TYPE_WEEKDAY, X.DAY_TYPE_WEEKEND]
    checks = [
        ("unique:stg_weather.weather_hour_local", expect.expect_unique(stg_weather, "weather_hour_local")),
        ("unique:stg_zones.location_id", expect.expect_unique(stg_zones, "location_id")),
        ("unique:daily_weather_ridership.trip_date", expect.expect_unique(gold["daily_weather_ridership"], "trip_date")),
        ("unique:revenue_efficiency_by_hour.hour_of_day", expect.expect_unique(gold["revenue_efficiency_by_hour"], "hour_of_day")),
        ("accepted_values:weather_impact.day_type", expect.expect_values(gold["weather_impact"], "day_type", day_types)),
        ("accepted_values:weather_speed_impact.day_type", expect.expect_values(gold["weather_speed_impact"], "day_type", day_types)),
    ]
    return PublishResult(report, breakdown, gold, expect.run_expectations(checks, [observed.summaries(spark, failing)]))


def _publish_views(spark: SparkSession, silver_db: str) -> None:
    """Both branches of the gated trips, then what reads them."""
    own = f"`{G.REASON_COL}`, `{COPIES_COL}`, `{MONTH_COL}`, `{STATUS_COL}`"
    source = f"FROM `{silver_db}`.trips_checked WHERE `{STATUS_COL}` ="
    publish_view(spark, f"{silver_db}.trips_input", f"SELECT * EXCEPT ({own}) {source} 'valid'")
    publish_view(spark, f"{silver_db}.quarantine", f"SELECT * EXCEPT (`{COPIES_COL}`, `{MONTH_COL}`, `{STATUS_COL}`) {source} 'quarantine'")
    for name, select in staging_views(silver_db).items():
        publish_view(spark, f"{silver_db}.{name}", select)


MATCH_RATE_TEST = "match_rate:int_trips_weather.temperature_2m"
#: Key columns of the marts that must not be NULL.
MART_KEYS = {
    "trips_by_hour_weekday": "hour_of_day", "daily_weather_ridership": "trip_date", "demand_by_borough": "pickup_borough",
    "dq_quarantine_trend": "trip_month", "payment_mix": "payment_type_label", "revenue_efficiency_by_hour": "hour_of_day",
}


def _mart_tests(mart: str) -> dict[str, Column]:
    """The not-null test of a mart's key, to be observed while the mart is written."""
    key = MART_KEYS.get(mart)
    return {f"not_null:{mart}.{key}": observed.nulls(key)} if key else {}
