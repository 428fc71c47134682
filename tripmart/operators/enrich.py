"""Enrichment: trip facts left-joined to the hourly context and the location lookup.

Both joins keep left-join semantics: a trip without a matching hour or
location keeps its row with NULL context, and a dimension key that occurs
twice fans the trip out (use ``expect_unique`` on the dimension keys first).
A dimension is broadcast by the planner, from its size, or after a check of its
rows and bytes (``plans.joins.broadcast_if_bounded``), so the fact side is never
shuffled for enrichment while the dimensions stay small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.functions import exprs as X
from tripmart.operators.staging import HOURLY_VARIABLES
from tripmart.plans.joins import DEFAULT_MAX_BROADCAST_ROWS, broadcast_all_if_bounded, broadcast_if_bounded


def join_hourly(
    trips: DataFrame,
    hourly: DataFrame,
    ts_col: str = "pickup_ts",
    hour_col: str = "weather_hour_local",
    variables: tuple[str, ...] = HOURLY_VARIABLES,
    max_broadcast_rows: int | None = DEFAULT_MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Truncate ``ts_col`` to the hour and left-join the hourly series on it (O-38).

    Adds ``pickup_hour`` and the hourly ``variables`` to every trip column.
    ``max_broadcast_rows=None`` leaves the join strategy to the caller (e.g. a
    dimension already checked and hinted).
    """
    t = trips.withColumn("pickup_hour", X.hour_bucket(ts_col)).alias("t")
    h = hourly.select(hour_col, *variables)
    if max_broadcast_rows is not None:
        h = broadcast_if_bounded(h, max_broadcast_rows)
    h = h.alias("h")
    joined = t.join(h, F.col("t.pickup_hour") == F.col(f"h.{hour_col}"), "left")
    return joined.select("t.*", *[F.col(f"h.{v}") for v in variables])


def join_zones(
    trips: DataFrame,
    zones: DataFrame,
    key_col: str = "pickup_location_id",
    prefix: str = "pickup",
    max_broadcast_rows: int | None = DEFAULT_MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Left-join the location lookup on ``key_col`` for borough and zone (O-39)."""
    t = trips.alias("t")
    z = zones.select("location_id", "borough", "zone")
    if max_broadcast_rows is not None:
        z = broadcast_if_bounded(z, max_broadcast_rows)
    z = z.alias("z")
    joined = t.join(z, F.col(f"t.{key_col}") == F.col("z.location_id"), "left")
    return joined.select(
        "t.*",
        F.col("z.borough").alias(f"{prefix}_borough"),
        F.col("z.zone").alias(f"{prefix}_zone"),
    )


def add_trip_attributes(df: DataFrame) -> DataFrame:
    """Derived columns: duration in minutes, weekday name, precipitation flag."""
    return df.select(
        "*",
        X.minutes_between("pickup_ts", "dropoff_ts").alias("trip_minutes"),
        X.weekday_name("pickup_ts").alias("weekday"),
        X.is_precipitation("precipitation").alias("is_precipitation"),
    )


def enrich_trips(
    trips: DataFrame,
    hourly: DataFrame,
    zones: DataFrame,
    max_broadcast_rows: int | None = None,
    materialize_dims: bool = False,
) -> DataFrame:
    """Staged trips + 5 hourly variables + borough/zone + 3 derived columns (O-40).

    Nothing runs while this is built: the planner takes the joins from the
    dimensions' sizes (of a published table, its files), and broadcasts below
    ``spark.sql.autoBroadcastJoinThreshold``; beyond it AQE splits a hot key.
    With ``max_broadcast_rows`` both dimensions are counted first, in one job,
    and hinted when within that bound; ``materialize_dims`` stores them before,
    when they are derived on the fly rather than read from published tables.
    """
    hourly, zones = hourly.select("weather_hour_local", *HOURLY_VARIABLES), zones.select("location_id", "borough", "zone")
    if max_broadcast_rows is not None:
        hourly, zones = broadcast_all_if_bounded([hourly, zones], max_broadcast_rows, materialize=materialize_dims)
    with_hour = join_hourly(trips, hourly, max_broadcast_rows=None)
    with_zone = join_zones(with_hour, zones, max_broadcast_rows=None)
    return add_trip_attributes(with_zone)
