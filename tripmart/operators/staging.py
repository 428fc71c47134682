"""Staging projections: rename and cast source columns to the model names (O-16..O-19)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOURLY_VARIABLES = ("temperature_2m", "precipitation", "snowfall", "wind_speed_10m", "weather_code")


def stage_trips(df: DataFrame, *others: str) -> DataFrame:
    """Trip facts under model names; both timestamps cast to ``timestamp``; ``others`` are kept as they are."""
    return df.select(
        F.col("VendorID").alias("vendor_id"),
        F.col("tpep_pickup_datetime").cast("timestamp").alias("pickup_ts"),
        F.col("tpep_dropoff_datetime").cast("timestamp").alias("dropoff_ts"),
        F.col("passenger_count"),
        F.col("trip_distance"),
        F.col("PULocationID").alias("pickup_location_id"),
        F.col("DOLocationID").alias("dropoff_location_id"),
        F.col("payment_type"),
        F.col("fare_amount"),
        F.col("tip_amount"),
        F.col("total_amount"),
        *others,
    )


def stage_weather(df: DataFrame, hour_col: str = "weather_hour_local") -> DataFrame:
    """The hour key plus the five hourly variables, hours without a key dropped."""
    return df.filter(F.col(hour_col).isNotNull()).select(
        F.col(hour_col).alias("weather_hour_local"), *HOURLY_VARIABLES
    )


def stage_zones(df: DataFrame) -> DataFrame:
    """Location dimension: integer id and lower-case column names."""
    return df.select(
        F.col("LocationID").cast("int").alias("location_id"),
        F.col("Borough").alias("borough"),
        F.col("Zone").alias("zone"),
        F.col("service_zone"),
    )


def stage_quarantine(df: DataFrame, reason_col: str = "rejection_reason") -> DataFrame:
    """Quarantined rows reduced to what the trend mart needs (pickup left uncast)."""
    return df.select(
        F.col(reason_col).alias("rejection_reason"),
        F.col("tpep_pickup_datetime").alias("pickup_ts"),
        F.col("trip_distance"),
        F.col("total_amount"),
    )
