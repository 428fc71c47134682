"""Map the shared test tables onto the trip / hourly / location shapes.

``events`` is the only test table with a time of day, so it stands in for the
trip fact (with a re-delivered batch for duplicates and deterministic NULLs),
the same events rolled up per hour stand in for the hourly context, and
``nation`` joined to ``region`` stands in for the location lookup.  ``orders``
spans 80 months and feeds the month-level operators.  Every frame reads its
whole table; the modulo expressions only shape values, never drop rows.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.operators import gate

# --- Fixed values: parameters of the test-data mapping. ---
RANGE_START = "2024-01-02 00:00:00"
RANGE_END_LITERAL = "2024-01-29"
OUTLIER_THRESHOLD = 11.9
MATCH_RATE_THRESHOLD = 0.95
SPINE_START_DATE = "2024-01-01"
SPINE_END_DATE = "2024-01-30"
ORDERS_RANGE_START = "1996-01-01 00:00:00"
ORDERS_RANGE_END_LITERAL = "2000-12-31 00:00:00"
ORDERS_REPORT_MONTH = "2000-12"
# --- end of fixed values ---


@functools.lru_cache(maxsize=64)
def _read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the shared test tables (read-only files, so the reader is reused per session)."""
    return _read(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")


def _events_as_trips(events: DataFrame, batch: int) -> DataFrame:
    eid = F.col("event_id")
    value = F.col("value")
    return events.select(
        (eid % 2 + 1).cast("int").alias("VendorID"),
        F.when(eid % 503 == 7, F.lit(None)).otherwise(F.col("ts")).alias("tpep_pickup_datetime"),
        F.when(eid % 211 == 0, F.lit(None))
        .otherwise(F.timestamp_add("SECOND", eid * 37 % 12000 - 30, F.col("ts")))
        .alias("tpep_dropoff_datetime"),
        F.when(eid % 50 == 0, F.lit(None)).otherwise(eid % 6 + 1).alias("passenger_count"),
        (value / 10.0 - 0.1).alias("trip_distance"),
        (F.col("user_id") % 30).cast("int").alias("PULocationID"),
        (eid % 30).cast("int").alias("DOLocationID"),
        F.when(eid % 9 == 8, F.lit(None)).otherwise(eid % 9).cast("int").alias("payment_type"),
        (value - 0.5).alias("fare_amount"),
        F.when(eid % 9 == 1, value * 0.2).otherwise(F.lit(0.0)).alias("tip_amount"),
        (value * 1.2 - 3.0).alias("total_amount"),
        F.lit(batch).alias("_ingest_batch"),
    )


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze trips: all events as batch 0, plus every 97th event delivered again as batch 1."""
    events = table(spark, sf_dir, "events")
    redelivered = events.filter(F.col("event_id") % 97 == 0)
    return _events_as_trips(events, 0).unionByName(_events_as_trips(redelivered, 1))


def raw_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly context: all events rolled up per hour, measures from its ``error`` events.

    An hour without error events has NULL measures; every thirteenth hour has
    lost its key, so its events meet in one row with a NULL hour.
    """
    events = table(spark, sf_dir, "events")
    lost = F.floor(F.unix_timestamp("ts") / 3600) % 13 == 5
    error = F.when(F.col("event_type") == "error", F.col("value"))
    return events.groupBy(F.when(~lost, F.date_trunc("hour", "ts")).alias("weather_hour_local")).agg(
        (F.avg(error) - 40).alias("temperature_2m"),
        (F.min(error) / 100).alias("precipitation"),
        F.lit(0.0).alias("snowfall"),
        F.max(error).alias("wind_speed_10m"),
        F.count(error).alias("weather_code"),
    )


def raw_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Location lookup in the CSV's column names: nations as zones, regions as boroughs."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").alias("LocationID"),
        F.col("r_name").alias("Borough"),
        F.col("n_name").alias("Zone"),
        F.col("r_name").alias("service_zone"),
    )


def trip_rules() -> list[gate.Rule]:
    """The five trip rules with the original gate's literal end bound."""
    return gate.trip_rules(RANGE_START, RANGE_END_LITERAL, range_mode="end_inclusive_literal")


def orders_rules() -> list[gate.Rule]:
    """Rules over ``orders`` that exercise every label across 80 months."""
    key = F.col("o_orderkey")
    return [
        (gate.NULL_TIMESTAMP, key % 401 == 0),
        (
            gate.PICKUP_OUTSIDE_RANGE,
            gate.rule_in_range("o_orderdate", ORDERS_RANGE_START, ORDERS_RANGE_END_LITERAL, "end_inclusive_literal"),
        ),
        (gate.NON_POSITIVE_DISTANCE, key % 37 == 0),
        (gate.NEGATIVE_TOTAL_AMOUNT, F.col("o_totalprice") < 20000),
    ]


HOURLY_PAYLOAD_TYPES = {
    "temperature_2m": "double",
    "precipitation": "double",
    "snowfall": "double",
    "wind_speed_10m": "double",
    "weather_code": "bigint",
}


def _field(name: str):
    return lambda x: x[name]


def hourly_payload_documents(hourly: DataFrame, hour_col: str = "weather_hour_local") -> DataFrame:
    """One parallel-array JSON document per day of an hourly series.

    Mirrors the shape an hourly weather API returns, cut per day so that a
    document holds at most one day of hours.  Some days are delivered badly:
    by day of the month modulo 7, day 2 lacks the snowfall array, day 3 has one
    hour too few in an array and day 4 a word among its numbers.
    """
    variables = list(HOURLY_PAYLOAD_TYPES)
    per_day = hourly.groupBy(F.to_date(hour_col).alias("day")).agg(
        F.sort_array(F.collect_list(F.struct(hour_col, *variables))).alias("r")
    )
    kind = F.dayofmonth("day") % 7
    arrays = {v: F.transform("r", _field(v)) for v in variables}
    arrays["snowfall"] = F.when(kind != 2, arrays["snowfall"])
    arrays["wind_speed_10m"] = F.when(kind == 3, F.slice(arrays["wind_speed_10m"], 2, 24)).otherwise(arrays["wind_speed_10m"])
    words = F.transform(arrays["precipitation"], lambda x: x.cast("string"))
    document = lambda **other: F.to_json(F.struct(F.struct(
        F.transform("r", lambda x: F.date_format(x[hour_col], "yyyy-MM-dd'T'HH:mm")).alias("time"),
        *[(arrays | other)[v].alias(v) for v in variables],
    ).alias("hourly")))
    broken = document(precipitation=F.concat(F.array(F.lit("dry")), F.slice(words, 2, 24)))
    return per_day.select("day", F.when(kind == 4, broken).otherwise(document()).alias("payload"))


def tagged_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with ``pickup_ts`` and a ``rejection_reason`` (NULL = valid)."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderdate").alias("pickup_ts"), "o_orderdate", "o_totalprice"
    )
    return gate.tag_first_failure(orders, orders_rules())


def write_nanosecond_files(df: DataFrame, path: str) -> int:
    """Write ``df`` as Parquet with nanosecond timestamps, which Spark itself doesn't write; returns the rows.

    One file a task, named by its partition, so a repeated task replaces its own.
    """

    def write(batches):
        import pyarrow as pa
        from pyarrow import fs, parquet
        from pyspark import TaskContext

        batches = [b for b in batches if b.num_rows]
        if batches:
            table = pa.Table.from_batches(batches)
            nanos = [pa.field(f.name, pa.timestamp("ns")) if pa.types.is_timestamp(f.type) else f for f in table.schema]
            system, folder = fs.FileSystem.from_uri(path)
            system.create_dir(folder)
            parquet.write_table(table.cast(pa.schema(nanos)), f"{folder}/part-{TaskContext.get().partitionId():05d}.parquet", filesystem=system, version="2.6")
        yield pa.record_batch([pa.array([sum(b.num_rows for b in batches)], pa.int64())], ["n"])

    return df.mapInArrow(write, "n long").agg(F.sum("n")).first()[0] or 0
