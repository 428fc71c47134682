"""Registered queries: one per operator group of the inventory, over the shared test tables.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame whose column names
equal those of the matching DuckDB text in ``tripmart.oracle``.  Most are lazy.
Jobs run while building: the pivots whose columns come from the data, the
expectation suites (which write the mart rollup once), the monthly partials and
the input/output queries, which write files first.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.functions import exprs as X
from tripmart.operators import analysis, calendar, expect, gate as G, marts, observed, pivots, staging
from tripmart.plans import medallion, monthly, rollup
from tripmart.session import ensure_checkpoint_dir, stored
from tripmart.sources import bucketed, catalog, ingest, ordered, testdata as T

Query = Callable[[SparkSession, str], DataFrame]


# ---------------------------------------------------------------- shared lineage

def _gate(spark: SparkSession, sf: str) -> medallion.GateResult:
    return medallion.gate(T.raw_trips(spark, sf), T.trip_rules())


def _itw(spark: SparkSession, sf: str) -> DataFrame:
    return medallion.enriched(_gate(spark, sf).valid, T.raw_hourly(spark, sf), T.raw_zones(spark, sf))


def _rolled(spark: SparkSession, sf: str) -> DataFrame:
    """The plan that is published: trips aggregated once, dimensions joined to the cells."""
    return rollup.enriched_rollup(
        staging.stage_trips(_gate(spark, sf).valid), _stg_weather(spark, sf), staging.stage_zones(T.raw_zones(spark, sf)), materialize=False
    )


def _stg_weather(spark: SparkSession, sf: str) -> DataFrame:
    return staging.stage_weather(T.raw_hourly(spark, sf))


def _trend(spark: SparkSession, sf: str) -> DataFrame:
    return marts.dq_quarantine_trend(staging.stage_quarantine(_gate(spark, sf).quarantine))


def _orders_trend(spark: SparkSession, sf: str) -> DataFrame:
    quarantined = T.tagged_orders(spark, sf).filter(F.col(G.REASON_COL).isNotNull())
    return marts.dq_quarantine_trend(quarantined)


# ---------------------------------------------------------------- gate (O-20..O-33)

def dedup_rows(spark, sf):
    return _gate(spark, sf).deduped


def duplicate_count(spark, sf):
    return G.duplicate_summary(_gate(spark, sf).checked, medallion.COPIES_COL)


def tag_first_failure(spark, sf):
    return _gate(spark, sf).tagged


def valid_rows(spark, sf):
    return _gate(spark, sf).valid


def quarantine_rows(spark, sf):
    return _gate(spark, sf).quarantine


def quarantine_breakdown(spark, sf):
    return G.quarantine_breakdown(_gate(spark, sf).quarantine)


def gate_report(spark, sf):
    return G.gate_report(_gate(spark, sf).checked, medallion.COPIES_COL)


# ---------------------------------------------------------------- staging and enrichment

def stg_trips(spark, sf):
    return staging.stage_trips(_gate(spark, sf).valid)


def stg_weather(spark, sf):
    return _stg_weather(spark, sf)


def stg_zones(spark, sf):
    return staging.stage_zones(T.raw_zones(spark, sf))


def stg_quarantine(spark, sf):
    return staging.stage_quarantine(_gate(spark, sf).quarantine)


def enriched_trips(spark, sf):
    return _itw(spark, sf)


# ---------------------------------------------------------------- marts

def _mart(fn):
    return lambda spark, sf: fn(_rolled(spark, sf))


def quarantine_trend(spark, sf):
    return _trend(spark, sf)


# ---------------------------------------------------------------- month-level analysis (orders mapping)

def quarantine_rate_by_month(spark, sf):
    return analysis.quarantine_rate_by_month(T.tagged_orders(spark, sf))


def quarantine_for_month(spark, sf):
    return analysis.quarantine_for_month(_orders_trend(spark, sf), T.ORDERS_REPORT_MONTH)


def reason_share_by_month(spark, sf):
    return analysis.reason_share_by_month(_orders_trend(spark, sf))


def pivot_month_reason(spark, sf):
    return pivots.pivot_month_reason(_orders_trend(spark, sf))


def month_bounds(spark, sf):
    return calendar.month_bounds_of(T.tagged_orders(spark, sf), "pickup_ts")


# ---------------------------------------------------------------- findings

def payment_code_counts(spark, sf):
    return analysis.payment_code_counts(_gate(spark, sf).valid)


def undocumented_code_share(spark, sf):
    return analysis.code_share(_gate(spark, sf).valid, code=0)


def ratio_outliers(spark, sf):
    return analysis.ratio_outliers(_gate(spark, sf).valid, threshold=T.OUTLIER_THRESHOLD)


def borough_summary(spark, sf):
    return analysis.borough_summary(rollup.demand_by_borough(_rolled(spark, sf)))


def dry_vs_wet(spark, sf):
    return analysis.mean_of_group_means(rollup.weather_impact(_rolled(spark, sf)))


def temp_by_daytype(spark, sf):
    return analysis.temp_by_daytype(rollup.weather_impact(_rolled(spark, sf)))


def pivot_hour_weekday(spark, sf):
    return pivots.pivot_hour_weekday(rollup.trips_by_hour_weekday(_rolled(spark, sf)))


def pivot_hour_borough(spark, sf):
    return pivots.pivot_hour_borough(rollup.demand_by_borough(_rolled(spark, sf)))


def pivot_speed(spark, sf):
    return pivots.pivot_speed(rollup.weather_speed_impact(_rolled(spark, sf)))


# ---------------------------------------------------------------- expectations

class _Models:
    """What a test suite reads: one rollup of all gated trips, the dimensions, and the marts over them.

    The rollup carries the rejection reason in its grain, so one pass over the
    trips gives the marts, the quarantine trend and the NULL counts of
    ``stg_trips``.  It is bounded by hours x locations x codes x reasons and
    stored once; nothing at trip grain is.  The not-null tests and the match
    rate are counts observed by the writes of the cells and the hours.
    """

    def __init__(self, spark, sf):
        staged = staging.stage_trips(_gate(spark, sf).tagged, G.REASON_COL)
        valid = F.col(G.REASON_COL).isNull()
        cells, trips = observed.watch(rollup.hourly_rollup(staged, G.REASON_COL), {
            "not_null:stg_trips.pickup_ts": F.sum(F.when(valid & F.col("pickup_hour").isNull(), F.col("n"))),
            "not_null:stg_trips.dropoff_ts": F.sum(F.when(valid, F.col("no_dropoff_n"))),
            "not_null:dq_quarantine_trend.trip_month": observed.any_null(X.month_label_or_unknown("pickup_hour"), ~valid),
        })
        hours, weather = observed.watch(_stg_weather(spark, sf), {"not_null:stg_weather.weather_hour_local": observed.nulls("weather_hour_local")})
        with ThreadPoolExecutor(2) as pool:  # two independent writes
            self.cells, self.stg_weather = pool.map(stored, (cells, hours), ("cells", "hours"))
        self.stg_zones = staging.stage_zones(T.raw_zones(spark, sf))
        hour, date, label = X.hour_of_day("pickup_hour"), X.calendar_date("pickup_hour"), X.payment_label("payment_type")
        self.enriched, joined = rollup.stored_enriched(self.cells, self.stg_weather, self.stg_zones, {
            "not_null:trips_by_hour_weekday.hour_of_day": observed.any_null(hour),
            "not_null:daily_weather_ridership.trip_date": observed.any_null(date),
            "not_null:demand_by_borough.pickup_borough": observed.any_null(F.col("pickup_borough"), F.col("pickup_borough").isNotNull()),
            "not_null:payment_mix.payment_type_label": observed.any_null(label),
            "not_null:revenue_efficiency_by_hour.hour_of_day": observed.any_null(hour, F.col("rev_n") > 0),
        })
        counts = {**trips.get(), **weather.get(), **joined.get()}
        self.not_null = {name: n for name, n in counts.items() if name.startswith("not_null:")}
        self.match_rate = {medallion.MATCH_RATE_TEST: rollup.failing_match_rate(counts, T.MATCH_RATE_THRESHOLD)}

    def mart_keys(self, name):
        return rollup.mart_keys(self.enriched, name)


def _unique_checks(m: _Models):
    return [
        ("unique:daily_weather_ridership.trip_date", expect.expect_unique(m.mart_keys("daily_weather_ridership"), "trip_date")),
        ("unique:revenue_efficiency_by_hour.hour_of_day", expect.expect_unique(m.mart_keys("revenue_efficiency_by_hour"), "hour_of_day")),
        ("unique:stg_weather.weather_hour_local", expect.expect_unique(m.stg_weather, "weather_hour_local")),
        ("unique:stg_zones.location_id", expect.expect_unique(m.stg_zones, "location_id")),
    ]


def _value_checks(m: _Models):
    day_types = [X.DAY_TYPE_WEEKDAY, X.DAY_TYPE_WEEKEND]
    return [
        ("accepted_values:weather_impact.day_type", expect.expect_values(m.mart_keys("weather_impact"), "day_type", day_types)),
        ("accepted_values:weather_speed_impact.day_type", expect.expect_values(m.mart_keys("weather_speed_impact"), "day_type", day_types)),
    ]


def expect_not_null(spark, sf):
    return observed.summaries(spark, _Models(spark, sf).not_null)


def expect_unique(spark, sf):
    return expect.run_expectations(_unique_checks(_Models(spark, sf)))


def expect_values(spark, sf):
    return expect.run_expectations(_value_checks(_Models(spark, sf)))


def expectation_failures(spark, sf):
    """Each kind of expectation on raw tables that break it."""
    trips, events, orders = T.raw_trips(spark, sf), T.table(spark, sf, "events"), T.table(spark, sf, "orders")
    return expect.run_expectations([
        ("not_null:raw_trips.tpep_pickup_datetime", expect.expect_not_null(trips, "tpep_pickup_datetime")),
        ("unique:orders.o_custkey", expect.expect_unique(orders, "o_custkey")),
        ("accepted_values:events.event_type", expect.expect_values(events, "event_type", ["click", "view"])),
        ("match_rate:raw_trips.tpep_dropoff_datetime", expect.expect_match_rate(trips, "tpep_dropoff_datetime", 0.999)),
    ])


def expect_match_rate(spark, sf):
    return rollup.match_rate(_rolled(spark, sf), T.MATCH_RATE_THRESHOLD)


def run_expectations(spark, sf):
    m = _Models(spark, sf)
    return expect.run_expectations(_unique_checks(m) + _value_checks(m), [observed.summaries(spark, {**m.not_null, **m.match_rate})])


# ---------------------------------------------------------------- calendar and ingest

def hourly_completeness(spark, sf):
    return calendar.hourly_completeness(_stg_weather(spark, sf), T.SPINE_START_DATE, T.SPINE_END_DATE)


def missing_hours(spark, sf):
    return calendar.missing_hours(_stg_weather(spark, sf), T.SPINE_START_DATE, T.SPINE_END_DATE)


def hourly_payload_rows(spark, sf):
    docs = T.hourly_payload_documents(_stg_weather(spark, sf))
    return ingest.hourly_payload_to_rows(docs, "payload", T.HOURLY_PAYLOAD_TYPES, mode="quarantine")


def bad_payload_days(spark, sf):
    docs = T.hourly_payload_documents(_stg_weather(spark, sf))
    return ingest.bad_payloads(docs, "payload", T.HOURLY_PAYLOAD_TYPES).select("day")


def file_row_counts(spark, sf):
    events = ingest.with_ingest_metadata(T.table(spark, sf, "events"))
    counts = ingest.file_row_counts(events)
    return counts.select(F.element_at(F.split("_source_file", "/"), -1).alias("file_name"), "row_count")


# ---------------------------------------------------------------- input and output (files written from the tables first)

def _order_files(spark, sf) -> tuple[str, list[str]]:
    """All orders as one file set per year, below the session's shared folder: path template and years."""
    path = f"{ensure_checkpoint_dir(spark)}/orders-{uuid.uuid4().hex}"
    orders = T.table(spark, sf, "orders").withColumn("year", F.date_format("o_orderdate", "yyyy"))
    orders.write.partitionBy("year").parquet(path)
    years = [r[0] for r in spark.read.parquet(path).select(F.col("year").cast("string")).distinct().orderBy("year").collect()]
    return f"{path}/year={{month}}", years


def read_months(spark, sf):
    template, years = _order_files(spark, sf)
    rows = ingest.read_months(spark, years, template)
    return rows.groupBy(F.col("_month").alias("month")).agg(F.count(F.lit(1)).alias("row_count"), F.count_distinct("o_custkey").alias("customers"))


def load_months(spark, sf):
    """Loaded twice: the second run skips every stored part, then the last one is forced."""
    template, years = _order_files(spark, sf)
    target = template.replace("/year={month}", "-bronze")
    ingest.load_months(spark, years, template, target)
    again = ingest.load_months(spark, years, template, target)
    forced = ingest.load_months(spark, years[-1:], template, target, force=True)
    second = F.when(F.col("month").isin(forced.loaded), "forced").when(F.col("month").isin(again.skipped), "skipped")
    rows = spark.read.schema("o_orderkey long, _month string").parquet(target)
    return rows.groupBy(F.col("_month").alias("month")).agg(F.count(F.lit(1)).alias("row_count")).withColumn("second_run", second)


def _delivered_months(spark, sf) -> str:
    """All trips as three monthly deliveries, below the session's shared folder: a path template."""
    path = f"{ensure_checkpoint_dir(spark)}/deliveries-{uuid.uuid4().hex}"
    number = (F.col("PULocationID") + F.col("_ingest_batch")) % 3 + 1
    trips = T.raw_trips(spark, sf).withColumn("month", F.concat(F.lit("2024-0"), number.cast("string"))).drop("_ingest_batch")
    trips.write.partitionBy("month").parquet(path)
    return f"{path}/month={{month}}"


def _half_months(spark, sf):
    """The partials of all trips, the last half-month refreshed after the others, and the dimensions."""
    raw, calendar = T.raw_trips(spark, sf), monthly.HalfMonths()
    weather, zones = stored(_stg_weather(spark, sf), "hours"), staging.stage_zones(T.raw_zones(spark, sf))
    store = f"{ensure_checkpoint_dir(spark)}/monthly-{uuid.uuid4().hex}"
    parts = monthly.touched_parts(raw, calendar=calendar)
    for some in (parts[:-1], parts[-1:]):
        stores = monthly.refresh_months(raw, weather, zones, T.trip_rules(), some, store, calendar=calendar)
    return stores, weather, zones


def weather_impact_merged(spark, sf):
    return monthly.weather_impact_of_sets(_half_months(spark, sf)[0].hours)


def daily_ridership_merged(spark, sf):
    return monthly.merged_marts(*_half_months(spark, sf))["daily_weather_ridership"]


def dedup_bucketed(spark, sf):
    """Bucketed bronze, its third month loaded later; every survivor names the file that it came from."""
    template, months = _delivered_months(spark, sf), ["2024-01", "2024-02", "2024-03"]
    name = f"bronze_{uuid.uuid4().hex[:12]}.trips"
    bucketed.load_bucketed(spark, months[:2], template, name, buckets=8)
    bucketed.load_bucketed(spark, months, template, name, buckets=8)
    names = bucketed.file_names(spark, [template.format(month=m) for m in months])
    rows = bucketed.with_file_names(bucketed.deduplicated(spark.table(name)), names)
    return rows.withColumn("file_month", F.regexp_extract("_source_file", "month=([0-9-]+)", 1)).drop("_source_file", "_month", "_ingested_at")


def load_changed_months(spark, sf):
    """Loaded; loaded again, all equal; then one year's files are written anew and loaded alone."""
    template, years = _order_files(spark, sf)
    target = template.replace("/year={month}", "-bronze")
    ingest.load_changed_months(spark, years, template, target)
    again = ingest.load_changed_months(spark, years, template, target)
    last = T.table(spark, sf, "orders").filter(F.date_format("o_orderdate", "yyyy") == years[-1])
    last.unionByName(last).write.mode("overwrite").parquet(template.format(month=years[-1]))
    changed = ingest.load_changed_months(spark, years, template, target)
    counts = ingest.partition_row_counts(spark, target).select(F.col("_month").cast("string").alias("month"), "row_count")
    return counts.withColumns({"second_run": F.when(F.col("month").isin(again.skipped), "skipped").otherwise("loaded"),
                               "third_run": F.when(F.col("month").isin(changed.loaded), "loaded").otherwise("skipped")})


def nanosecond_hours(spark, sf):
    """The hourly series through a file with nanosecond timestamps."""
    path = f"{ensure_checkpoint_dir(spark)}/hourly-{uuid.uuid4().hex}"
    T.write_nanosecond_files(_stg_weather(spark, sf), path)
    return ingest.read_hourly(spark, path, nanos=True)


def month_bounds_of_list(spark, sf):
    """Bounds of the months of the orders, given as a list of labels."""
    labels = T.tagged_orders(spark, sf).select(X.month_label("pickup_ts").alias("m")).distinct().orderBy("m")
    start, end = calendar.month_bounds([r[0] for r in labels.collect()])
    return spark.range(1).select(F.lit(start).alias("start_date"), F.lit(end).alias("end_date"))


def _published(spark, sf) -> tuple[str, str]:
    """All trips through the publishing run: the names of its two databases."""
    tag = uuid.uuid4().hex[:12]
    medallion.publish_all(T.raw_trips(spark, sf), T.raw_hourly(spark, sf), T.raw_zones(spark, sf), T.trip_rules(),
                          silver_db=f"silver_{tag}", gold_db=f"gold_{tag}")
    return f"silver_{tag}", f"gold_{tag}"


def published_enriched_view(spark, sf):
    return catalog.read_table(spark, f"{_published(spark, sf)[0]}.int_trips_weather")


def published_marts(spark, sf):
    """Rows of every gold table, and its trips or quarantined rows in all."""
    gold = _published(spark, sf)[1]
    totals = {"weather_impact": "total_trips", "dq_quarantine_trend": "quarantined_count"}
    rows = [
        spark.table(f"{gold}.{name}").agg(F.lit(name).alias("mart"), F.count(F.lit(1)).alias("n_rows"), F.sum(totals.get(name, "trip_count")).alias("total"))
        for name in (*rollup.ROLLUP_MARTS, "dq_quarantine_trend")
    ]
    return reduce(DataFrame.unionByName, rows)


def _in_order(df, *order):
    """``df`` published in this order and read back with positions."""
    name = f"ordered_{uuid.uuid4().hex[:12]}.rows"
    return ordered.in_order(ordered.publish_ordered(df, name, *order, partitions=4))


def payment_mix_in_order(spark, sf):
    return _in_order(rollup.payment_mix(_rolled(spark, sf)), F.desc("trip_count"), "payment_type_label")


def daily_ridership_in_order(spark, sf):
    return _in_order(rollup.daily_weather_ridership(_rolled(spark, sf)), "trip_date")


def quarantine_breakdown_in_order(spark, sf):
    return _in_order(quarantine_breakdown(spark, sf), F.desc("quarantined_count"), G.REASON_COL)


def read_zone_csv(spark, sf):
    zones = T.raw_zones(spark, sf)
    zones = zones.withColumn("Zone", F.when(F.col("LocationID") % 5 == 0, "N/A").otherwise(F.col("Zone")))
    zones = zones.withColumn("service_zone", F.when(F.col("LocationID") % 7 != 0, F.col("service_zone")))
    path = f"{ensure_checkpoint_dir(spark)}/zones-{uuid.uuid4().hex}"
    zones.write.option("header", True).csv(path)
    return ingest.read_zone_csv(spark, path)


def publish_table(spark, sf):
    """The staged trips published, published again over themselves, and read back through the catalog."""
    trips = staging.stage_trips(_gate(spark, sf).valid).withColumn("trip_month", X.month_label_or_unknown("pickup_ts"))
    name = f"published_{uuid.uuid4().hex[:12]}.stg_trips"
    catalog.publish_table(trips.withColumn("trip_month", F.lit("draft")), name, ["trip_month"])
    catalog.publish_table(trips, name, ["trip_month"])
    return catalog.read_table(spark, name).groupBy("trip_month").agg(F.count(F.lit(1)).alias("trips"))


weather_impact_query = _mart(rollup.weather_impact)

QUERIES: dict[str, Query] = {
    "weather_impact_merged": weather_impact_merged,
    "daily_ridership_merged": daily_ridership_merged,
    "dedup_rows": dedup_rows,
    "dedup_bucketed": dedup_bucketed,
    "load_changed_months": load_changed_months,
    "nanosecond_hours": nanosecond_hours,
    "month_bounds_of_list": month_bounds_of_list,
    "published_enriched_view": published_enriched_view,
    "published_marts": published_marts,
    "payment_mix_in_order": payment_mix_in_order,
    "daily_ridership_in_order": daily_ridership_in_order,
    "quarantine_breakdown_in_order": quarantine_breakdown_in_order,
    "duplicate_count": duplicate_count,
    "tag_first_failure": tag_first_failure,
    "valid_rows": valid_rows,
    "quarantine_rows": quarantine_rows,
    "quarantine_breakdown": quarantine_breakdown,
    "gate_report": gate_report,
    "stg_trips": stg_trips,
    "stg_weather": stg_weather,
    "stg_zones": stg_zones,
    "stg_quarantine": stg_quarantine,
    "enriched_trips": enriched_trips,
    "trips_by_hour_weekday": _mart(rollup.trips_by_hour_weekday),
    "daily_ridership": _mart(rollup.daily_weather_ridership),
    "weather_impact": weather_impact_query,
    "demand_by_borough": _mart(rollup.demand_by_borough),
    "quarantine_trend": quarantine_trend,
    "payment_mix": _mart(rollup.payment_mix),
    "revenue_efficiency": _mart(rollup.revenue_efficiency_by_hour),
    "speed_impact": _mart(rollup.weather_speed_impact),
    "quarantine_rate_by_month": quarantine_rate_by_month,
    "quarantine_for_month": quarantine_for_month,
    "reason_share_by_month": reason_share_by_month,
    "pivot_month_reason": pivot_month_reason,
    "month_bounds": month_bounds,
    "payment_code_counts": payment_code_counts,
    "undocumented_code_share": undocumented_code_share,
    "ratio_outliers": ratio_outliers,
    "borough_summary": borough_summary,
    "dry_vs_wet": dry_vs_wet,
    "temp_by_daytype": temp_by_daytype,
    "pivot_hour_weekday": pivot_hour_weekday,
    "pivot_hour_borough": pivot_hour_borough,
    "pivot_speed": pivot_speed,
    "expect_not_null": expect_not_null,
    "expect_unique": expect_unique,
    "expect_values": expect_values,
    "expect_match_rate": expect_match_rate,
    "run_expectations": run_expectations,
    "hourly_completeness": hourly_completeness,
    "missing_hours": missing_hours,
    "hourly_payload_rows": hourly_payload_rows,
    "bad_payload_days": bad_payload_days,
    "file_row_counts": file_row_counts,
    "expectation_failures": expectation_failures,
    "read_months": read_months,
    "load_months": load_months,
    "read_zone_csv": read_zone_csv,
    "publish_table": publish_table,
}
