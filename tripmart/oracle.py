"""DuckDB SQL equivalents of the registered queries, for the side-by-side check.

The shared test tables are DuckDB views; the trip / hourly / location shapes
and the gate are restated here as CTEs, then each query is one final SELECT.
Result types are cast to match Spark's (``hour()`` INTEGER, sums BIGINT,
ratios DOUBLE).
"""

from __future__ import annotations


def _trips_select(batch: int, where: str = "") -> str:
    return f"""
    SELECT
        CAST(event_id % 2 + 1 AS INTEGER) AS VendorID,
        CASE WHEN event_id % 503 = 7 THEN NULL ELSE ts END AS tpep_pickup_datetime,
        CASE WHEN event_id % 211 = 0 THEN NULL
             ELSE ts + to_seconds(event_id * 37 % 12000 - 30) END AS tpep_dropoff_datetime,
        CASE WHEN event_id % 50 = 0 THEN NULL ELSE event_id % 6 + 1 END AS passenger_count,
        value / 10.0 - 0.1 AS trip_distance,
        CAST(user_id % 30 AS INTEGER) AS PULocationID,
        CAST(event_id % 30 AS INTEGER) AS DOLocationID,
        CAST(CASE WHEN event_id % 9 = 8 THEN NULL ELSE event_id % 9 END AS INTEGER) AS payment_type,
        value - 0.5 AS fare_amount,
        CASE WHEN event_id % 9 = 1 THEN value * 0.2 ELSE CAST(0.0 AS DOUBLE) END AS tip_amount,
        value * 1.2 - 3.0 AS total_amount,
        {batch} AS _ingest_batch
    FROM events {where}"""


SECS = "(epoch_us(dropoff_ts) // 1000000 - epoch_us(pickup_ts) // 1000000)"


def _xsum(value: str, digits: int) -> str:
    return f"(round(sum({value}), {digits}) + 0.0)"  # a rounded zero has no sign


def _xavg(value: str, digits: int, scale: int = 1) -> str:
    return f"(round(avg({value})" + (f" * {scale}" if scale != 1 else "") + f", {digits}) + 0.0)"


def _xminutes(digits: int) -> str:
    return f"round(avg({SECS}) / 60, {digits})"


def _ratio(part: str, whole: str, digits: int, scale: int = 1) -> str:
    """A rounded ratio of counts; NULL for an empty whole."""
    times = f" * {float(scale)}" if scale != 1 else ""
    return f"(round(({part}){times} / nullif({whole}, 0), {digits}) + 0.0)"


BUSINESS = (
    "VendorID, tpep_pickup_datetime, tpep_dropoff_datetime, passenger_count, trip_distance, "
    "PULocationID, DOLocationID, payment_type, fare_amount, tip_amount, total_amount"
)

WEEKDAY = "CASE WHEN weekday IN ('Saturday', 'Sunday') THEN 'weekend' ELSE 'weekday' END"
TEMP_BUCKET = """CASE WHEN temperature_2m < 0 THEN 'freezing'
         WHEN temperature_2m < 10 THEN 'cold'
         WHEN temperature_2m < 20 THEN 'mild'
         ELSE 'warm' END"""

PREFIX = f"""
WITH raw_trips AS (
    {_trips_select(0)}
    UNION ALL
    {_trips_select(1, "WHERE event_id % 97 = 0")}
),
dedup AS (
    SELECT {BUSINESS}, min(_ingest_batch) AS _ingest_batch, count(*) AS _copies
    FROM raw_trips GROUP BY ALL
),
checked AS (
    SELECT *,
        CASE
            WHEN tpep_pickup_datetime IS NULL OR tpep_dropoff_datetime IS NULL THEN 'null_timestamp'
            WHEN tpep_dropoff_datetime < tpep_pickup_datetime THEN 'dropoff_before_pickup'
            WHEN tpep_pickup_datetime < TIMESTAMP '2024-01-02 00:00:00'
              OR tpep_pickup_datetime > TIMESTAMP '2024-01-29 00:00:00' THEN 'pickup_outside_range'
            WHEN trip_distance <= 0 THEN 'non_positive_distance'
            WHEN total_amount < 0 THEN 'negative_total_amount'
        END AS rejection_reason
    FROM dedup
),
tagged AS (SELECT * EXCLUDE (_copies) FROM checked),
valid AS (SELECT * EXCLUDE (rejection_reason) FROM tagged WHERE rejection_reason IS NULL),
quarantine AS (SELECT * FROM tagged WHERE rejection_reason IS NOT NULL),
hourly_raw AS (
    SELECT CASE WHEN epoch_us(ts) // 3600000000 % 13 <> 5 THEN date_trunc('hour', ts) END AS weather_hour_local,
           avg(value) FILTER (WHERE event_type = 'error') - 40 AS temperature_2m,
           min(value) FILTER (WHERE event_type = 'error') / 100 AS precipitation,
           CAST(0.0 AS DOUBLE) AS snowfall,
           max(value) FILTER (WHERE event_type = 'error') AS wind_speed_10m,
           count(*) FILTER (WHERE event_type = 'error') AS weather_code
    FROM events GROUP BY 1
),
stg_weather AS (
    SELECT weather_hour_local, temperature_2m, precipitation, snowfall, wind_speed_10m, weather_code
    FROM hourly_raw WHERE weather_hour_local IS NOT NULL
),
stg_zones AS (
    SELECT CAST(n_nationkey AS INTEGER) AS location_id, r_name AS borough, n_name AS zone, r_name AS service_zone
    FROM nation JOIN region ON n_regionkey = r_regionkey
),
stg_trips AS (
    SELECT VendorID AS vendor_id,
           CAST(tpep_pickup_datetime AS TIMESTAMP) AS pickup_ts,
           CAST(tpep_dropoff_datetime AS TIMESTAMP) AS dropoff_ts,
           passenger_count, trip_distance,
           PULocationID AS pickup_location_id, DOLocationID AS dropoff_location_id,
           payment_type, fare_amount, tip_amount, total_amount
    FROM valid
),
stg_quarantine AS (
    SELECT rejection_reason, tpep_pickup_datetime AS pickup_ts, trip_distance, total_amount FROM quarantine
),
itw AS (
    SELECT t.*,
           w.temperature_2m, w.precipitation, w.snowfall, w.wind_speed_10m, w.weather_code,
           z.borough AS pickup_borough, z.zone AS pickup_zone,
           (epoch_us(t.dropoff_ts) // 1000000 - epoch_us(t.pickup_ts) // 1000000) / 60 AS trip_minutes,
           dayname(t.pickup_ts) AS weekday,
           CASE WHEN w.precipitation > 0.1 THEN true ELSE false END AS is_precipitation
    FROM (SELECT *, date_trunc('hour', pickup_ts) AS pickup_hour FROM stg_trips) t
    LEFT JOIN stg_weather w ON t.pickup_hour = w.weather_hour_local
    LEFT JOIN stg_zones z ON t.pickup_location_id = z.location_id
),
cond AS (
    SELECT *, {WEEKDAY} AS day_type, {TEMP_BUCKET} AS temp_bucket FROM itw
),
m_hour_weekday AS (
    SELECT CAST(hour(pickup_hour) AS INTEGER) AS hour_of_day, weekday,
           count(*) AS trip_count,
           {_xavg('total_amount', 2)} AS avg_fare,
           {_xminutes(1)} AS avg_trip_minutes
    FROM itw GROUP BY 1, 2
),
m_daily AS (
    SELECT CAST(pickup_ts AS DATE) AS trip_date,
           count(*) AS trip_count,
           {_xsum('total_amount', 2)} AS total_revenue,
           {_xavg('temperature_2m', 1)} AS avg_temp_c,
           {_xsum('precipitation', 1)} AS total_precip_mm
    FROM itw GROUP BY 1
),
m_impact AS (
    SELECT day_type, is_precipitation, temp_bucket,
           count(*) AS total_trips,
           count(DISTINCT pickup_hour) AS distinct_hours,
           {_ratio('count(*)', 'count(DISTINCT pickup_hour)', 1)} AS avg_trips_per_hour
    FROM cond GROUP BY 1, 2, 3
),
m_borough AS (
    SELECT pickup_borough, CAST(hour(pickup_hour) AS INTEGER) AS hour_of_day,
           count(*) AS trip_count,
           {_xavg('total_amount', 2)} AS avg_fare,
           {_xsum('total_amount', 2)} AS total_revenue
    FROM itw WHERE pickup_borough IS NOT NULL GROUP BY 1, 2
),
m_trend AS (
    SELECT coalesce(strftime(pickup_ts, '%Y-%m'), 'unknown_month') AS trip_month, rejection_reason,
           count(*) AS quarantined_count
    FROM stg_quarantine GROUP BY 1, 2
),
m_payment AS (
    SELECT CASE payment_type
               WHEN 1 THEN 'Credit card' WHEN 2 THEN 'Cash' WHEN 3 THEN 'No charge'
               WHEN 4 THEN 'Dispute' WHEN 5 THEN 'Unknown' WHEN 6 THEN 'Voided trip'
               WHEN 0 THEN 'Undocumented code (0)' ELSE 'Other' END AS payment_type_label,
           count(*) AS trip_count,
           {_xavg('total_amount', 2)} AS avg_fare,
           {_xavg('tip_amount', 2)} AS avg_tip,
           {_xavg('CASE WHEN fare_amount > 0 THEN tip_amount / fare_amount END', 1, 100)} AS avg_tip_pct
    FROM itw GROUP BY 1
),
m_revenue AS (
    SELECT CAST(hour(pickup_hour) AS INTEGER) AS hour_of_day,
           {_xminutes(1)} AS avg_trip_minutes,
           {_xavg('CASE WHEN trip_minutes > 0 THEN total_amount / trip_minutes END', 2)} AS avg_revenue_per_minute,
           {_xsum('total_amount', 0)} AS total_revenue,
           count(*) AS trip_count
    FROM itw WHERE trip_minutes > 0 AND trip_minutes < 180 GROUP BY 1
),
m_speed AS (
    SELECT is_precipitation, temp_bucket, day_type,
           {_xavg('speed_mph', 1)} AS avg_speed_mph,
           count(*) AS trip_count
    FROM (
        SELECT *, CASE WHEN trip_minutes > 0 THEN trip_distance / (trip_minutes / 60.0) ELSE NULL END AS speed_mph
        FROM cond WHERE trip_minutes BETWEEN 1 AND 180 AND trip_distance > 0
    ) s
    WHERE speed_mph < 60 GROUP BY 1, 2, 3
),
orders_tagged AS (
    SELECT o_orderkey, o_orderdate AS pickup_ts, o_orderdate, o_totalprice,
        CASE
            WHEN o_orderkey % 401 = 0 THEN 'null_timestamp'
            WHEN o_orderdate < TIMESTAMP '1996-01-01 00:00:00'
              OR o_orderdate > TIMESTAMP '2000-12-31 00:00:00' THEN 'pickup_outside_range'
            WHEN o_orderkey % 37 = 0 THEN 'non_positive_distance'
            WHEN o_totalprice < 20000 THEN 'negative_total_amount'
        END AS rejection_reason
    FROM orders
),
orders_trend AS (
    SELECT coalesce(strftime(pickup_ts, '%Y-%m'), 'unknown_month') AS trip_month, rejection_reason,
           count(*) AS quarantined_count
    FROM orders_tagged WHERE rejection_reason IS NOT NULL GROUP BY 1, 2
)
"""


def _pct(part: str, whole: str, digits: int = 2) -> str:
    return _ratio(part, whole, digits, 100)


def _summary(name: str, failing_sql: str) -> str:
    return (
        f"SELECT '{name}' AS expectation, count(*) AS failing_rows, count(*) = 0 AS passed "
        f"FROM ({failing_sql}) f"
    )


NOT_NULL = [
    ("not_null:stg_trips.pickup_ts", "SELECT * FROM stg_trips WHERE pickup_ts IS NULL"),
    ("not_null:stg_trips.dropoff_ts", "SELECT * FROM stg_trips WHERE dropoff_ts IS NULL"),
    ("not_null:stg_weather.weather_hour_local", "SELECT * FROM stg_weather WHERE weather_hour_local IS NULL"),
    ("not_null:trips_by_hour_weekday.hour_of_day", "SELECT * FROM m_hour_weekday WHERE hour_of_day IS NULL"),
    ("not_null:daily_weather_ridership.trip_date", "SELECT * FROM m_daily WHERE trip_date IS NULL"),
    ("not_null:demand_by_borough.pickup_borough", "SELECT * FROM m_borough WHERE pickup_borough IS NULL"),
    ("not_null:dq_quarantine_trend.trip_month", "SELECT * FROM m_trend WHERE trip_month IS NULL"),
    ("not_null:payment_mix.payment_type_label", "SELECT * FROM m_payment WHERE payment_type_label IS NULL"),
    ("not_null:revenue_efficiency_by_hour.hour_of_day", "SELECT * FROM m_revenue WHERE hour_of_day IS NULL"),
]


def _unique(rel: str, key: str) -> str:
    return f"SELECT {key} FROM {rel} WHERE {key} IS NOT NULL GROUP BY {key} HAVING count(*) > 1"


UNIQUE = [
    ("unique:daily_weather_ridership.trip_date", _unique("m_daily", "trip_date")),
    ("unique:revenue_efficiency_by_hour.hour_of_day", _unique("m_revenue", "hour_of_day")),
    ("unique:stg_weather.weather_hour_local", _unique("stg_weather", "weather_hour_local")),
    ("unique:stg_zones.location_id", _unique("stg_zones", "location_id")),
]


def _values(rel: str, col: str) -> str:
    return (
        f"SELECT {col} FROM {rel} WHERE {col} IS NOT NULL AND {col} NOT IN ('weekday', 'weekend') "
        f"GROUP BY {col}"
    )


VALUES = [
    ("accepted_values:weather_impact.day_type", _values("m_impact", "day_type")),
    ("accepted_values:weather_speed_impact.day_type", _values("m_speed", "day_type")),
]

MATCH_RATE = [(
    "match_rate:int_trips_weather.temperature_2m",
    "SELECT total, matched_rows FROM (SELECT count(*) AS total, count(temperature_2m) AS matched_rows FROM itw) m "
    "WHERE matched_rows < total * 0.95",
)]


def _union(checks) -> str:
    return "\nUNION ALL\n".join(_summary(n, q) for n, q in checks)


# --- Fixed values: labels of the published pivots. ---
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
BUCKETS = ("freezing", "cold", "mild", "warm")
# --- end of fixed values ---
BUCKETS_VALUES = "(VALUES " + ", ".join(f"('{b}', {i})" for i, b in enumerate(BUCKETS, 1)) + ") b(temp_bucket, rank)"
SPEED_GRID_VALUES = (
    "(VALUES "
    + ", ".join(f"('{d}', '{b}', {i})" for d in ("weekday", "weekend") for i, b in enumerate(BUCKETS, 1))
    + ") g(day_type, temp_bucket, rank)"
)

FINAL = {
    "dedup_rows": f"SELECT {BUSINESS}, _ingest_batch FROM dedup",
    "duplicate_count": """
        SELECT CAST(sum(_copies) AS BIGINT) AS total_rows, count(*) AS deduped_rows,
               CAST(sum(_copies) - count(*) AS BIGINT) AS duplicate_rows
        FROM checked""",
    "tag_first_failure": "SELECT * FROM tagged",
    "valid_rows": "SELECT * FROM valid",
    "quarantine_rows": "SELECT * FROM quarantine",
    "quarantine_breakdown": """
        SELECT rejection_reason, count(*) AS quarantined_count FROM quarantine
        GROUP BY 1 ORDER BY quarantined_count DESC, rejection_reason""",
    "gate_report": f"""
        SELECT total_rows, total_rows - deduped_rows AS duplicate_rows, deduped_rows,
               valid_rows, {_pct('valid_rows', 'deduped_rows')} AS valid_pct,
               quarantined_rows, {_pct('quarantined_rows', 'deduped_rows')} AS quarantined_pct,
               null_passenger_count_rows
        FROM (
            SELECT CAST(sum(_copies) AS BIGINT) AS total_rows, count(*) AS deduped_rows,
                   count(*) FILTER (WHERE rejection_reason IS NULL) AS valid_rows,
                   count(*) FILTER (WHERE rejection_reason IS NOT NULL) AS quarantined_rows,
                   count(*) FILTER (WHERE passenger_count IS NULL) AS null_passenger_count_rows
            FROM checked
        ) c""",
    "stg_trips": "SELECT * FROM stg_trips",
    "stg_weather": "SELECT * FROM stg_weather",
    "stg_zones": "SELECT * FROM stg_zones",
    "stg_quarantine": "SELECT * FROM stg_quarantine",
    "enriched_trips": "SELECT * FROM itw",
    "trips_by_hour_weekday": "SELECT * FROM m_hour_weekday",
    "daily_ridership": "SELECT * FROM m_daily ORDER BY trip_date",
    "weather_impact": "SELECT * FROM m_impact ORDER BY day_type, is_precipitation, temp_bucket",
    "demand_by_borough": "SELECT * FROM m_borough ORDER BY pickup_borough, hour_of_day",
    "quarantine_trend": "SELECT * FROM m_trend ORDER BY trip_month, rejection_reason",
    "payment_mix": "SELECT * FROM m_payment ORDER BY trip_count DESC",
    "revenue_efficiency": "SELECT * FROM m_revenue ORDER BY hour_of_day",
    "speed_impact": "SELECT * FROM m_speed ORDER BY day_type, temp_bucket, is_precipitation",
    "quarantine_rate_by_month": f"""
        SELECT trip_month, total_rows, quarantined_rows,
               {_pct('quarantined_rows', 'total_rows')} AS quarantine_rate_pct
        FROM (
            SELECT coalesce(strftime(pickup_ts, '%Y-%m'), 'unknown_month') AS trip_month,
                   count(*) AS total_rows,
                   count(*) FILTER (WHERE rejection_reason IS NOT NULL) AS quarantined_rows
            FROM orders_tagged GROUP BY 1
        ) m ORDER BY trip_month""",
    "quarantine_for_month": """
        SELECT rejection_reason, quarantined_count FROM orders_trend
        WHERE trip_month = '2000-12' ORDER BY quarantined_count DESC, rejection_reason""",
    "reason_share_by_month": f"""
        SELECT trip_month, rejection_reason, quarantined_count, reason_total,
               {_pct('quarantined_count', 'reason_total')} AS share_pct
        FROM (
            SELECT *, CAST(sum(quarantined_count) OVER (PARTITION BY rejection_reason) AS BIGINT) AS reason_total
            FROM orders_trend
        ) s ORDER BY rejection_reason, trip_month""",
    "pivot_month_reason": """
        SELECT trip_month,
               CAST(coalesce(sum(quarantined_count) FILTER (WHERE rejection_reason = 'negative_total_amount'), 0) AS BIGINT) AS negative_total_amount,
               CAST(coalesce(sum(quarantined_count) FILTER (WHERE rejection_reason = 'non_positive_distance'), 0) AS BIGINT) AS non_positive_distance,
               CAST(coalesce(sum(quarantined_count) FILTER (WHERE rejection_reason = 'null_timestamp'), 0) AS BIGINT) AS null_timestamp,
               CAST(coalesce(sum(quarantined_count) FILTER (WHERE rejection_reason = 'pickup_outside_range'), 0) AS BIGINT) AS pickup_outside_range
        FROM orders_trend WHERE trip_month <> 'unknown_month' GROUP BY 1 ORDER BY 1""",
    "month_bounds": """
        SELECT strftime(min(date_trunc('month', pickup_ts)), '%Y-%m') AS first_month,
               strftime(max(pickup_ts), '%Y-%m') AS last_month,
               CAST(min(date_trunc('month', pickup_ts)) AS DATE) AS start_date,
               last_day(CAST(max(pickup_ts) AS DATE)) AS end_date,
               count(DISTINCT strftime(pickup_ts, '%Y-%m')) AS n_months
        FROM orders_tagged""",
    "payment_code_counts": "SELECT payment_type, count(*) AS cnt FROM valid GROUP BY 1 ORDER BY cnt DESC, payment_type",
    "undocumented_code_share": f"""
        SELECT CAST(0 AS INTEGER) AS code, code_trips, total_trips,
               {_pct('code_trips', 'total_trips')} AS share_pct
        FROM (SELECT count(*) FILTER (WHERE payment_type = 0) AS code_trips, count(*) AS total_trips FROM valid) c""",
    "ratio_outliers": f"""
        SELECT outlier_trips, total_trips, {_pct('outlier_trips', 'total_trips', 4)} AS pct
        FROM (
            SELECT count(*) FILTER (WHERE CASE WHEN trip_distance > 0 THEN total_amount / trip_distance END > 11.9)
                       AS outlier_trips,
                   count(*) AS total_trips
            FROM valid
        ) c""",
    "borough_summary": f"""
        SELECT pickup_borough, total_trips, round(revenue, 0) AS total_revenue,
               {_pct('total_trips', 'sum(total_trips) OVER ()', 1)} AS trip_share_pct,
               {_pct('revenue', 'sum(revenue) OVER ()', 1)} AS revenue_share_pct
        FROM (
            SELECT pickup_borough, CAST(sum(trip_count) AS BIGINT) AS total_trips,
                   sum(total_revenue) AS revenue
            FROM m_borough GROUP BY 1
        ) s ORDER BY total_trips DESC""",
    "dry_vs_wet": f"""
        SELECT dry AS dry_avg_trips_per_hour, wet AS wet_avg_trips_per_hour,
               {_pct('wet - dry', 'dry')} AS change_pct
        FROM (
            SELECT coalesce({_xavg('CASE WHEN NOT is_precipitation THEN avg_trips_per_hour END', 2)}, 0.0) AS dry,
                   coalesce({_xavg('CASE WHEN is_precipitation THEN avg_trips_per_hour END', 2)}, 0.0) AS wet
            FROM m_impact
        ) m""",
    "temp_by_daytype": f"""
        SELECT b.temp_bucket,
               {_xavg("CASE WHEN day_type = 'weekday' THEN avg_trips_per_hour END", 2)} AS weekday,
               {_xavg("CASE WHEN day_type = 'weekend' THEN avg_trips_per_hour END", 2)} AS weekend
        FROM {BUCKETS_VALUES}
        LEFT JOIN m_impact m ON m.temp_bucket = b.temp_bucket
        GROUP BY b.temp_bucket, b.rank ORDER BY b.rank""",
    "pivot_hour_weekday": "SELECT hour_of_day, "
    + ", ".join(
        f"CAST(sum(trip_count) FILTER (WHERE weekday = '{d}') AS BIGINT) AS {d}" for d in WEEKDAYS
    )
    + " FROM m_hour_weekday GROUP BY 1 ORDER BY 1",
    "pivot_hour_borough": "SELECT hour_of_day, "
    + ", ".join(
        f"CAST(coalesce(sum(trip_count) FILTER (WHERE pickup_borough = '{b}'), 0) AS BIGINT) AS \"{b}\""
        for b in ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")
    )
    + " FROM m_borough GROUP BY 1 ORDER BY 1",
    "pivot_speed": f"""
        SELECT g.day_type, g.temp_bucket,
               avg(avg_speed_mph) FILTER (WHERE NOT is_precipitation) AS dry_speed_mph,
               avg(avg_speed_mph) FILTER (WHERE is_precipitation) AS wet_speed_mph
        FROM {SPEED_GRID_VALUES}
        LEFT JOIN m_speed s ON s.day_type = g.day_type AND s.temp_bucket = g.temp_bucket
        GROUP BY g.day_type, g.temp_bucket, g.rank ORDER BY g.day_type, g.rank""",
    "expect_not_null": _union(NOT_NULL),
    "expect_unique": _union(UNIQUE),
    "expect_values": _union(VALUES),
    "expect_match_rate": f"""
        SELECT total, matched_rows,
               {_ratio('matched_rows', 'total', 4)} AS match_rate,
               CAST(0.95 AS DOUBLE) AS threshold,
               NOT (matched_rows < total * 0.95) AS passed
        FROM (SELECT count(*) AS total, count(temperature_2m) AS matched_rows FROM itw) m""",
    "run_expectations": _union(NOT_NULL + UNIQUE + VALUES + MATCH_RATE),
    "hourly_completeness": """
        SELECT DATE '2024-01-01' AS start_date, DATE '2024-01-30' AS end_date,
               CAST(720 AS BIGINT) AS expected_rows, count(*) AS actual_rows, count(*) = 720 AS complete
        FROM stg_weather""",
    "missing_hours": """
        SELECT s.missing_hour FROM (
            SELECT * FROM generate_series(TIMESTAMP '2024-01-01 00:00:00', TIMESTAMP '2024-01-30 23:00:00',
                                          INTERVAL 1 HOUR) g(missing_hour)
        ) s
        WHERE NOT EXISTS (SELECT 1 FROM stg_weather w WHERE w.weather_hour_local = s.missing_hour)
        ORDER BY 1""",
    "hourly_payload_rows": """
        SELECT * REPLACE (CASE WHEN day(weather_hour_local) % 7 <> 2 THEN snowfall END AS snowfall)
        FROM stg_weather WHERE day(weather_hour_local) % 7 NOT IN (3, 4)""",
    "bad_payload_days": """
        SELECT CAST(weather_hour_local AS DATE) AS day
        FROM stg_weather WHERE day(weather_hour_local) % 7 IN (3, 4) GROUP BY 1""",
    "file_row_counts": "SELECT 'events.parquet' AS file_name, count(*) AS row_count FROM events",
    "expectation_failures": """
        SELECT 'not_null:raw_trips.tpep_pickup_datetime' AS expectation, count(*) AS failing_rows, count(*) = 0 AS passed
        FROM raw_trips WHERE tpep_pickup_datetime IS NULL
        UNION ALL
        SELECT 'unique:orders.o_custkey', count(*), count(*) = 0
        FROM (SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL GROUP BY 1 HAVING count(*) > 1) u
        UNION ALL
        SELECT 'accepted_values:events.event_type', count(*), count(*) = 0
        FROM (SELECT event_type FROM events WHERE event_type IS NOT NULL AND event_type NOT IN ('click', 'view') GROUP BY 1) v
        UNION ALL
        SELECT 'match_rate:raw_trips.tpep_dropoff_datetime', count(*), count(*) = 0
        FROM (SELECT count(*) AS total, count(tpep_dropoff_datetime) AS matched_rows FROM raw_trips) m
        WHERE matched_rows < total * 0.999""",
    "dedup_bucketed": f"""
        SELECT {BUSINESS}, count(*) AS _copies, '2024-0' || min((PULocationID + _ingest_batch) % 3 + 1) AS file_month
        FROM raw_trips GROUP BY ALL""",
    "read_months": """
        SELECT strftime(o_orderdate, '%Y') AS month, count(*) AS row_count, count(DISTINCT o_custkey) AS customers
        FROM orders GROUP BY 1""",
    "load_months": """
        SELECT strftime(o_orderdate, '%Y') AS month, count(*) AS row_count,
               CASE WHEN strftime(o_orderdate, '%Y') = (SELECT max(strftime(o_orderdate, '%Y')) FROM orders)
                    THEN 'forced' ELSE 'skipped' END AS second_run
        FROM orders GROUP BY 1""",
    "read_zone_csv": """
        SELECT CAST(n_nationkey AS INTEGER) AS "LocationID", r_name AS "Borough",
               CASE WHEN n_nationkey % 5 = 0 THEN 'N/A' ELSE n_name END AS "Zone",
               CASE WHEN n_nationkey % 7 = 0 THEN NULL ELSE r_name END AS service_zone
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "publish_table": """
        SELECT coalesce(strftime(pickup_ts, '%Y-%m'), 'unknown_month') AS trip_month, count(*) AS trips
        FROM stg_trips GROUP BY 1""",
}


FINAL["load_changed_months"] = """
        SELECT strftime(o_orderdate, '%Y') AS month, count(*) * CASE WHEN is_last THEN 2 ELSE 1 END AS row_count, 'skipped' AS second_run,
               CASE WHEN is_last THEN 'loaded' ELSE 'skipped' END AS third_run
        FROM (SELECT o_orderdate, year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders) AS is_last FROM orders) o
        GROUP BY 1, is_last"""
FINAL["nanosecond_hours"] = "SELECT * FROM stg_weather"
FINAL["month_bounds_of_list"] = """
        SELECT strftime(min(date_trunc('month', pickup_ts)), '%Y-%m-%d') AS start_date,
               strftime(last_day(CAST(max(pickup_ts) AS DATE)), '%Y-%m-%d') AS end_date
        FROM orders_tagged"""
FINAL["published_enriched_view"] = FINAL["enriched_trips"]
FINAL["published_marts"] = " UNION ALL ".join(
    f"SELECT '{mart}' AS mart, count(*) AS n_rows, CAST(sum({total}) AS BIGINT) AS total FROM {table}"
    for mart, table, total in (
        ("trips_by_hour_weekday", "m_hour_weekday", "trip_count"), ("daily_weather_ridership", "m_daily", "trip_count"),
        ("weather_impact", "m_impact", "total_trips"), ("demand_by_borough", "m_borough", "trip_count"),
        ("payment_mix", "m_payment", "trip_count"), ("revenue_efficiency_by_hour", "m_revenue", "trip_count"),
        ("weather_speed_impact", "m_speed", "trip_count"), ("dq_quarantine_trend", "m_trend", "quarantined_count"),
    ))
FINAL["payment_mix_in_order"] = "SELECT *, row_number() OVER (ORDER BY trip_count DESC, payment_type_label) AS position FROM m_payment"
FINAL["daily_ridership_in_order"] = "SELECT *, row_number() OVER (ORDER BY trip_date NULLS FIRST) AS position FROM m_daily"
FINAL["quarantine_breakdown_in_order"] = """
        SELECT *, row_number() OVER (ORDER BY quarantined_count DESC, rejection_reason) AS position
        FROM (SELECT rejection_reason, count(*) AS quarantined_count FROM quarantine GROUP BY 1) q"""
FINAL["weather_impact_merged"] = FINAL["weather_impact"]
FINAL["daily_ridership_merged"] = FINAL["daily_ridership"]


def oracle_sql() -> dict[str, str]:
    return {name: PREFIX + final for name, final in FINAL.items()}
