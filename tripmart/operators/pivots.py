"""Matrix views of the marts (O-63..O-66), the data half of the original charts.

Where the column labels are a fixed set (weekdays, day types, precipitation
flag) they are passed to ``pivot`` explicitly, which spares Spark the extra
job that discovers them; where they come from the data (boroughs, reasons),
Spark discovers them over the already aggregated mart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.functions import exprs as X
from tripmart.session import ensure_checkpoint_dir


def pivot_counts(
    mart: DataFrame,
    rows: str,
    cols: str,
    value: str,
    col_values=None,
    fill: int | None = None,
) -> DataFrame:
    """``rows`` x ``cols`` matrix of ``sum(value)``; ``fill`` replaces missing cells.

    Without ``col_values`` Spark first runs a job to find the distinct column
    labels, then the pivot itself; on a lazily defined mart both would
    recompute its whole lineage back to the fact scan.  The (small,
    aggregated) mart is therefore checkpointed once and both read that copy.
    """
    if col_values is None:
        ensure_checkpoint_dir(mart.sparkSession)
        mart = mart.checkpoint(eager=True)
    out = mart.groupBy(rows).pivot(cols, list(col_values) if col_values is not None else None).agg(F.sum(value))
    if fill is not None:
        out = out.na.fill(fill)
    return out.orderBy(rows)


def pivot_hour_weekday(by_hour_weekday: DataFrame) -> DataFrame:
    """Hour of day x weekday trip counts, weekdays in calendar order (O-63, O-85)."""
    return pivot_counts(by_hour_weekday, "hour_of_day", "weekday", "trip_count", X.WEEKDAY_ORDER)


def pivot_hour_borough(demand: DataFrame) -> DataFrame:
    """Hour of day x borough trip counts, missing cells as 0 (O-64)."""
    return pivot_counts(demand, "hour_of_day", "pickup_borough", "trip_count", fill=0)


def pivot_month_reason(trend: DataFrame) -> DataFrame:
    """Month x reason quarantine counts without ``unknown_month``, missing cells as 0 (O-65)."""
    known = trend.filter(F.col("trip_month") != X.UNKNOWN_MONTH)
    return pivot_counts(known, "trip_month", "rejection_reason", "quarantined_count", fill=0)


def pivot_speed(speed: DataFrame, day_type: str | None = None) -> DataFrame:
    """Mean speed by (day type, temperature bucket) rows and precipitation columns (O-66).

    Every day type x bucket pair is a row, in bucket order; an absent pair
    keeps NULL speeds.
    """
    if day_type is not None:
        speed = speed.filter(F.col("day_type") == day_type)
        day_types = [day_type]
    else:
        day_types = [X.DAY_TYPE_WEEKDAY, X.DAY_TYPE_WEEKEND]
    pivoted = (
        speed.groupBy("day_type", "temp_bucket")
        .pivot("is_precipitation", [False, True])
        .agg(F.avg("avg_speed_mph"))
        .withColumnsRenamed({"false": "dry_speed_mph", "true": "wet_speed_mph"})
    )
    pairs = [F.struct(F.lit(d).alias("day_type"), F.lit(b).alias("temp_bucket"))
             for d in day_types for b in X.TEMPERATURE_BUCKET_ORDER]
    grid = speed.sparkSession.range(1).select(F.inline(F.array(*pairs)))
    return (
        grid.join(F.broadcast(pivoted), ["day_type", "temp_bucket"], "left")
        .orderBy("day_type", X.category_rank("temp_bucket", X.TEMPERATURE_BUCKET_ORDER))
    )
