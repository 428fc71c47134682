"""Calendar bounds and completeness of an hourly series (O-13..O-15).

The hour spine is generated with ``spark.range``, so it is split across tasks
like any other table instead of being one array in one row.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

log = logging.getLogger(__name__)


def _month_start(label: str, ahead: int = 0) -> date:
    """First day of the month of a ``yyyy-MM`` label, or of one ``ahead`` months later."""
    first = date.fromisoformat(f"{label}-01")
    months = first.year * 12 + first.month - 1 + ahead
    return date(months // 12, months % 12 + 1, 1)


def month_bounds(months: Sequence[str]) -> tuple[str, str]:
    """First day of the first listed month and last day of the last one (O-14).

    The list order is taken as given: the bounds come from its ends.  The last
    day is the one before the month after.
    """
    return _month_start(months[0]).isoformat(), (_month_start(months[-1], 1) - timedelta(days=1)).isoformat()


def month_bounds_of(df: DataFrame, ts_col: str) -> DataFrame:
    """One row: first and last month present in ``ts_col`` and their inclusive date bounds."""
    ts = F.col(ts_col)
    return df.agg(
        F.min(F.trunc(F.to_date(ts), "MM")).alias("start_date"),
        F.max(F.to_date(ts)).alias("last_day_seen"),
        F.count_distinct(F.trunc(F.to_date(ts), "MM")).alias("n_months"),
    ).select(
        F.date_format("start_date", "yyyy-MM").alias("first_month"),
        F.date_format("last_day_seen", "yyyy-MM").alias("last_month"),
        "start_date",
        F.last_day("last_day_seen").alias("end_date"),
        "n_months",
    )


def expected_hours(start_date: str, end_date: str) -> int:
    """Length of the hour spine of the inclusive day range ``[start_date, end_date]``."""
    after = datetime.fromisoformat(end_date) + timedelta(days=1)
    return int((after - datetime.fromisoformat(start_date)) / timedelta(hours=1))


def hour_spine(spark: SparkSession, start_date: str, end_date: str, name: str = "hour") -> DataFrame:
    """Every hour from ``start_date 00:00`` to ``end_date 23:00`` as ``timestamp``."""
    start = F.lit(start_date).cast("timestamp")
    return spark.range(expected_hours(start_date, end_date)).select(
        F.timestamp_add("HOUR", F.col("id"), start).alias(name)
    )


def hourly_completeness(df: DataFrame, start_date: str, end_date: str) -> DataFrame:
    """One row: expected hours for the range, rows present, and whether they agree (O-13)."""
    expected = expected_hours(start_date, end_date)
    return df.agg(F.count(F.lit(1)).alias("actual_rows")).select(
        F.lit(start_date).cast("date").alias("start_date"),
        F.lit(end_date).cast("date").alias("end_date"),
        F.lit(expected).cast("bigint").alias("expected_rows"),
        "actual_rows",
        (F.col("actual_rows") == expected).alias("complete"),
    )


def check_hourly_completeness(df: DataFrame, start_date: str, end_date: str) -> bool:
    """Log a warning (never fail) when the row count differs from the expected hours."""
    row = hourly_completeness(df, start_date, end_date).first()
    if not row["complete"]:
        log.warning(
            "incomplete hourly series: %d of %d hours present between %s and %s",
            row["actual_rows"], row["expected_rows"], start_date, end_date,
        )
    return bool(row["complete"])


def missing_hours(df: DataFrame, start_date: str, end_date: str, hour_col: str = "weather_hour_local") -> DataFrame:
    """Hours of the range with no row in ``df`` (O-15): spine anti-joined with the series."""
    spine = hour_spine(df.sparkSession, start_date, end_date, name="missing_hour")
    present = df.select(F.col(hour_col).cast("timestamp").alias("present_hour"))
    return spine.join(present, spine.missing_hour == present.present_hour, "left_anti").orderBy("missing_hour")
