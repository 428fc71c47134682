"""Column expressions shared by the gate, the enrichment and the marts.

Every helper returns a built-in Spark ``Column`` so that it stays inside
whole-stage code generation; none of them is a Python UDF.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values: labels and thresholds the published marts are keyed on. ---
WEEKEND_DAYS = ("Saturday", "Sunday")
WEEKDAY_ORDER = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
DAY_TYPE_WEEKDAY = "weekday"
DAY_TYPE_WEEKEND = "weekend"
TEMPERATURE_BUCKETS = ((0, "freezing"), (10, "cold"), (20, "mild"))
TEMPERATURE_ELSE = "warm"
TEMPERATURE_BUCKET_ORDER = ("freezing", "cold", "mild", "warm")
PRECIPITATION_THRESHOLD_MM = 0.1
PAYMENT_LABELS = {
    1: "Credit card",
    2: "Cash",
    3: "No charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided trip",
    0: "Undocumented code (0)",
}
PAYMENT_ELSE = "Other"
UNKNOWN_MONTH = "unknown_month"
# --- end of fixed values ---


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hour_bucket(ts: str | Column) -> Column:
    """Truncate a timestamp to the start of its hour (O-67)."""
    return F.date_trunc("hour", col(ts))


def hour_of_day(ts: str | Column) -> Column:
    """Hour 0-23 as int (O-68)."""
    return F.hour(col(ts))


def calendar_date(ts: str | Column) -> Column:
    """Date part of a timestamp (O-69)."""
    return F.to_date(col(ts))


def weekday_name(ts: str | Column) -> Column:
    """Full English weekday name, e.g. ``Monday``, as ``date_format(ts, 'EEEE')`` gives (O-70).

    Looked up from ``dayofweek`` (1 = Sunday) in a constant array: integer
    arithmetic per row instead of running a date formatter over every trip.
    """
    sunday_first = WEEKDAY_ORDER[-1:] + WEEKDAY_ORDER[:-1]
    return F.element_at(F.array(*[F.lit(d) for d in sunday_first]), F.dayofweek(col(ts)))


def month_label(ts: str | Column) -> Column:
    """``yyyy-MM`` label (O-71)."""
    return F.date_format(col(ts), "yyyy-MM")


def month_label_or_unknown(ts: str | Column) -> Column:
    """Month label, with rows lacking a timestamp grouped under one label (O-74)."""
    return F.coalesce(month_label(ts), F.lit(UNKNOWN_MONTH))


def month_start(ts: str | Column) -> Column:
    """First day of the month as a ``date``: a fixed-width grouping key.

    Grouping by it and formatting the label once per group avoids building a
    string for every row.
    """
    return F.trunc(F.to_date(col(ts)), "MM")


def seconds_between(start: str | Column, end: str | Column) -> Column:
    """Whole-second epoch difference (``unix_timestamp`` drops sub-second parts first)."""
    return F.unix_timestamp(col(end)) - F.unix_timestamp(col(start))


def minutes_between(start: str | Column, end: str | Column) -> Column:
    """Whole-second epoch difference divided by 60, as floating point (O-72)."""
    return seconds_between(start, end) / 60


def flag_above(value: str | Column, threshold: float) -> Column:
    """Boolean ``value > threshold``; a NULL value gives ``false`` (O-78)."""
    return F.when(col(value) > threshold, F.lit(True)).otherwise(F.lit(False))


def is_precipitation(precipitation: str | Column) -> Column:
    return flag_above(precipitation, PRECIPITATION_THRESHOLD_MM)


def day_type(weekday: str | Column) -> Column:
    """``weekend`` for Saturday/Sunday, else ``weekday`` (O-75)."""
    return (
        F.when(col(weekday).isin(*WEEKEND_DAYS), F.lit(DAY_TYPE_WEEKEND))
        .otherwise(F.lit(DAY_TYPE_WEEKDAY))
    )


def bucketize(
    value: str | Column,
    upper_bounds: Sequence[tuple[float, str]],
    else_label: str,
    null_label: str | None = None,
) -> Column:
    """Half-open threshold buckets: the first ``value < bound`` wins (O-76).

    A NULL value fails every comparison and lands in ``else_label``, as a
    searched CASE does; pass ``null_label`` to give NULLs their own bucket.
    """
    v = col(value)
    expr = None
    if null_label is not None:
        expr = F.when(v.isNull(), F.lit(null_label))
    for bound, label in upper_bounds:
        expr = F.when(v < bound, F.lit(label)) if expr is None else expr.when(v < bound, F.lit(label))
    return expr.otherwise(F.lit(else_label))


def temperature_bucket(temperature: str | Column) -> Column:
    return bucketize(temperature, TEMPERATURE_BUCKETS, TEMPERATURE_ELSE)


def label_map(value: str | Column, mapping: Mapping[object, str], default: str) -> Column:
    """Simple CASE: code -> label, anything else (NULL included) -> default (O-77)."""
    v = col(value)
    expr = None
    for code, label in mapping.items():
        expr = F.when(v == code, F.lit(label)) if expr is None else expr.when(v == code, F.lit(label))
    return expr.otherwise(F.lit(default))


def payment_label(payment_type: str | Column) -> Column:
    return label_map(payment_type, PAYMENT_LABELS, PAYMENT_ELSE)


def ratio_where_positive(numerator: str | Column, denominator: str | Column) -> Column:
    """``num / den`` where ``den > 0``, else NULL, so an average skips it (O-52).

    The guard sits inside the CASE, so a zero divisor is never evaluated under
    ANSI mode.
    """
    return F.when(col(denominator) > 0, col(numerator) / col(denominator))


def speed_mph(distance: str | Column, minutes: str | Column) -> Column:
    """Miles per hour from distance and minutes, NULL when minutes <= 0 (O-79)."""
    return F.when(col(minutes) > 0, col(distance) / (col(minutes) / 60.0))


def category_rank(value: str | Column, order: Iterable[str]) -> Column:
    """1-based position of ``value`` in a fixed category order, for sorting (O-85)."""
    return F.array_position(F.array(*[F.lit(x) for x in order]), col(value))
