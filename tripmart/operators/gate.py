"""Data-quality gate: full-row dedup, first-failing-rule tagging, valid/quarantine split.

Plan shape (design rule: dedup *before* tagging).  The rejection reason depends
only on business columns, so deduplicating first is semantically free and lets
the dedup run as a ``HashAggregate`` with map-side partial aggregation: a group
of copies, however large, collapses to one row per map task before the
shuffle.  Tagging is then a projection of the aggregate output, the valid and
quarantine branches are filters, and the report is one more aggregate.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.functions.exact import rounded_ratio, wide
from tripmart.functions.exprs import col

REASON_COL = "rejection_reason"
METADATA_PREFIX = "_"

# --- Fixed values: rejection labels, in rule order (the first failing rule wins). ---
NULL_TIMESTAMP = "null_timestamp"
DROPOFF_BEFORE_PICKUP = "dropoff_before_pickup"
PICKUP_OUTSIDE_RANGE = "pickup_outside_range"
NON_POSITIVE_DISTANCE = "non_positive_distance"
NEGATIVE_TOTAL_AMOUNT = "negative_total_amount"
REJECTION_REASONS = (
    NULL_TIMESTAMP,
    DROPOFF_BEFORE_PICKUP,
    PICKUP_OUTSIDE_RANGE,
    NON_POSITIVE_DISTANCE,
    NEGATIVE_TOTAL_AMOUNT,
)
# --- end of fixed values ---

Rule = tuple[str, Column]
Bound = str | date | datetime


# ---------------------------------------------------------------- rules (O-21..O-25)

def rule_not_null(*columns: str | Column) -> Column:
    """Fails when any of the columns is NULL."""
    failed = None
    for c in columns:
        failed = col(c).isNull() if failed is None else failed | col(c).isNull()
    return failed


def rule_ordered(earlier: str | Column, later: str | Column) -> Column:
    """Fails when ``later < earlier`` (strict: equal values pass)."""
    return col(later) < col(earlier)


def rule_in_range(value: str | Column, start: Bound, end: Bound, mode: str = "end_exclusive") -> Column:
    """Fails when ``value`` lies outside ``[start, end)`` or ``[start, end]``.

    ``mode='end_exclusive'``: fails on ``value < start`` or ``value >= end``;
    pass the first instant *after* the range as ``end``.

    ``mode='end_inclusive_literal'``: fails on ``value < start`` or
    ``value > end`` with ``end`` compared as given.  A date-only string such as
    ``'2026-05-31'`` casts to midnight, so every later time on that day fails;
    this reproduces the original gate exactly.
    """
    v = col(value)
    lo, hi = F.lit(start), F.lit(end)
    if mode == "end_exclusive":
        return (v < lo) | (v >= hi)
    if mode == "end_inclusive_literal":
        return (v < lo) | (v > hi)
    raise ValueError(f"unknown range mode: {mode!r}")


def rule_positive(value: str | Column) -> Column:
    """Fails on ``value <= 0``; NULL and NaN pass (NaN sorts above every number)."""
    return col(value) <= 0


def rule_non_negative(value: str | Column) -> Column:
    """Fails on ``value < 0``; NULL and NaN pass."""
    return col(value) < 0


def trip_rules(
    start: Bound,
    end: Bound,
    range_mode: str = "end_exclusive",
    pickup: str = "tpep_pickup_datetime",
    dropoff: str = "tpep_dropoff_datetime",
    distance: str = "trip_distance",
    total: str = "total_amount",
) -> list[Rule]:
    """The five trip rules in their semantic order."""
    return [
        (NULL_TIMESTAMP, rule_not_null(pickup, dropoff)),
        (DROPOFF_BEFORE_PICKUP, rule_ordered(pickup, dropoff)),
        (PICKUP_OUTSIDE_RANGE, rule_in_range(pickup, start, end, range_mode)),
        (NON_POSITIVE_DISTANCE, rule_positive(distance)),
        (NEGATIVE_TOTAL_AMOUNT, rule_non_negative(total)),
    ]


# ---------------------------------------------------------------- tagging (O-20)

def first_failure(rules: Sequence[Rule]) -> Column:
    """One flat CASE: label of the first rule whose condition is true, else NULL."""
    if not rules:
        return F.lit(None).cast("string")
    expr = None
    for label, failed in rules:
        expr = F.when(failed, F.lit(label)) if expr is None else expr.when(failed, F.lit(label))
    return expr


def tag_first_failure(df: DataFrame, rules: Sequence[Rule], reason_col: str = REASON_COL) -> DataFrame:
    """Add ``reason_col`` = label of the first failing rule (NULL = valid)."""
    return df.withColumn(reason_col, first_failure(rules))


# ---------------------------------------------------------------- dedup (O-26..O-28)

def business_keys(df: DataFrame, prefix: str = METADATA_PREFIX) -> list[str]:
    """Columns that identify a row: every column not starting with ``prefix``."""
    return [c for c in df.columns if not c.startswith(prefix)]


_FIXED_WIDTH = (
    T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
    T.DateType, T.TimestampType, T.TimestampNTZType, T.DecimalType,
)
_CODES = ("_meta_code", "_meta_code_2")
_TIE_SLOTS = 2 ** 62
#: Above every order key: where a NULL order stands.
_LAST = 10 ** 38 - 1


def _fixed_width(data_type: T.DataType) -> bool:
    return isinstance(data_type, _FIXED_WIDTH)


def _order_base(order: Column, data_type: T.DataType) -> Column | None:
    """A 64-bit integer that orders as ``order`` does, or None for a type that has none."""
    if isinstance(data_type, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType)):
        return order.cast("long")
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(order.cast("timestamp"))
    if isinstance(data_type, T.DateType):
        return F.unix_date(order)
    if isinstance(data_type, T.DecimalType) and data_type.precision <= 18:
        return (order * F.lit(10 ** data_type.scale)).cast("long")
    return None


def _survivor_key(order: Column, data_type: T.DataType, tie: Column) -> Column:
    """One fixed-width key: by ``order``, NULL last, then by 62 bits of the hash of all metadata.

    Floating-point and wide decimal orders can't share a decimal with the
    hash: there, copies that agree in the order may yield any of them.
    """
    base = _order_base(order, data_type)
    if base is None:
        return F.coalesce(order, F.lit(float("inf")).cast(data_type) if isinstance(data_type, (T.FloatType, T.DoubleType)) else order)
    whole = base.cast("decimal(38,0)") * F.lit(_TIE_SLOTS).cast("decimal(38,0)") + F.pmod(tie, F.lit(_TIE_SLOTS))
    return F.coalesce(whole.cast("decimal(38,0)"), F.lit(str(_LAST)).cast("decimal(38,0)") - F.pmod(tie, F.lit(_TIE_SLOTS)))


def drop_duplicate_rows(
    df: DataFrame,
    keys: Sequence[str] | None = None,
    survivor_order: str | None = None,
    copies_col: str | None = None,
    weight_col: str | None = None,
) -> DataFrame:
    """Keep one row per distinct ``keys`` tuple.

    Metadata columns (those outside ``keys``) come from one survivor: the copy
    with the smallest ``survivor_order`` (default: the first fixed-width
    metadata column), a NULL order last, ties broken by a hash of all
    metadata; the same one in whatever order the rows arrive (but see
    ``_survivor_key`` for floating-point orders).  Every aggregate buffer is
    fixed-width, so Spark plans a ``HashAggregate`` with partial aggregation
    on the map side: a group of copies, however large, collapses inside each
    map task before the shuffle.  String metadata (file paths, month labels)
    would force a sort-based aggregate, so it travels through the dedup as
    128 bits of hashes and is decoded afterwards by a join with its distinct
    values, one plan however many there are; the planner picks the join.
    Ordering survivors by a string column needs that string in the aggregate
    and takes the sort-based plan.
    ``copies_col`` adds the number of raw rows each output row stands for,
    from which the gate report derives the pre-dedup total without a second
    scan; with ``weight_col`` a row stands for that many already, and the
    column is dropped.
    """
    keys = list(keys) if keys is not None else business_keys(df)
    meta = [c for c in df.columns if c not in keys and c != weight_col]
    strings = [m for m in meta if not _fixed_width(df.schema[m].dataType)]
    copies = F.sum(weight_col) if weight_col else F.count(F.lit(1))
    counted = [copies.alias(copies_col)] if copies_col else []
    ordered = [c for c in df.columns if c != weight_col] + ([copies_col] if copies_col else [])
    if not meta:
        return df.groupBy(*keys).agg(*counted).select(*ordered) if counted else df.select(*keys).distinct()
    if survivor_order in strings:
        kept = [F.min_by(m, F.col(survivor_order)).alias(m) for m in meta]
        return df.groupBy(*keys).agg(*kept, *counted).select(*ordered)

    codes = [F.xxhash64(*strings), F.xxhash64(F.lit(1), *strings)] if strings else []
    source = df.withColumns(dict(zip(_CODES, codes)))
    fixed = [m for m in meta if m not in strings]
    order = survivor_order or (fixed[0] if fixed else None)
    tie = F.xxhash64(*meta)
    key = _survivor_key(F.col(order), df.schema[order].dataType, tie) if order else tie
    carried = fixed + list(_CODES[:len(codes)])
    out = source.groupBy(*keys).agg(*[F.min_by(m, key).alias(m) for m in carried], *counted)
    if strings:
        values = source.select(*_CODES, *strings).distinct()
        out = out.join(values, list(_CODES), "left").drop(*_CODES)
    return out.select(*ordered)


def duplicate_summary(deduped: DataFrame, copies_col: str) -> DataFrame:
    """One row: rows before dedup, after dedup, and removed duplicates (O-28)."""
    return deduped.agg(
        F.sum(copies_col).cast("bigint").alias("total_rows"),
        F.count(F.lit(1)).alias("deduped_rows"),
    ).withColumn("duplicate_rows", F.col("total_rows") - F.col("deduped_rows"))


# ---------------------------------------------------------------- split and report (O-29..O-33)

def split(tagged: DataFrame, reason_col: str = REASON_COL) -> tuple[DataFrame, DataFrame]:
    """(valid rows without the reason column, quarantined rows with it)."""
    reason = F.col(reason_col)
    valid = tagged.filter(reason.isNull()).drop(reason_col)
    quarantine = tagged.filter(reason.isNotNull())
    return valid, quarantine


def drop_null(df: DataFrame, column: str) -> DataFrame:
    """Drop rows whose ``column`` is NULL (O-30)."""
    return df.filter(F.col(column).isNotNull())


def _pct(part: Column, whole: Column) -> Column:
    """Exact ``round(part * 100 / whole, 2)`` for counts; NULL when ``whole`` is 0."""
    return rounded_ratio(wide(part) * 100, whole, 2)


def gate_report(
    tagged: DataFrame,
    copies_col: str,
    reason_col: str = REASON_COL,
    flag_null_col: str = "passenger_count",
) -> DataFrame:
    """One-row report computed in a single aggregate over the tagged rows (P2).

    Percentages use the deduplicated count as denominator.  ``flag_null_col``
    is a flag-only metric: rows with it NULL stay valid and are only counted.
    """
    counts = tagged.agg(*[c.alias(name) for name, c in report_counts(copies_col, reason_col, flag_null_col).items()])
    return _report(counts, flag_null_col)


def report_counts(copies_col: str, reason_col: str = REASON_COL, flag_null_col: str = "passenger_count") -> dict[str, Column]:
    """The aggregates that the report is made of; they can be observed while the tagged rows are written."""
    reason = F.col(reason_col)
    return {
        "total_rows": F.sum(copies_col).cast("bigint"),
        "deduped_rows": F.count(F.lit(1)),
        "valid_rows": F.count_if(reason.isNull()),
        "quarantined_rows": F.count_if(reason.isNotNull()),
        "null_flag_rows": F.count_if(F.col(flag_null_col).isNull()),
    }


def report_of_counts(spark: SparkSession, counts: Mapping[str, int], flag_null_col: str = "passenger_count") -> DataFrame:
    """``gate_report`` from counts that have been taken.  Without any row the total is NULL, as its sum is."""
    names = ("total_rows", "deduped_rows", "valid_rows", "quarantined_rows", "null_flag_rows")
    values = {n: counts[n] if n != "total_rows" or counts["deduped_rows"] else None for n in names}
    return _report(spark.range(1, numPartitions=1).select(*[F.lit(v).cast("bigint").alias(n) for n, v in values.items()]), flag_null_col)


def _report(counts: DataFrame, flag_null_col: str) -> DataFrame:
    return counts.select(
        "total_rows",
        (F.col("total_rows") - F.col("deduped_rows")).alias("duplicate_rows"),
        "deduped_rows",
        "valid_rows",
        _pct(F.col("valid_rows"), F.col("deduped_rows")).alias("valid_pct"),
        "quarantined_rows",
        _pct(F.col("quarantined_rows"), F.col("deduped_rows")).alias("quarantined_pct"),
        F.col("null_flag_rows").alias(f"null_{flag_null_col}_rows"),
    )


def reason_counts(rules: Sequence[Rule], reason_col: str = REASON_COL) -> dict[str, Column]:
    """Rows per rejection reason, one aggregate each; the labels are those of the rules."""
    return {label: F.count_if(F.col(reason_col) == label) for label, _ in rules}


def breakdown_of_counts(spark: SparkSession, counts: Mapping[str, int], reason_col: str = REASON_COL) -> DataFrame:
    """``quarantine_breakdown`` from counts that have been taken."""
    found = sorted(((n, label) for label, n in counts.items() if n), key=lambda x: (-x[0], x[1]))
    rows = [F.struct(F.lit(label).alias(reason_col), F.lit(n).cast("bigint").alias("quarantined_count")) for n, label in found]
    if not rows:
        return spark.createDataFrame([], f"{reason_col} string, quarantined_count bigint")
    return spark.range(1, numPartitions=1).select(F.inline(F.array(*rows)))


def quarantine_breakdown(quarantine: DataFrame, reason_col: str = REASON_COL) -> DataFrame:
    """Quarantined rows per reason, largest first (O-33)."""
    return (
        quarantine.groupBy(reason_col)
        .agg(F.count(F.lit(1)).alias("quarantined_count"))
        .orderBy(F.desc("quarantined_count"), reason_col)
    )
