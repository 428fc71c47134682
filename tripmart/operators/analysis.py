"""Second-level findings over the marts and the silver tables (O-41, O-42, O-54..O-62).

Each function is a DataFrame query; none pulls a mart to the driver.  Ratios
use ``try_divide`` or a guarded CASE so an empty group never divides by zero
under ANSI mode, and unrounded floating means are rounded to fixed digits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmart.functions import exact, exprs as X

REASON_COL = "rejection_reason"


def _n() -> F.Column:
    return F.count(F.lit(1))


def _pct(part: F.Column, whole: F.Column, digits: int = 2) -> F.Column:
    """Exact ``round(part * 100 / whole, digits)`` for integer counts; NULL when ``whole`` is 0."""
    return exact.rounded_ratio(exact.wide(part) * 100, whole, digits)


def quarantine_rate_by_month(tagged: DataFrame, ts_col: str = "pickup_ts", reason_col: str = REASON_COL) -> DataFrame:
    """Quarantined share of all rows per month, denominators taken from the data (O-41, O-62).

    One conditional aggregate over the tagged rows: a month with no
    quarantined row gets rate 0 rather than disappearing.
    """
    return (
        tagged.groupBy(X.month_start(ts_col).alias("month_start"))
        .agg(
            _n().alias("total_rows"),
            F.count_if(F.col(reason_col).isNotNull()).alias("quarantined_rows"),
        )
        .select(
            X.month_label_or_unknown("month_start").alias("trip_month"),
            "total_rows",
            "quarantined_rows",
            _pct(F.col("quarantined_rows"), F.col("total_rows")).alias("quarantine_rate_pct"),
        )
        .orderBy("trip_month")
    )


def quarantine_for_month(trend: DataFrame, month: str) -> DataFrame:
    """One month's quarantine reasons, largest first (O-60)."""
    return (
        trend.filter(F.col("trip_month") == month)
        .select(REASON_COL, "quarantined_count")
        .orderBy(F.desc("quarantined_count"), REASON_COL)
    )


def reason_share_by_month(trend: DataFrame) -> DataFrame:
    """For every reason, each month's share of that reason's rejections (O-61).

    The window runs over the trend mart, which holds one row per month and
    reason, so a partition is at most one row per month.
    """
    per_reason = Window.partitionBy(REASON_COL)
    return (
        trend.withColumn("reason_total", F.sum("quarantined_count").over(per_reason))
        .withColumn("share_pct", _pct(F.col("quarantined_count"), F.col("reason_total")))
        .orderBy(REASON_COL, "trip_month")
    )


def payment_code_counts(trips: DataFrame, code_col: str = "payment_type") -> DataFrame:
    """Trips per raw payment code (NULL included), largest first (O-54)."""
    return trips.groupBy(code_col).agg(_n().alias("cnt")).orderBy(F.desc("cnt"), code_col)


def code_share(trips: DataFrame, code: int = 0, code_col: str = "payment_type") -> DataFrame:
    """Share of trips carrying one code, e.g. the undocumented code 0 (O-55)."""
    return trips.agg(
        F.count_if(F.col(code_col) == code).alias("code_trips"),
        _n().alias("total_trips"),
    ).select(
        F.lit(code).cast("int").alias("code"),
        "code_trips",
        "total_trips",
        _pct(F.col("code_trips"), F.col("total_trips")).alias("share_pct"),
    )


def ratio_outliers(
    trips: DataFrame,
    numerator: str = "total_amount",
    denominator: str = "trip_distance",
    threshold: float = 100.0,
) -> DataFrame:
    """Trips with ``numerator / denominator > threshold`` (denominator > 0), and their share (O-42, O-56).

    The share's denominator (all trips) comes from the same single scan as a
    second count instead of a scalar subquery.
    """
    ratio = X.ratio_where_positive(numerator, denominator)
    return trips.agg(
        F.count_if(ratio > threshold).alias("outlier_trips"),
        _n().alias("total_trips"),
    ).select(
        "outlier_trips",
        "total_trips",
        _pct(F.col("outlier_trips"), F.col("total_trips"), 4).alias("pct"),
    )


def borough_summary(demand: DataFrame) -> DataFrame:
    """Trips and revenue per borough with their shares of the total (O-57).

    The share window runs over the summary itself: one row per borough.
    """
    everything = Window.partitionBy()
    # The mart's revenues are already rounded to cents: add them as whole cents so
    # totals and shares are exact and their rounding does not depend on order.
    summary = demand.groupBy("pickup_borough").agg(
        F.sum("trip_count").alias("total_trips"),
        F.sum(exact.units(F.col("total_revenue"), 2)).alias("revenue_cents"),
    )
    return (
        summary.select(
            "pickup_borough",
            "total_trips",
            exact.rounded_ratio(F.col("revenue_cents"), F.lit(100), 0).alias("total_revenue"),
            _pct(F.col("total_trips"), F.sum("total_trips").over(everything), 1).alias("trip_share_pct"),
            _pct(F.col("revenue_cents"), F.sum("revenue_cents").over(everything), 1).alias("revenue_share_pct"),
        )
        .orderBy(F.desc("total_trips"))
    )


def rounded_mean(value: F.Column, value_digits: int, digits: int) -> F.Column:
    """Aggregate: mean of values carrying ``value_digits`` decimals, rounded half-up to ``digits``.

    A plain floating mean of such values (e.g. means of marts rounded to one
    decimal) often sits exactly on a rounding tie, where the summation order
    would decide the digit; here the mean is an exact fraction.
    """
    u = exact.units(value, value_digits)
    return exact.rounded_ratio(F.sum(u), exact.wide(F.count(u)) * (10 ** value_digits), digits)


def mean_of_group_means(
    mart: DataFrame,
    flag_col: str = "is_precipitation",
    metric: str = "avg_trips_per_hour",
    metric_digits: int = 1,
) -> DataFrame:
    """Unweighted mean of a per-group metric for ``flag = false`` vs ``true`` (O-58).

    A flag value absent from the mart counts as 0.  The means are exact
    (``rounded_mean``) and rounded to 2 decimals; the change in % is taken
    between the two rounded means, also rounded to 2 decimals.
    """
    flag, m = F.col(flag_col), F.col(metric)
    means = mart.agg(
        F.coalesce(rounded_mean(F.when(~flag, m), metric_digits, 2), F.lit(0.0)).alias("dry"),
        F.coalesce(rounded_mean(F.when(flag, m), metric_digits, 2), F.lit(0.0)).alias("wet"),
    )
    dry_units, wet_units = exact.units(F.col("dry"), 2), exact.units(F.col("wet"), 2)
    return means.select(
        F.col("dry").alias("dry_avg_trips_per_hour"),
        F.col("wet").alias("wet_avg_trips_per_hour"),
        exact.rounded_ratio((wet_units - dry_units) * 100, dry_units, 2).alias("change_pct"),
    )


def category_frame(like: DataFrame, name: str, values) -> DataFrame:
    """A one-column frame of fixed category labels, used to keep absent categories as rows."""
    return like.sparkSession.range(1).select(F.explode(F.array(*[F.lit(v) for v in values])).alias(name))


def temp_by_daytype(impact: DataFrame) -> DataFrame:
    """Mean trips per hour by temperature bucket (rows) and day type (columns) (O-59).

    All four buckets appear in calendar order; an absent bucket is a NULL row.
    """
    day_types = [X.DAY_TYPE_WEEKDAY, X.DAY_TYPE_WEEKEND]
    pivoted = impact.groupBy("temp_bucket").pivot("day_type", day_types).agg(
        rounded_mean(F.col("avg_trips_per_hour"), 1, 2)
    )
    buckets = category_frame(impact, "temp_bucket", X.TEMPERATURE_BUCKET_ORDER)
    return (
        buckets.join(F.broadcast(pivoted), "temp_bucket", "left")
        .orderBy(X.category_rank("temp_bucket", X.TEMPERATURE_BUCKET_ORDER))
    )
