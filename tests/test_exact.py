"""Exact, order-independent aggregates."""

import math

from pyspark.sql import functions as F

from tripmart.functions import exact


def test_rounded_ratio_half_away_from_zero_and_null_denominator(spark):
    df = spark.createDataFrame(
        [(5, 2), (-5, 2), (1, 8), (-1, 8), (29, 200), (7, 0), (None, 3)], "num bigint, den bigint"
    )
    got = [r.q for r in df.select(exact.rounded_ratio(F.col("num"), F.col("den"), 0).alias("q")).collect()]
    assert got == [3.0, -3.0, 0.0, -0.0, 0.0, None, None]
    got2 = [r.q for r in df.select(exact.rounded_ratio(F.col("num"), F.col("den"), 2).alias("q")).collect()]
    # 29/200 = 0.145 exactly: a double rounds it down (0.1449999...), the exact fraction rounds up
    assert got2 == [2.5, -2.5, 0.13, -0.13, 0.15, None, None]


def test_exact_sum_and_avg_ignore_nulls_and_order(spark):
    values = [0.005] * 3 + [1.1, 2.2, None]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    row = df.agg(exact.exact_sum(F.col("x"), 2).alias("s"), exact.exact_avg(F.col("x"), 2).alias("a")).first()
    assert row.s == 3.32            # 3.315 exactly, rounded half up
    assert row.a == 0.66            # 3.315 / 5 = 0.663
    empty = df.filter("false").agg(exact.exact_sum(F.col("x"), 2).alias("s")).first()
    assert empty.s is None


def test_same_result_for_any_partitioning(spark):
    df = spark.range(0, 20_000).select((F.col("id") % 7).alias("g"), (F.col("id") * 0.001 + 0.0005).alias("x"))
    results = []
    for parts in (1, 5, 17):
        out = df.repartition(parts).groupBy("g").agg(exact.exact_avg(F.col("x"), 3).alias("a"),
                                                     exact.exact_sum(F.col("x"), 2).alias("s"))
        results.append(sorted(tuple(r) for r in out.collect()))
    assert results[0] == results[1] == results[2]


def test_no_overflow_for_a_huge_group(spark):
    # a third of a very large table in one group: 10^12 rows of $1,000 would overflow a
    # bigint of micro-units; the decimal sum of the same units does not
    units = F.lit(1000.0 * 10**6).cast("decimal(20,0)")
    df = spark.range(1).select((units * F.lit(10**12)).alias("s"))
    row = df.select(exact.rounded_ratio(F.col("s"), F.lit(10**6) * F.lit(10**12), 2).alias("avg")).first()
    assert row.avg == 1000.0


def _sums(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    row = df.agg(exact.exact_sum(F.col("x"), 2).alias("s"), exact.exact_avg(F.col("x"), 2).alias("a"),
                 exact.exact_avg_scaled(F.col("x"), 1, 2).alias("r")).first()
    return row.s, row.a, row.r


def test_large_values_are_not_clipped(spark):
    assert _sums(spark, [1e13, 1.0]) == (10_000_000_000_001.0, 5_000_000_000_000.5, 5_000_000_000_000.5)
    assert _sums(spark, [-1e13, 1.0]) == (-9_999_999_999_999.0, -4_999_999_999_999.5, -4_999_999_999_999.5)
    assert _sums(spark, [50 / 1e-9]) == (5e10, 5e10, 5e10)


def test_nan_and_infinities_come_out_as_plain_aggregates_give_them(spark):
    inf = float("inf")
    assert all(math.isnan(v) for v in _sums(spark, [float("nan"), 10.0]))
    assert _sums(spark, [inf, 1.0]) == (inf, inf, inf)
    assert _sums(spark, [-inf, 1.0]) == (-inf, -inf, -inf)
    assert all(math.isnan(v) for v in _sums(spark, [inf, -inf, 1.0]))


def test_counts_of_any_size_are_widened_before_they_are_multiplied(spark):
    n = F.lit(10**12).cast("bigint") * F.col("id")  # not folded
    df = spark.range(1, 2).select(n.alias("n"))
    row = df.select(exact.rounded_ratio(exact.wide(F.col("n")) * 3, exact.wide(F.col("n")) * 10**9, 9).alias("q")).first()
    assert row.q == 3e-9
