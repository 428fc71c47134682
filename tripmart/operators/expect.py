"""Declarative data tests as DataFrame operators (O-86..O-90).

An expectation returns its *failing* rows: an empty result means it passed.
``summarize`` turns one into a single row (name, failing row count, passed),
and ``run_expectations`` stacks several summaries into one result with
``unionByName``, so the whole suite runs as one Spark job.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.functions.exact import rounded_ratio


def expect_not_null(df: DataFrame, column: str) -> DataFrame:
    """Rows where ``column`` is NULL (O-86)."""
    return df.filter(F.col(column).isNull())


def expect_unique(df: DataFrame, columns: str | Sequence[str]) -> DataFrame:
    """One row per key value that occurs more than once; NULL keys are not tested (O-87)."""
    cols = [columns] if isinstance(columns, str) else list(columns)
    not_null = None
    for c in cols:
        not_null = F.col(c).isNotNull() if not_null is None else not_null & F.col(c).isNotNull()
    return (
        df.filter(not_null)
        .groupBy(*cols)
        .agg(F.count(F.lit(1)).alias("n_records"))
        .filter(F.col("n_records") > 1)
    )


def expect_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """One row per value outside ``values``; NULLs are not tested (O-88)."""
    c = F.col(column)
    return (
        df.filter(c.isNotNull() & ~c.isin(*values))
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_records"))
    )


def match_rate(df: DataFrame, column: str, threshold: float) -> DataFrame:
    """One row: rows, rows with ``column`` set, their ratio, and whether it meets ``threshold``.

    Passing means ``matched_rows >= total * threshold``; an empty input passes.
    """
    counts = df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count(column).alias("matched_rows"),
    )
    return counts.select(
        "total",
        "matched_rows",
        rounded_ratio(F.col("matched_rows"), F.col("total"), 4).alias("match_rate"),
        F.lit(float(threshold)).alias("threshold"),
        (~(F.col("matched_rows") < F.col("total") * float(threshold))).alias("passed"),
    )


def expect_match_rate(df: DataFrame, column: str, threshold: float) -> DataFrame:
    """The counts row when fewer than ``threshold`` of rows have ``column`` set (O-89)."""
    return match_rate(df, column, threshold).filter(~F.col("passed")).select("total", "matched_rows")


def summarize(name: str, failing: DataFrame) -> DataFrame:
    """One row: expectation name, number of failing rows, passed flag."""
    return failing.agg(F.count(F.lit(1)).alias("failing_rows")).select(
        F.lit(name).alias("expectation"),
        "failing_rows",
        (F.col("failing_rows") == 0).alias("passed"),
    )


def summarize_counts(df: DataFrame, failing: Mapping[str, Column]) -> DataFrame:
    """The summaries of several expectations on one model from one aggregate over it.

    ``failing`` gives, per expectation name, the aggregate that counts its failing rows.
    """
    counts = df.agg(*[F.coalesce(c, F.lit(0)).cast("bigint").alias(f"c{k}") for k, c in enumerate(failing.values())])
    rows = [F.struct(F.lit(name).alias("expectation"), F.col(f"c{k}").alias("failing_rows")) for k, name in enumerate(failing)]
    return counts.select(F.inline(F.array(*rows))).withColumn("passed", F.col("failing_rows") == 0)


def run_expectations(checks: Sequence[tuple[str, DataFrame]], summaries: Sequence[DataFrame] = ()) -> DataFrame:
    """Summaries of several expectations as one DataFrame (O-90), after those in ``summaries``."""
    summaries = [*summaries, *(summarize(name, failing) for name, failing in checks)]
    out = summaries[0]
    for s in summaries[1:]:
        out = out.unionByName(s)
    return out
