"""Counts taken while a DataFrame is written: data tests that scan nothing (O-90).

``watch`` attaches aggregates to a DataFrame by ``DataFrame.observe``; the
write that consumes it returns them, so a fact table is tested in the pass that
stores it.  Distinct counts can't be observed: uniqueness stays a query
(``expect.expect_unique``), which the suite runs on tables of bounded size.

The metrics travel as accumulator updates of the stage that writes, which
Spark counts once per output partition, whatever is retried.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


class Counts:
    """The observed counts by name; to be read once the watched DataFrame has been written."""

    def __init__(self, names: list[str], observation: Observation) -> None:
        self._names, self._observation = names, observation

    def get(self) -> dict[str, int]:
        values = self._observation.get
        return {name: int(values.get(f"c{k}") or 0) for k, name in enumerate(self._names)}


def watch(df: DataFrame, counts: Mapping[str, Column]) -> tuple[DataFrame, Counts]:
    """``df`` with the aggregates ``counts`` taken on its way, and where to read them."""
    observation = Observation(f"counts-{uuid.uuid4().hex}")
    names = list(counts)
    columns = [F.coalesce(counts[name], F.lit(0)).cast("bigint").alias(f"c{k}") for k, name in enumerate(names)]
    return df.observe(observation, *columns), Counts(names, observation)


def nulls(column: str | Column) -> Column:
    """Rows without a value: the failing rows of a not-null test."""
    return F.count_if((F.col(column) if isinstance(column, str) else column).isNull())


def any_null(column: Column, among: Column | None = None) -> Column:
    """1 if any cell has no value, else 0: the failing rows of a not-null test on a table grouped by ``column``."""
    is_null = column.isNull() if among is None else column.isNull() & among
    return F.max(F.when(is_null, 1).otherwise(0))


def summaries(spark: SparkSession, failing: Mapping[str, int]) -> DataFrame:
    """``expectation, failing_rows, passed`` of counts that have been taken (same columns as ``expect.summarize``)."""
    rows = [F.struct(F.lit(name).alias("expectation"), F.lit(n).cast("bigint").alias("failing_rows"), F.lit(n == 0).alias("passed"))
            for name, n in failing.items()]
    return spark.range(1, numPartitions=1).select(F.inline(F.array(*rows)))
