"""Tables that a reader finds in order (O-83, O-84).

A sort on its own doesn't survive a write: Spark gives no order to the rows of
a table that is read.  ``publish_ordered`` deals the rows by ranges of the
ordering, sorts inside each, and stores every row's place in ``_row``, which
increases with the order; ``in_order`` turns it into positions 1, 2, 3 ...
without sorting or moving the rows again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmart.sources.catalog import publish_table

ROW_COL = "_row"
#: A row's number carries its partition above these bits.
_PARTITION_BITS = 33


def publish_ordered(df: DataFrame, name: str, *order: Column | str, partitions: int | None = None) -> DataFrame:
    """Publish ``df`` as ``name`` by ranges of ``order``, with ``_row``; returns a reader."""
    ranged = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    # numbered in the task that writes, after its sort
    return publish_table(ranged.sortWithinPartitions(*order).withColumn(ROW_COL, F.monotonically_increasing_id()), name)


def in_order(table: DataFrame, position_col: str = "position") -> DataFrame:
    """The rows of a table of ``publish_ordered`` with their position in its order, counted from 1.

    Each range's rows are numbered from its first one on by the rows of the
    ranges before it: one count a range is joined, no row is sorted.
    """
    part = F.shiftright(F.col(ROW_COL), _PARTITION_BITS)
    sizes = table.groupBy(part.alias("_range")).agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    before = sizes.select("_range", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    place = F.col(ROW_COL) - F.shiftleft(part, _PARTITION_BITS)
    return (
        table.withColumn("_range", part).join(before, "_range")
        .withColumn(position_col, (F.col("_before") + place + 1).cast("bigint")).drop("_range", "_before", ROW_COL)
    )


def rows_in_order(table: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The table sorted by its stored order, for a reader that shows or exports it."""
    return table.orderBy(ROW_COL).select(*(columns or [c for c in table.columns if c != ROW_COL]))
