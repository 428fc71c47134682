"""Join strategy helpers: broadcast only a side whose size has been checked.

A dimension (hourly context, location lookup) is broadcast to every task of
the fact scan, so the fact is joined without being shuffled.  That is only
safe while the dimension is small, and nothing in the data guarantees it (an
hourly series can span decades, a lookup can be fed the wrong file).  The
check below counts the dimension's rows and bytes, one partial row per
partition; beyond either bound no hint is given and Spark's planner falls back
to a shuffle join, where AQE's skew-join handling splits a hot fact key.  The
rows of the result are the same either way.

The check is one extra job over the dimension.  On a published table (the
publishing run writes the hourly series and the lookup to silver first) that
is a cheap count; a dimension derived on the fly from a large table would be
computed once for the check and once for the join, so it is materialised
first (``materialize=True``).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# An hourly series of 20 years is 175,320 rows; a location lookup has a few hundred.
DEFAULT_MAX_BROADCAST_ROWS = 200_000


#: What all rows of a broadcast side may take together.
DEFAULT_MAX_BROADCAST_BYTES = 128 << 20


def _row_bytes(df: DataFrame) -> Column:
    """About the bytes of a row: its strings' lengths and a word for every other column."""
    texts = [F.coalesce(F.octet_length(c), F.lit(0)) for c, kind in df.dtypes if kind in ("string", "binary")]
    return reduce(lambda a, b: a + b, texts, F.lit(8 * (len(df.columns) + 2))).cast("long")


def within_bound(frames: Sequence[DataFrame], max_rows: int, max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> list[bool]:
    """For each frame, whether its rows and bytes are within the bounds: one Spark job for all of them."""
    sizes = [f.agg(F.count(F.lit(1)).alias("rows"), F.sum(_row_bytes(f)).alias("bytes")).withColumn("_frame", F.lit(i)) for i, f in enumerate(frames)]
    found = {r["_frame"]: r for r in reduce(DataFrame.unionByName, sizes).collect()}
    return [found[i]["rows"] <= max_rows and (found[i]["bytes"] or 0) <= max_bytes for i in range(len(frames))]


def broadcast_if_bounded(df: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """``F.broadcast(df)`` when its rows and bytes are within the bounds, else ``df`` unchanged."""
    return F.broadcast(df) if within_bound([df], max_rows)[0] else df


def broadcast_all_if_bounded(
    frames: Sequence[DataFrame],
    max_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
    materialize: bool = False,
) -> list[DataFrame]:
    """``broadcast_if_bounded`` for several dimensions, checked together in one job.

    ``materialize`` writes each dimension once with a reliable checkpoint
    first, for dimensions derived on the fly from large tables: the check
    and the join then read that copy instead of each recomputing it, and an
    unbounded dimension's copy feeds the shuffle join just the same.
    """
    if materialize:
        from tripmart.session import ensure_checkpoint_dir

        ensure_checkpoint_dir(frames[0].sparkSession)
        frames = [f.checkpoint(eager=True) for f in frames]
    return [F.broadcast(f) if ok else f for f, ok in zip(frames, within_bound(frames, max_rows))]
