"""Bitmaps of a fixed size over hashes: what a scan may ask about, small enough to broadcast."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: 2 MB whatever the table.
BITMAP_BITS = 1 << 24


def spread(*columns: np.ndarray) -> np.ndarray:
    """One hash of the longs of a row: the low 31 bits of a sum of odd multiples, as ``spread_column`` has it."""
    total = np.zeros(len(columns[0]), np.int64)
    for k, column in enumerate(columns):
        total ^= (column.astype(np.int64) & 0xFFFFFFFF) * (2 * k + 3) & 0x7FFFFFFF
        total = total * 31 & 0x7FFFFFFF
    return total.view(np.uint64)


def spread_column(*columns: Column) -> Column:
    total = F.lit(0).cast("long")
    for k, column in enumerate(columns):
        total = total.bitwiseXOR((column.bitwiseAND(F.lit(0xFFFFFFFF)) * (2 * k + 3)).bitwiseAND(F.lit(0x7FFFFFFF)))
        total = (total * 31).bitwiseAND(F.lit(0x7FFFFFFF))
    return total


def bitmap(hashes: DataFrame, column: str, bits: int = BITMAP_BITS) -> np.ndarray:
    """A bitmap with the bit of every (long) hash in ``column``; at most one row per byte reaches the driver."""
    place = F.pmod(F.col(column), F.lit(bits))
    rows = hashes.groupBy((place / 8).cast("int").alias("byte")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1), (place % 8).cast("int"))).alias("value")
    ).toArrow()
    out = np.zeros(bits // 8, np.uint8)
    out[np.asarray(rows["byte"])] = np.asarray(rows["value"]).astype(np.uint8)
    return out


def asked(marks: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether each hash may be in the bitmap: never false for one that is."""
    place = hashes.view(np.int64) % (8 * len(marks))
    return (marks[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
