"""Vectorised text helpers shared by the text operators.

Documents arrive in a task as one Arrow string column.  The helpers view it as
a flat byte array plus offsets, so words, hashes and rolling hashes of a whole
chunk of documents come from a few numpy calls, not from a loop over rows.

Hashes are polynomial over the bytes, modulo 2**64, each byte first replaced
by a fixed random 64-bit value, and mixed at the end.  A hash depends only on
the hashed bytes, never on where they stand.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text handled by one round of numpy calls; bounds a task's memory.
CHUNK_BYTES = 1 << 18

_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes so that every output bit depends on every input bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


#: One 64-bit value per byte value.
BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


class _Powers:
    """Powers of the hash base and of its inverse, grown on demand."""

    def __init__(self) -> None:
        self.up = np.ones(1, np.uint64)
        self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, CHUNK_BYTES + 64)
            inverse = pow(_BASE, -1, 1 << 64)
            for name, step in (("up", _BASE), ("down", inverse)):
                table = np.ones(size, np.uint64)
                done = 1
                while done < size:
                    more = min(done, size - done)
                    table[done:done + more] = table[:more] * np.uint64(pow(step, done, 1 << 64))
                    done += more
                setattr(self, name, table)
        return self.up, self.down


_POWERS = _Powers()


class Hasher:
    """Hashes of any substring of ``data`` in constant time each."""

    def __init__(self, data: np.ndarray) -> None:
        self.up, self.down = _POWERS.get(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(BYTE_VALUES[data] * self.up[:len(data)], out=self.sums[1:])

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        raw = (self.sums[ends] - self.sums[starts]) * self.down[starts]
        return mix(raw + (ends - starts).astype(np.uint64) * np.uint64(_BASE))

    def windows(self, length: int) -> np.ndarray:
        """Unmixed hash of every window of ``length`` bytes."""
        n = len(self.sums) - length
        if n <= 0:
            return np.zeros(0, np.uint64)
        return (self.sums[length:] - self.sums[:n]) * self.down[:n]


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A string or binary column as (bytes, offsets), without copying the bytes; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def chunks(offsets: np.ndarray, chunk_bytes: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``chunk_bytes``; one longer text is a range of its own."""
    row, n = 0, len(offsets) - 1
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + chunk_bytes, "right")) - 1
        end = min(max(end, row + 1), n)
        yield row, end
        row = end


def text_chunks(column: pa.Array, chunk_bytes: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) of each chunk of a text column."""
    data, offsets = flat(column)
    for lo, hi in chunks(offsets, chunk_bytes):
        yield lo, hi, data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]


def byte_class(pairs: list[tuple[int, int]]) -> np.ndarray:
    """Table of the byte values inside any of the inclusive ranges."""
    table = np.zeros(256, bool)
    for low, high in pairs:
        table[low:high + 1] = True
    return table


#: Letters, digits and every byte of a non-ASCII character.
WORD_BYTES = byte_class([(0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)])
#: Everything but the space and the control white space.
NON_SPACE_BYTES = ~byte_class([(0x20, 0x20), (0x09, 0x0D)])
#: Lower-casing of A-Z only.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def runs(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of bytes of a class, never crossing a text: (starts, ends, text index)."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    is_in = inside[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets[:-1]] = True  # an empty last text marks the sentinel only
    begins = is_in.copy()
    begins[1:] &= ~is_in[:-1] | first[1:-1]
    stops = is_in.copy()
    stops[:-1] &= ~is_in[1:] | first[1:-1]
    starts = np.flatnonzero(begins)
    ends = np.flatnonzero(stops) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def word_hashes(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text index) of each word of lower-cased ``data``, in order."""
    starts, ends, rows = runs(data, offsets, inside)
    return Hasher(data).spans(starts, ends), rows


def shingles(hashes: np.ndarray, rows: np.ndarray, n_rows: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text index) of each run of ``width`` words; of a shorter text, of all its words."""
    if not len(hashes):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    count = np.bincount(rows, minlength=n_rows)
    first = np.concatenate([[0], np.cumsum(count)])[:-1]
    # every position starts a run; a run is cut at the end of its text
    out = np.zeros(len(hashes), np.uint64)
    left = first[rows] + count[rows] - np.arange(len(hashes))
    for k in range(width):
        ahead = np.zeros(len(hashes), np.uint64)
        ahead[:len(hashes) - k] = hashes[k:]
        ahead[left <= k] = 0
        out = (out + ahead) * np.uint64(_BASE)
    keep = (left >= width) | (np.arange(len(hashes)) == first[rows])
    return mix(out[keep] + np.minimum(left[keep], width).astype(np.uint64)), rows[keep]
