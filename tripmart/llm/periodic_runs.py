"""Periodic runs of words by string synchronising sets.

A run is a stretch of consecutive words with smallest period q (words q apart
are identical), of at least ``max(least, 2 * q)`` words, that no neighbouring
word extends.  Many texts are searched at once as one sequence of word hashes,
each text ended by a symbol that occurs nowhere else, so no run crosses texts.

* At each dyadic scale t = 4, 8, 16 ... the synchronising set holds position i
  when the smallest hash among the t-word windows that start in [i, i + t] is
  that of the first or the last of them; windows of period at most t / 3 don't
  count.  Whether i is chosen depends on the 2 t words from i on alone, so a
  run of period q in [3 t, 6 t) chooses i and i + q alike: pairs of chosen
  positions with equal contexts of 2 t words and that distance propose the
  periods.  Of one context there are at most 18 positions in 6 t words.
* Periods below 12 are too small for any scale; they are found by comparing
  each word with the one q before it.
* Where a whole period of a run is itself highly periodic (period p, nine times
  or more), nothing is chosen in it.  Such a run stands on two regions of
  period p that touch but differ in phase, so its period is the shift between
  the phases plus a multiple of p: those few are proposed from the regions,
  which smaller scales have found.

Each proposal is extended both ways by equal windows of falling dyadic length
and joined with equal ones; of the same stretch the smallest period stays.
A text without equal contexts and without highly periodic windows at one scale
has no run of a longer period and leaves the search.

Memory is bounded by ``CHUNK_WORDS`` or by the longest text, some 300 bytes a
word.  Words and windows are compared by 64-bit hashes.

Defined results: a null or empty text has no words, hence no run and the hash
of nothing; repeated rows count each for itself; a null id shapes no text in
``run_report`` (nothing is planted); equal greatest lengths go to the smaller
start, then the smaller period; an empty table gives an empty result; further
columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.textarrays import NON_SPACE_BYTES, Hasher, flat, mix, runs as byte_runs

#: Words searched at once; a longer text is searched alone.
CHUNK_WORDS = 1 << 17
#: Fewest words of a run.
LEAST = 12
FIRST_SCALE = 2
#: Periods below this are compared directly: 3 t at the first scale.
SMALL = 3 << FIRST_SCALE
#: Longest window whose hashes are kept for extending; longer stretches take several steps.
TOP = 12

_NOT_CHOSEN = np.uint64(0xFFFFFFFFFFFFFFFF)
_LEFT, _RIGHT = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _doubled(windows: np.ndarray, length: int) -> np.ndarray:
    """Hashes of the windows of twice the length."""
    n = max(0, len(windows) - length)
    return mix(windows[:n] * _LEFT + (windows[length:length + n] ^ _RIGHT) * _RIGHT)


def _islands(equal: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, end) of the stretches of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], equal, [False]]).astype(np.int8)))
    return edges[::2], edges[1::2]


def _extended(windows: list[np.ndarray], a: np.ndarray, b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """For position pairs a < b: how many words before them, and from them on, are equal."""
    before, after = np.zeros(len(a), np.int64), np.zeros(len(a), np.int64)

    def step(level: int) -> np.ndarray:
        width, table = 1 << level, windows[level]
        moved = np.zeros(len(a), bool)
        x, y = a - before - width, b - before - width
        ok = x >= 0
        ok[ok] = table[x[ok]] == table[y[ok]]
        before[ok] += width
        moved |= ok
        x, y = a + after, b + after
        ok = y + width <= n
        ok[ok] = table[x[ok]] == table[y[ok]]
        after[ok] += width
        return moved | ok

    top = len(windows) - 1
    while len(a) and step(top).any():
        pass
    for level in range(top - 1, -1, -1):
        step(level)
    return before, after


def _window_minimum(values: np.ndarray, level: int) -> np.ndarray:
    """Minimum over each ``2**level + 1`` consecutive values."""
    for k in range(level):
        width = 1 << k
        values = np.minimum(values[:-width], values[width:])
    return np.minimum(values[:-1], values[1:])


def _phase_pairs(words: np.ndarray, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal positions of runs whose whole period is highly periodic: they stand on two touching regions of one period.

    ``found`` holds (start, end, period); regions are those that repeat nine times or more.
    """
    high = found[found[:, 1] - found[:, 0] >= 9 * found[:, 2]]
    high = high[np.lexsort((high[:, 0], high[:, 2]))]
    touching = np.flatnonzero((high[1:, 2] == high[:-1, 2]) & (high[1:, 0] <= high[:-1, 1]))
    out = []
    for k in touching.tolist():
        (a1, b1, p), (a2, b2, _) = high[k].tolist(), high[k + 1].tolist()
        root = words[a1:a1 + p]
        doubled, wanted = np.concatenate([root, root]).tobytes(), words[a2:a2 + p].tobytes()
        at = doubled.find(wanted)
        while at >= 0 and at % words.itemsize:
            at = doubled.find(wanted, at + 1)
        if at < 0:
            continue
        shift = (a2 - a1 - at // words.itemsize) % p
        periods = np.arange(shift, min(b1 - a1, b2 - a2) + 1, p)
        periods = periods[periods > p]
        start, end = np.maximum(a1, a2 - periods), np.minimum(b1, b2 - periods)
        ok = end - start >= periods
        out.append(np.stack([start[ok], start[ok] + periods[ok]]))
    a, b = np.concatenate(out, 1) if out else np.zeros((2, 0), np.int64)
    return a, b


def _covered(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which of n places lie in any of the stretches."""
    steps = np.zeros(n + 1, np.int32)
    np.add.at(steps, starts, 1)
    np.add.at(steps, ends, -1)
    return np.cumsum(steps[:n]) > 0


def _search(words: np.ndarray, text_of: np.ndarray) -> np.ndarray:
    """(start, end, period) of the proposals in a sequence whose texts end in symbols of their own."""
    n = len(words)
    found = []
    for q in range(1, min(SMALL, n)):
        first, end = _islands(words[:-q] == words[q:])
        # short ones too: regions of any nine periods, and what makes a window highly periodic
        long = end - first >= max(q, 4 - q)
        found.append(np.stack([first[long], end[long] + q, np.full(long.sum(), q)], 1))
    known = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
    windows = [words]
    scale = words  # hashes of the windows of 2**level words
    for level in range(1, FIRST_SCALE + 1):
        scale = _doubled(scale, 1 << (level - 1))
        windows.append(scale)
    where = np.arange(n)  # of each place of the shrinking sequence in the whole one
    sizes = np.bincount(text_of)
    level = FIRST_SCALE

    def joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """``known`` and the runs that the pairs of equal positions lie in."""
        while len(windows) <= TOP and len(windows[-1]) > 1 << (len(windows) - 1):
            windows.append(_doubled(windows[-1], 1 << (len(windows) - 1)))
        before, after = _extended(windows, a, b, n)
        start, end, q = a - before, b + after, b - a
        ok = end - start >= 2 * q
        return np.unique(np.concatenate([known, np.stack([start[ok], end[ok], q[ok]], 1)]), axis=0)

    while True:
        t = 1 << level
        contexts = _doubled(scale, t)
        if not len(contexts):
            break
        # windows of period at most t / 3 are not chosen
        dull = (known[:, 2] * 3 <= t) & (known[:, 1] - known[:, 0] >= t)
        is_dull = _covered(n + 1, known[dull, 0], known[dull, 1] - t + 1)[where]
        values = np.where(is_dull[:len(scale)], _NOT_CHOSEN, scale)
        least = _window_minimum(values, level)
        m = min(len(least), len(contexts))
        chosen = np.flatnonzero((least[:m] != _NOT_CHOSEN) & ((least[:m] == values[:m]) | (least[:m] == values[t:t + m])))
        context = contexts[chosen]
        order = np.lexsort((chosen, context, text_of[chosen]))
        place, context, text = chosen[order], context[order], text_of[chosen[order]]
        pairs_a, pairs_b, ahead = [], [], 1
        live = np.zeros(text_of[-1] + 1, bool)  # texts with equal contexts or dull windows
        live[text_of[np.flatnonzero(is_dull[:len(text_of)])]] = True
        while ahead < len(place):
            same = (context[ahead:] == context[:-ahead]) & (text[ahead:] == text[:-ahead])
            if ahead == 1:
                live[text[1:][same]] = True
            apart = place[ahead:] - place[:-ahead]
            near = same & (apart < 6 * t)
            if not near.any():
                break
            right = near & (apart >= 3 * t)
            pairs_a.append(place[:-ahead][right])
            pairs_b.append(place[ahead:][right])
            ahead += 1
        if pairs_a and sum(map(len, pairs_a)):
            known = joined(where[np.concatenate(pairs_a)], where[np.concatenate(pairs_b)])
        live &= sizes >= 12 * t  # room for twice the least period of the next scale
        if not live.any():
            break
        # the other texts have no longer period: leave them out, whole texts at a time
        keep = live[text_of]
        if not keep.all():
            scale, where = _kept(words[where[keep]], level), where[keep]
            numbers = np.cumsum(live) - 1
            text_of, sizes = numbers[text_of[keep]], sizes[live]
        scale = _doubled(scale, t)
        level += 1
    a, b = _phase_pairs(words, known)
    return joined(a, b) if len(a) else known


def _kept(words: np.ndarray, level: int) -> np.ndarray:
    """Hashes of the windows of ``2**level`` words of what is left."""
    for k in range(level):
        words = _doubled(words, 1 << k)
    return words


def find_runs(words: np.ndarray, offsets: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray]:
    """Runs of texts given as word hashes: (start, length, period) within their text, and the bounds of each text's runs.

    ``offsets`` bound the texts in ``words``; runs are in order of start, then period.
    """
    texts = len(offsets) - 1
    ends = offsets[1:] + np.arange(texts)  # where each text's own symbol goes
    joined = np.insert(words, offsets[1:], mix(np.arange(texts, dtype=np.uint64) ^ _RIGHT))
    begins = np.concatenate([[0], ends + 1])
    if not len(joined):
        return np.zeros((0, 3), np.int64), np.zeros(texts + 1, np.int64)
    text_of = np.repeat(np.arange(texts), np.diff(begins))
    found = _search(joined, text_of)
    length = found[:, 1] - found[:, 0]
    found = found[length >= np.maximum(least, 2 * found[:, 2])]
    found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
    first = np.ones(len(found), bool)
    first[1:] = (found[1:, :2] != found[:-1, :2]).any(1)  # the smallest period of a stretch
    found = found[first]
    found = found[np.lexsort((found[:, 2], found[:, 0]))]
    text = text_of[found[:, 0]] if len(found) else np.zeros(0, np.int64)
    out = np.stack([found[:, 0] - begins[text], found[:, 1] - found[:, 0], found[:, 2]], 1)
    return out, np.searchsorted(text, np.arange(texts + 1))


def planted_period(doc_id: int | None, n: int) -> tuple[int, int] | None:
    """(a, p) of a document whose words from a on repeat with period p, or None; by the checksum of its id."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    a = h // 10 % n
    return a, 1 + (n - a) // (3 + h // 10 % 8)


Shape = Callable[["int | None", int], "tuple[int, int] | None"]


def _texts(ids: pa.Array, column: pa.Array, shape: Shape | None) -> Iterator[tuple[list, list[list[bytes]], list[np.ndarray]]]:
    """Texts of about ``CHUNK_WORDS`` words together: their ids, words and word hashes."""
    data, offsets = flat(column)
    row, rows = 0, len(offsets) - 1
    numbers = ids.to_pylist()
    while row < rows:
        # a word and the white space after it take two bytes or more
        end = min(rows, max(row + 1, int(np.searchsorted(offsets, offsets[row] + 4 * CHUNK_WORDS, "right")) - 1))
        part, at = data[offsets[row]:offsets[end]], offsets[row:end + 1] - offsets[row]
        starts, ends, text = byte_runs(part, at, NON_SPACE_BYTES)
        hashes = Hasher(part).spans(starts, ends)
        bounds = np.searchsorted(text, np.arange(end - row + 1))
        raw = part.tobytes()
        words, named = [], []
        for k in range(end - row):
            mine = raw[at[k]:at[k + 1]].split()  # at the same six bytes
            own = hashes[bounds[k]:bounds[k + 1]]
            plan = shape(numbers[row + k], len(mine)) if shape else None
            if plan:
                a, p = plan
                order = np.arange(len(mine))
                order[a:] = a + (order[a:] - a) % p
                mine, own = [mine[i] for i in order.tolist()], own[order]
            words.append(mine)
            named.append(own)
        yield numbers[row:end], words, named
        row = end


def _searched(ids: pa.Array, column: pa.Array, shape: Shape | None, least: int) -> Iterator[tuple[int | None, list[bytes], np.ndarray]]:
    """(id, words, runs) of each text."""
    for numbers, words, named in _texts(ids, column, shape):
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in named])]).astype(np.int64)
        found, bounds = find_runs(np.concatenate(named), offsets, least)
        for k, number in enumerate(numbers):
            yield number, words[k], found[bounds[k]:bounds[k + 1]]


def periodic_runs(docs: DataFrame, least: int = LEAST, shape: Shape | None = None) -> DataFrame:
    """``doc_id, start, length, period`` of every run of every text; words are counted from 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, _, found in _searched(batch.column(0), batch.column(1), shape, least):
                if len(found):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([number] * len(found), pa.int64()), *(pa.array(found[:, k], pa.int64()) for k in range(3))],
                        ["doc_id", "start", "length", "period"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, start long, length long, period long")


def _kept_words(words: list[bytes], found: np.ndarray) -> list[bytes]:
    """The words outside every run's repetitions: all but what follows a run's first period."""
    if not len(found):
        return words
    gone = _covered(len(words), found[:, 0] + found[:, 2], found[:, 0] + found[:, 1])
    return [word for word, drop in zip(words, gone.tolist(), strict=True) if not drop]


def collapse_runs(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """``doc_id, text``: each text with one period left of every run, its words joined by one space."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, words, found in _searched(batch.column(0), batch.column(1), None, least):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number], pa.int64()), pa.array([b" ".join(_kept_words(words, found)).decode()], pa.string())], ["doc_id", "text"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, text string")


_REPORT = pa.schema([
    ("doc_id", pa.int64()), ("n_runs", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64()),
    ("exponent_milli", pa.int64()), ("runs_sha256", pa.string()), ("collapsed_sha256", pa.string()),
])


def _report_row(number: int | None, words: list[bytes], found: np.ndarray) -> tuple:
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in found.tolist())
    best = (None, None, None, None)
    if len(found):
        s, n, q = found[np.lexsort((found[:, 2], found[:, 0], -found[:, 1]))[0]].tolist()
        best = (s, n, q, 1000 * n // q)
    kept = b" ".join(_kept_words(words, found))
    return (number, len(found), *best, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def run_report(docs: DataFrame, least: int = LEAST, shape: Shape | None = planted_period) -> DataFrame:
    """Per document its number of runs, the longest one, and digests of all runs and of the collapsed text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [_report_row(*found) for found in _searched(batch.column(0), batch.column(1), shape, least)]
            columns = list(zip(*rows, strict=True)) if rows else [[]] * len(_REPORT)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _REPORT, strict=True)], schema=_REPORT)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string")
