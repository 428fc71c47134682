"""Hard-negative mining by coordinate pruning in length buckets.

Candidates are sorted by their length into buckets of similar lengths.  Each
bucket keeps, per coordinate, the list of its normalised vectors sorted by the
value of that coordinate.  An anchor asks for all rows whose score reaches a
threshold:

* a bucket whose greatest length can't reach it ends the search;
* elsewhere the threshold becomes a least cosine c.  A vector of cosine c or
  more with the anchor has, in a coordinate where the anchor has q, a value in
  [q c - w, q c + w] with w = sqrt((1 - c^2)(1 - q^2)) (up to 1 or down to -1
  where q itself is beyond c).  The anchor's focus coordinates are its largest half;
  the shortest of their ranges is read off the sorted list, the other ranges
  are intersected with it, and what remains of the vectors outside the focus
  coordinates bounds the rest of the cosine;
* where even the shortest range holds much of the bucket, the ranges save
  nothing: the last bound, which implies all of them, is taken of the whole
  bucket at once;
* the candidates left are verified by their exact integer score, and the
  threshold rises with what is found.

Anchors go through a bucket many at a time, so that what is done for one anchor
alone is the verification of its candidates.

Two passes: the positives of each anchor (its k best rows of the same label;
the threshold is the k-th best so far), then, for each positive, the best rows
of other labels inside the score band below it (the threshold is the lowest
score that any positive of the anchor still needs).  Rows are dealt into groups
of a bounded number of rows, anchors into blocks, and every (group, block)
cell is one task's work: the stated anchors against all rows, block by block.
In the first pass the cells are those of one label, so a label that many rows
share is many cells.

Scores are integers, exact in 64-bit floats while every sum stays below 2**53;
beyond, Python integers are used and nothing is pruned.

Defined results: rows with a null id, a null label, a null vector or a null or
non-finite component take no part; rows that repeat id, label and vector count
once; rows that share an id are not candidates of each other; vectors of
different lengths are not compared; ties go to the smaller id; an anchor
without positives, and a positive without a row in its band, has no row; empty
tables give an empty result; further columns are not read.  A score outside 64
bits raises an error.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmart.llm.tables import stored

GROUP_ROWS = 8192
BLOCK_ROWS = 2048
#: Rows of a bucket, and how far lengths in it may differ.
BUCKET_ROWS = 1024
LENGTH_RATIO = 0.8
LEAST_BUCKET_ROWS = 64
#: Share of an anchor's coordinates, its largest ones, that candidates are pruned by.
FOCUS_SHARE = 0.5
#: Anchors that go through a bucket together.
TOGETHER = 256
#: Part of a bucket, one in so many rows, up to which a range is read row by row.
NARROW = 16
#: Rows of the dealing plan up to which it is broadcast: two numbers a row.
MAX_BROADCAST_PLAN = 100_000
#: What rounding may cost a cosine.
_SLACK = 1e-9

#: The band of a negative's score, in percent of its positive's.
LOW, HIGH = 50, 95


def labelled_vectors(vectors: DataFrame, label: Column | str = "label", scale: int = 256, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """``vec_id, label, v``: each component floor(scale * x) as a whole double; unusable and repeated rows left out."""
    parts = F.col(column).cast("array<double>")
    # floor() of a double gives a long and would clip; beyond 2**52 a double is whole already
    whole = F.transform(parts, lambda x: F.when(F.abs(x * float(scale)) < float(1 << 52), F.floor(x * float(scale)).cast("double")).otherwise(x * float(scale)))
    label = F.col(label) if isinstance(label, str) else label
    bad = F.exists(parts, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), label.cast("long").alias("label"), parts.alias("p"), whole.alias("v"), bad.alias("bad"))
    return rows.where("vec_id IS NOT NULL AND label IS NOT NULL AND p IS NOT NULL AND NOT bad").select("vec_id", "label", "v").dropDuplicates()


# ---------------------------------------------------------------- one cell

def _matrix(table: pa.Table) -> np.ndarray:
    values = table["v"].combine_chunks()
    flat = np.asarray(values.flatten(), np.float64)
    return flat.reshape(len(values), len(flat) // max(1, len(values)))


class LengthBuckets:
    """Rows of a cell in buckets of similar length with sorted coordinate lists."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray, largest_query: float) -> None:
        length = np.sqrt((rows * rows).sum(1))
        order = np.lexsort((ids, -length))
        self.ids, self.labels, self.rows, length = ids[order], labels[order], rows[order], length[order]
        bound = largest_query * np.abs(rows).max(initial=0) * max(1, rows.shape[1])
        self.exact_floats = bool(bound < 2.0**53)
        self.products = 0  # exact scores taken
        self.buckets = []
        begin = 0
        while begin < len(length):
            end = begin + LEAST_BUCKET_ROWS
            limit = min(begin + BUCKET_ROWS, len(length))
            while end < limit and length[end] >= LENGTH_RATIO * length[begin]:
                end += LEAST_BUCKET_ROWS
            end = min(end, limit)
            unit = self.rows[begin:end] / np.maximum(length[begin:end, None], 1e-300)
            lists = np.ascontiguousarray(np.argsort(unit, axis=0, kind="stable").T)
            self.buckets.append((begin, end, length[begin], unit, lists, np.take_along_axis(unit.T, lists, 1)))
            begin = end
        self.all = np.arange(len(length))
        if not self.exact_floats:
            self.rows = np.frompyfunc(int, 1, 1)(self.rows)

    def reaching(self, query: np.ndarray, threshold: Callable[[], float | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(places, scores), bucket by bucket, of every row whose score reaches ``threshold()``; None is none."""

        def thresholds() -> np.ndarray:
            least = threshold()
            return np.array([-np.inf if least is None else least], np.float64)

        for _, places, scores in self.all_reaching(query[None], thresholds):
            yield places, scores

    def all_reaching(self, queries: np.ndarray, thresholds: Callable[[], np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(lines, places, scores), bucket by bucket, of every query and row whose score reaches the query's threshold.

        ``thresholds()``, one a query, is asked for anew before each bucket; -inf is none.  Beyond exact floats all rows come.
        """
        if not self.exact_floats:
            for line, query in enumerate(np.frompyfunc(int, 1, 1)(queries)):
                self.products += len(self.all)
                yield np.full(len(self.all), line), self.all, self.rows @ query
            return
        size = np.sqrt((queries * queries).sum(1))
        unit = queries / np.maximum(size[:, None], 1e-300)
        focus = np.argsort(-np.abs(unit), axis=1, kind="stable")[:, :int(np.ceil(FOCUS_SHARE * unit.shape[1]))]
        for begin, end, longest, rows, lists, values in self.buckets:
            least = thresholds()
            active = size * longest * (1 + _SLACK) >= least
            if not active.any():
                return  # the buckets after it hold shorter vectors
            found = []
            whole = np.flatnonzero(active & (least <= 0))
            if len(whole):
                self.products += len(whole) * (end - begin)
                scores = queries[whole] @ self.rows[begin:end].T
                line, at = np.nonzero(scores >= least[whole, None])
                found.append((whole[line], at + begin, scores[line, at]))
            pruned = np.flatnonzero(active & (least > 0))
            if len(pruned):
                cosine = np.minimum(1.0, least[pruned] / (size[pruned] * longest)) - _SLACK
                lines, places = self._feasible(rows, lists, values, unit[pruned], focus[pruned], cosine)
                edges = np.searchsorted(lines, np.arange(len(pruned) + 1))
                places += begin
                self.products += len(places)
                for line, first, last in zip(pruned, edges[:-1], edges[1:], strict=True):
                    at = places[first:last]
                    scores = self.rows[at] @ queries[line]
                    reached = scores >= least[line]
                    found.append((np.full(np.count_nonzero(reached), line), at[reached], scores[reached]))
            yield tuple(np.concatenate(column) for column in zip(*found, strict=True))

    def _feasible(self, rows, lists, values, unit, focus, cosine) -> tuple[np.ndarray, np.ndarray]:
        """(lines, places in the bucket), lines ascending, of the rows that may have the cosine, or more, with a query."""
        own = np.arange(len(unit))[:, None]
        focused = np.zeros(unit.shape, bool)
        focused[own, focus] = True
        q = np.where(focused, unit, 0.0)
        rest = np.sqrt(np.maximum(0.0, 1.0 - (q * q).sum(1)))
        c = cosine[:, None]
        width = np.sqrt(np.maximum(0.0, 1 - c * c) * np.maximum(0.0, 1 - q * q))
        low = np.where(-q >= c, -1.0, q * c - width) - _SLACK
        high = np.where(q >= c, 1.0, q * c + width) + _SLACK
        first, last = np.zeros(unit.shape, np.int64), np.full(unit.shape, len(rows))
        cut = focused & ((low > values[:, 0]) | (high < values[:, -1]))
        for f in np.flatnonzero(cut.any(0)):
            some = cut[:, f]
            first[some, f] = np.searchsorted(values[f], low[some, f], "left")
            last[some, f] = np.searchsorted(values[f], high[some, f], "right")
        shortest = (last - first).argmin(1)
        first, last = first[own[:, 0], shortest], last[own[:, 0], shortest]
        count = np.maximum(0, last - first)
        narrow = count * NARROW <= len(rows)
        wide = np.flatnonzero(~narrow)
        # the rest of the cosine is at most the product of what is left of both lengths
        beyond = rest[wide, None] * np.sqrt(np.maximum(0.0, 1 - focused[wide].astype(np.float64) @ (rows * rows).T))
        line, places = np.nonzero(q[wide] @ rows.T + beyond >= c[wide] - _SLACK)
        lines = wide[line]
        if narrow.any():
            count = np.where(narrow, count, 0)
            line = np.repeat(own[:, 0], count)
            place = lists[shortest[line], first[line] + np.arange(len(line)) - (np.cumsum(count) - count)[line]]
            at = focus[line]
            part = rows[place[:, None], at]
            inside = ((part >= low[line[:, None], at]) & (part <= high[line[:, None], at])).all(1)
            line, place, part, at = line[inside], place[inside], part[inside], at[inside]
            beyond = rest[line] * np.sqrt(np.maximum(0.0, 1 - (part * part).sum(1)))
            may = (part * unit[line[:, None], at]).sum(1) + beyond >= cosine[line] - _SLACK
            lines, places = np.concatenate([lines, line[may]]), np.concatenate([places, place[may]])
            order = np.argsort(lines, kind="stable")
            lines, places = lines[order], places[order]
        return lines, places


def _in_order(lines: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Places by line, then falling score, ties to the smaller id."""
    if scores.dtype == object:
        return np.array(sorted(range(len(ids)), key=lambda i: (lines[i], -scores[i], ids[i])), int)
    return np.lexsort((ids, -scores, lines))


def _nth(lines: np.ndarray) -> np.ndarray:
    """The number of each place among those of its line, from 0; ``lines`` ascend."""
    return np.arange(len(lines)) - np.searchsorted(lines, lines)


class _Kept:
    """The k best (score, id) so far of each of ``n`` lines."""

    def __init__(self, k: int, n: int) -> None:
        self.k, self.n = k, n
        self.lines, self.scores, self.ids = np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64)

    def add(self, lines: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        if len(lines):
            lines, scores, ids = np.concatenate([self.lines, lines]), np.concatenate([self.scores.astype(scores.dtype), scores]), np.concatenate([self.ids, ids])
            order = _in_order(lines, scores, ids)
            order = order[_nth(lines[order]) < self.k]
            self.lines, self.scores, self.ids = lines[order], scores[order], ids[order]

    def least(self) -> np.ndarray:
        """The score that another row has to reach, one a line; -inf is any."""
        out = np.full(self.n, -np.inf)
        last = _nth(self.lines) == self.k - 1
        out[self.lines[last]] = self.scores[last]
        return out


def _anchors(cell: pa.Table) -> tuple[pa.Table, LengthBuckets, np.ndarray] | None:
    asks, rows = cell.filter(cell["asks"]), cell.filter(pc.invert(cell["asks"]))
    if not asks.num_rows or not rows.num_rows:
        return None
    queries = _matrix(asks)
    index = LengthBuckets(np.asarray(rows["vec_id"]), np.asarray(rows["label"]), _matrix(rows), np.abs(queries).max(initial=0))
    return asks, index, queries


_POSITIVES = "anchor_id long, anchor_key long, positive_id long, score long"
_NEGATIVES = "anchor_id long, anchor_key long, nth int, positive_id long, positive_score long, negative_id long, negative_score long"


def _rows(parts: list[tuple], schema: str) -> pa.Table:
    """The columns of all ``parts``, one after another."""
    names = [field.split() for field in schema.split(", ")]
    columns = [[x for part in column for x in part.tolist()] for column in zip(*parts, strict=True)] if parts else [[]] * len(names)
    kind = {"long": pa.int64(), "int": pa.int32()}
    return pa.table({name: pa.array([int(x) for x in c], kind[t]) for (name, t), c in zip(names, columns, strict=True)})


def _find_positives(cell: pa.Table, k: int) -> pa.Table:
    """Per anchor the k best other rows of the cell, whose rows have all the anchor's label."""
    found = _anchors(cell)
    parts = []
    if found:
        asks, index, queries = found
        anchors, keys = np.asarray(asks["vec_id"]), np.asarray(asks["key"])
        for lo in range(0, len(queries), TOGETHER):
            some = slice(lo, lo + TOGETHER)
            anchor, key, query = anchors[some], keys[some], queries[some]
            kept = _Kept(k, len(query))
            for lines, places, scores in index.all_reaching(query, kept.least):
                ids = index.ids[places]
                other = ids != anchor[lines]
                kept.add(lines[other], scores[other], ids[other])
            parts.append((anchor[kept.lines], key[kept.lines], kept.ids, kept.scores))
    return _rows(parts, _POSITIVES)


def _find_negatives(cell: pa.Table, k: int, low: int, high: int) -> pa.Table:
    """Per anchor and positive the k best rows of the cell of another label inside the band below the positive."""
    found = _anchors(cell)
    parts = []
    if found:
        asks, index, queries = found
        anchors, keys, labels = (np.asarray(asks[c]) for c in ("vec_id", "key", "label"))
        positives = asks["positives"].to_pylist()
        for lo in range(0, len(queries), TOGETHER):
            some = slice(lo, lo + TOGETHER)
            anchor, key, label, query, lists = anchors[some], keys[some], labels[some], queries[some], positives[some]
            nths = range(max(map(len, lists)))
            # whole scores between low and high percent of the positive's; (inf, -inf) for none
            bands = [[(-(-low * p[n]["score"] // 100), high * p[n]["score"] // 100) if n < len(p) else (np.inf, -np.inf) for p in lists] for n in nths]
            bands = [[band if band[0] <= band[1] else (np.inf, -np.inf) for band in column] for column in bands]
            kind = np.float64 if index.exact_floats else object  # there every score is exact as a float, and so is every edge that one may equal
            edges = [(np.array([band[0] for band in column], kind), np.array([band[1] for band in column], kind)) for column in bands]
            kept = [_Kept(k, len(query)) for _ in nths]

            def needed(edges=edges, kept=kept):
                return np.min([np.maximum(least, best.least()) for (least, _), best in zip(edges, kept, strict=True)], axis=0)

            for lines, places, scores in index.all_reaching(query, needed):
                ids = index.ids[places]
                other = (index.labels[places] != label[lines]) & (ids != anchor[lines])
                lines, scores, ids = lines[other], scores[other], ids[other]
                order = _in_order(lines, scores, ids)
                lines, scores, ids = lines[order], scores[order], ids[order]
                for (least, most), best in zip(edges, kept, strict=True):
                    inside = np.flatnonzero((scores >= least[lines]) & (scores <= most[lines]))
                    inside = inside[_nth(lines[inside]) < k]
                    best.add(lines[inside], scores[inside], ids[inside])
            for n, best in zip(nths, kept, strict=True):
                chosen = [lists[line][n] for line in best.lines]
                positive, score = (np.array([p[c] for p in chosen], np.int64) for c in ("positive_id", "score"))
                parts.append((anchor[best.lines], key[best.lines], np.full(len(chosen), n), positive, score, best.ids, best.scores))
    return _rows(parts, _NEGATIVES)


# ---------------------------------------------------------------- dealing

def _cells(rows: DataFrame, anchors: DataFrame, by: list[str], group_rows: int, block_rows: int) -> DataFrame:
    """Both sides dealt into cells ``by``, ``groups``, ``blocks``; anchors keep their further columns."""
    sizes = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows")).join(anchors.groupBy(*by).agg(F.count(F.lit(1)).alias("n_asks")), by)
    plan = stored(sizes.select(*by, F.ceil(F.col("n_rows") / group_rows).cast("int").alias("n_groups"), F.ceil(F.col("n_asks") / block_rows).cast("int").alias("n_blocks")), "cells")
    if plan.count() <= MAX_BROADCAST_PLAN:
        plan = F.broadcast(plan)
    more = [c for c in anchors.columns if c not in rows.columns]

    def dealt(side: DataFrame, own: str, other: str, asks: bool) -> DataFrame:
        number = F.pmod(F.xxhash64(F.lit(own), "vec_id", "label", "v"), F.col(f"n_{own}")).cast("int")
        extra = [F.col(c) if c in side.columns else F.lit(None).cast(dict(anchors.dtypes)[c]).alias(c) for c in more]
        return side.join(plan, by).select(
            *rows.columns, *extra, F.lit(asks).alias("asks"), number.alias(own), F.explode(F.sequence(F.lit(0), F.col(f"n_{other}") - 1)).alias(other))

    return dealt(rows, "groups", "blocks", False).unionByName(dealt(anchors, "blocks", "groups", True))


def hard_negatives(
    vectors: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 3, low: int = LOW, high: int = HIGH,
    group_rows: int = GROUP_ROWS, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` of ``anchors`` against ``vectors`` (both ``vec_id, label, v``).

    The positives of an anchor are its best rows of the same label; the
    negatives of a positive the best rows of other labels that score between
    ``low`` and ``high`` percent of it.
    """
    rows = stored(vectors.withColumn("width", F.size("v")), "vectors")
    asked = stored(anchors.withColumn("width", F.size("v")).withColumn("key", F.xxhash64("vec_id", "label", "v")), "anchors")

    first = _cells(rows, asked, ["width", "label"], group_rows, block_rows).groupBy("width", "label", "groups", "blocks")
    found = first.applyInArrow(lambda cell: _find_positives(cell, positives), _POSITIVES)
    nth = F.row_number().over(Window.partitionBy("anchor_id", "anchor_key").orderBy(F.desc("score"), "positive_id"))
    # at most ``positives`` rows an anchor
    lists = found.withColumn("nth", nth).where(F.col("nth") <= positives).groupBy("anchor_id", "anchor_key").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("nth", "positive_id", "score"))), lambda p: F.struct(p["positive_id"].alias("positive_id"), p["score"].alias("score"))).alias("positives"))
    ready = stored(asked.join(lists, [F.col("vec_id") == F.col("anchor_id"), F.col("key") == F.col("anchor_key")]).drop("anchor_id", "anchor_key"), "anchor_positives")

    second = _cells(rows, ready, ["width"], group_rows, block_rows).groupBy("width", "groups", "blocks")
    mined = second.applyInArrow(lambda cell: _find_negatives(cell, negatives, low, high), _NEGATIVES)
    rank = F.row_number().over(Window.partitionBy("anchor_id", "anchor_key", "nth").orderBy(F.desc("negative_score"), "negative_id"))
    return mined.withColumn("rank", rank).where(F.col("rank") <= negatives).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
