"""Exact top-k inner products by a three-phase uniform threshold.

A vector is cut into ``lists`` slices of dimensions; a pair's score is the sum
of its partial scores over the slices.  Candidates are dealt into groups of a
bounded number of rows, queries into blocks, and every (group, block) cell is
one task's work, a few matrix products.  The cells are the stated query set
against all rows, block by block.  In a cell each slice is a list of the rows
in falling order of the length of that slice: |q||r| bounds a partial score, so
what a threshold rules out is a tail of the list, which is never multiplied.

1. Each cell gathers, per query and list, the k best partial scores among the
   list's first ``head`` rows, and the full scores of these few entries.  The
   k-th best full score among all gathered entries of a query bounds its final
   k-th score from below: a safe cutoff.
2. The cutoffs travel back with the query blocks.  An entry whose total
   reaches cutoff c has, in at least one slice, a partial score of c / lists or
   more, so every list is read down to where |q||r| falls below that uniform
   threshold, and the entries that pass it in some list are a sufficient set.
3. Of a collected entry some slices may not have been read.  Where what is known
   and |q||r| of those slices can't reach the cutoff it is dropped; only for the
   others are the remaining scores computed, exactly, and the k best kept.

Scores are integers.  Products are taken in 64-bit floats while every sum stays
below 2**53, where they are exact, and in Python integers beyond.

Defined results: vectors that are null or hold a null or non-finite component
take no part, nor do rows with a null id; an empty vector has score 0 with
every other empty one; vectors of different lengths are not compared; rows that
repeat an id and vector count once; rows that share an id are not candidates of
each other; with fewer than k candidates a query gets all; ties go to the
smaller id; empty tables give an empty result; further columns are not read.
A score outside 64 bits raises an error.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmart.session import ensure_checkpoint_dir

GROUP_ROWS = 8192
BLOCK_ROWS = 2048
LISTS = 4
#: Rows at the head of each list that the first phase reads.
HEAD = 256
#: Queries that read the same stretch of a list together.
TOGETHER = 128
#: Pairs whose remaining scores are computed at a time.
PAIRS = 1 << 16
#: Room for rounding in the lengths of slices.
SLACK = 1 + 1e-9
#: Distinct vector lengths up to which their few numbers each are broadcast.
MAX_BROADCAST_WIDTHS = 10_000

_CELL = "query_id long, query_key long, vec_id long, score long"


def quantised(vectors: DataFrame, scale: int = 256, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """``vec_id, v``: each component floor(scale * x) as a whole double; unusable rows left out."""
    usable = F.col(column).isNotNull() & ~F.exists(
        F.col(column).cast("array<double>"), lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    )
    # floor() of a double gives a long and would clip; beyond 2**52 a double is whole already
    whole = F.transform(
        F.col(column).cast("array<double>"),
        lambda x: F.when(F.abs(x * float(scale)) < float(1 << 52), F.floor(x * float(scale)).cast("double")).otherwise(x * float(scale)),
    )
    return vectors.where(usable & F.col(id_column).isNotNull()).select(
        F.col(id_column).cast("long").alias("vec_id"), whole.alias("v")
    ).dropDuplicates(["vec_id", "v"])


def _matrix(table: pa.Table) -> np.ndarray:
    values = table["v"].combine_chunks()
    flat = np.asarray(values.flatten(), np.float64)
    return flat.reshape(len(values), len(flat) // max(1, len(values)))


def _slices(width: int, lists: int) -> list[slice]:
    edges = np.linspace(0, width, lists + 1).astype(int)
    return [slice(a, b) for a, b in zip(edges[:-1], edges[1:], strict=True)]


def _exact(queries: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both sides in a type in which every sum of products is exact."""
    bound = np.abs(queries).max(initial=0) * np.abs(rows).max(initial=0) * max(1, queries.shape[1])
    if bound >= 2.0**53:
        to_int = np.frompyfunc(int, 1, 1)
        return to_int(queries).astype(object), to_int(rows).astype(object)
    return queries, rows


def _lengths(matrix: np.ndarray, lists: int) -> np.ndarray:
    """The Euclidean length of each slice of each row, never too small."""
    return np.stack([np.linalg.norm(matrix[:, s], axis=1) for s in _slices(matrix.shape[1], lists)], axis=1) * SLACK


def _add_products(scores: np.ndarray, queries: np.ndarray, rows: np.ndarray, line: np.ndarray, at: np.ndarray) -> None:
    """Add to ``scores`` the products of the given pairs of queries and rows."""
    for lo in range(0, len(line), PAIRS):
        some = slice(lo, lo + PAIRS)
        scores[some] += (queries[line[some]] * rows[at[some]]).sum(axis=1)


def _top(scores: np.ndarray, k: int) -> np.ndarray:
    """Per row of ``scores`` the columns of its k highest, ties to the first."""
    if scores.shape[1] <= k or scores.dtype == object:
        return np.argsort(-scores, axis=1, kind="stable")[:, :k]
    kth = -np.partition(-scores, k - 1, axis=1)[:, k - 1:k]
    # at most k - 1 lie above the k-th score; the first equal ones fill up
    above = scores > kth
    level = scores == kth
    fill = level & (np.cumsum(level, axis=1) <= k - above.sum(axis=1, keepdims=True))
    return np.nonzero(above | fill)[1].reshape(len(scores), k)


def gathered(
    q_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int, lists: int = LISTS, head: int = HEAD,
) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Phase 1 in one cell: query and row numbers, full scores, and the products taken; ``ids`` ascend."""
    lengths = _lengths(rows, lists)
    q, r = _exact(queries, rows)
    pairs, products = [], 0
    for number, part in enumerate(_slices(rows.shape[1], lists)):
        first = np.sort(np.argsort(-lengths[:, number], kind="stable")[:head])
        scores = q[:, part] @ r[first, part].T
        products += scores.size * (part.stop - part.start)
        own = q_ids[:, None] == ids[None, first]
        at = _top(np.where(own, scores.min() - 1, scores), k)
        line = np.repeat(np.arange(len(q_ids)), at.shape[1])
        at = at.ravel()
        ok = ~own[line, at]
        pairs.append(line[ok] * len(ids) + first[at[ok]])
    line, at = np.divmod(np.unique(np.concatenate(pairs)), len(ids))
    scores = np.zeros(len(line), q.dtype)
    _add_products(scores, q, r, line, at)
    return line, at, scores, products + len(line) * rows.shape[1]


def sufficient(
    q_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, rows: np.ndarray, cutoffs: list[int | None], k: int, lists: int = LISTS,
) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Phases 2 and 3 in one cell: query and row numbers and scores of its k best from the cutoffs on, and the products taken; ``ids`` ascend."""
    q_length, r_length = _lengths(queries, lists), _lengths(rows, lists)
    q, r = _exact(queries, rows)
    cutoff = np.array([-np.inf if c is None else c for c in cutoffs], object if q.dtype == object else np.float64)
    least = cutoff.astype(np.float64)
    total = np.zeros((len(q_ids), len(ids)), q.dtype)
    enough = np.zeros(total.shape, bool)
    depth = np.zeros((len(q_ids), lists), np.int64)  # rows of each list that were read
    places = np.zeros((lists, len(ids)), np.int64)
    products = 0
    for number, part in enumerate(_slices(rows.shape[1], lists)):
        order = np.argsort(-r_length[:, number], kind="stable")
        places[number, order] = np.arange(len(ids))
        # a list is read while |q||r| may reach c / lists
        with np.errstate(divide="ignore", invalid="ignore"):
            shortest = np.where(least <= 0, -1.0, least / lists / q_length[:, number] / SLACK)
        wanted = np.searchsorted(-r_length[order, number], -shortest, "right")
        by_depth = np.argsort(wanted, kind="stable")
        for lo in range(0, len(by_depth), TOGETHER):
            some = by_depth[lo:lo + TOGETHER]
            down_to = int(wanted[some[-1]])
            depth[some, number] = down_to
            if not down_to:
                continue
            columns = order[:down_to] if down_to < len(ids) else slice(None)
            scores = q[some, part] @ r[columns, part].T
            products += scores.size * (part.stop - part.start)
            place = np.ix_(some, columns) if down_to < len(ids) else some
            total[place] += scores
            enough[place] |= (scores * lists >= cutoff[some, None]).astype(bool)  # no rounding: both sides are whole numbers
    line, at = np.nonzero(enough & (q_ids[:, None] != ids[None, :]))
    unread = [places[number, at] >= depth[line, number] for number in range(lists)]
    reach = total[line, at].astype(np.float64)
    for number in range(lists):
        reach[unread[number]] += (q_length[line, number] * r_length[at, number])[unread[number]]
    alive = reach + np.abs(reach) * (SLACK - 1) >= least[line]
    line, at, unread = line[alive], at[alive], [u[alive] for u in unread]
    scores = total[line, at]
    for number, part in enumerate(_slices(rows.shape[1], lists)):
        more = np.flatnonzero(unread[number])
        rest = np.zeros(len(more), scores.dtype)
        _add_products(rest, q[:, part], r[:, part], line[more], at[more])
        scores[more] += rest
        products += len(more) * (part.stop - part.start)
    reached = (scores >= cutoff[line]).astype(bool)
    line, at, scores = line[reached], at[reached], scores[reached]
    # a cell's own k best suffice, ties to the smaller id
    order = np.lexsort((ids[at], -scores, line)) if scores.dtype != object else np.array(
        sorted(range(len(line)), key=lambda i: (line[i], -scores[i], ids[at[i]])), int)
    line, at, scores = line[order], at[order], scores[order]
    best = np.arange(len(line)) - np.searchsorted(line, line) < k
    return line[best], at[best], scores[best], products


def _emit(query_ids: np.ndarray, keys: np.ndarray, vec_ids: np.ndarray, scores: np.ndarray) -> pa.Table:
    to_long = [int(s) for s in scores] if scores.dtype == object else scores.astype(np.int64)
    return pa.table({
        "query_id": pa.array(query_ids, pa.int64()), "query_key": pa.array(keys, pa.int64()),
        "vec_id": pa.array(vec_ids, pa.int64()), "score": pa.array(to_long, pa.int64()),
    })


def exact_top_k(
    vectors: DataFrame, queries: DataFrame, k: int = 5, lists: int = LISTS,
    group_rows: int = GROUP_ROWS, block_rows: int = BLOCK_ROWS, head: int = HEAD,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's k best rows of ``vectors(vec_id, v)`` by inner product."""
    size = vectors.groupBy(F.size("v").alias("width")).agg(F.count("*").alias("rows"))
    asked = queries.groupBy(F.size("v").alias("width")).agg(F.count("*").alias("asked"))
    # one row per vector length: how many groups and blocks it is dealt into
    plan = size.join(asked, "width").select(
        "width", F.ceil(F.col("rows") / group_rows).cast("int").alias("groups"), F.ceil(F.col("asked") / block_rows).cast("int").alias("blocks")
    )
    ensure_checkpoint_dir(vectors.sparkSession)
    plan = plan.checkpoint()
    if plan.count() <= MAX_BROADCAST_WIDTHS:
        plan = F.broadcast(plan)
    key = F.xxhash64("vec_id", "v")

    def dealt(side: DataFrame, own: str, other: str, seed: int) -> DataFrame:
        mine = side.withColumn("width", F.size("v")).join(plan, "width")
        return mine.select(
            "width", "vec_id", "v", (F.col("cutoff") if "cutoff" in side.columns else F.lit(None).cast("long")).alias("cutoff"),
            key.alias("key"), F.lit(seed == 2).alias("asks"),
            F.pmod(F.xxhash64(F.lit(seed), "vec_id", "v"), F.col(own)).cast("int").alias(own),
            F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(other),
        )

    def in_cells(queries: DataFrame, work) -> DataFrame:
        """``work(queries, rows)`` on the two sides of every cell."""

        def split(cell: pa.Table) -> pa.Table:
            left, right = cell.filter(cell["asks"]), cell.filter(pc.invert(cell["asks"]))
            return work(left, right) if left.num_rows and right.num_rows else _emit([], [], [], np.zeros(0))

        both = dealt(queries, "blocks", "groups", 2).unionByName(rows)
        return both.groupBy("width", "groups", "blocks").applyInArrow(split, _CELL)

    rows = dealt(vectors, "groups", "blocks", 1)

    def sides(left: pa.Table, right: pa.Table):
        """Query ids and vectors, row ids (ascending) and vectors."""
        right = right.sort_by("vec_id")
        return np.asarray(left["vec_id"]), _matrix(left), np.asarray(right["vec_id"]), _matrix(right)

    def gather(left: pa.Table, right: pa.Table) -> pa.Table:
        q_ids, q, ids, r = sides(left, right)
        line, at, scores, _ = gathered(q_ids, q, ids, r, k, lists, head)
        return _emit(q_ids[line], np.asarray(left["key"])[line], ids[at], scores)

    def collect(left: pa.Table, right: pa.Table) -> pa.Table:
        q_ids, q, ids, r = sides(left, right)
        line, at, scores, _ = sufficient(q_ids, q, ids, r, left["cutoff"].to_pylist(), k, lists)
        return _emit(q_ids[line], np.asarray(left["key"])[line], ids[at], scores)

    seen = in_cells(queries, gather)
    # the k best of each query among what was gathered: at most k * lists rows a cell
    ranked = F.row_number().over(Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id"))
    cutoffs = seen.withColumn("n", ranked).where(F.col("n") == k).select(
        F.col("query_id").alias("vec_id"), F.col("query_key").alias("key"), F.col("score").alias("cutoff")
    )
    entries = in_cells(queries.withColumn("key", key).join(cutoffs, ["vec_id", "key"], "left").drop("key"), collect)
    final = F.row_number().over(Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id"))
    return entries.withColumn("rank", final).where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"
    )
