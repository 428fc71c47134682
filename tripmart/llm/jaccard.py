"""Exact n-gram Jaccard join: subsets for small sets, inverted lists for large ones.

A document is the set of its distinct word shingles; documents with the same
set are one node.  Two nodes link when their Jaccard similarity reaches the
threshold t.  Candidates come by size:

* Small sets (up to a boundary s) enumerate their subsets of a fixed size: a
  set of b shingles and any smaller one that is similar share at least
  ceil(t b) shingles, hence a subset of that size, which both enumerate.
* Large sets are found through inverted lists of their rarest shingles: similar
  sets of n shingles and fewer share one of their first n - ceil(t n) + 1 in any
  common order.  The order is by document count, rarest first, so passages that
  many documents share come last and long lists are not scanned.  A small set
  that may be similar to a large one stands in the lists too.
* The boundary s is where enumerating and list scanning, at the measured set
  sizes and list lengths, cost least in total.

The counts are exact, as with counts that chance lifts documents that have
nothing to do with each other share listed shingles, and the more there are the
more do, until all candidates hang together.  Shingles meet by hash, and only
those that a second document holds return to the batch of documents that they
came from (``shared_keys``, ``listed_keys``): what doesn't return is in one
document, comes first in the order and finds nobody, so most documents list
nothing.  ``SKETCH`` counters give the list lengths for the boundary, and which
shingles are alone in their counter and needn't be sent.

Candidates are then connected, dealt into bounded cells and compared exactly
(see ``linking``): in a cell, overlaps are counted by enumerating pairs in its
short lists and by matrix products over its long ones.

Defined results: a document without words or text has an empty set and links
with nothing; one with fewer words than a shingle has one shingle of all its
words; repeated documents link with each other; a null id takes part and its
component is the smallest id it reaches, null if none; an empty table gives an
empty result; further columns are not read.  Shingles and sets are compared by
64-bit hashes.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.llm import linking
from tripmart.llm.bitmaps import asked, bitmap, spread, spread_column
from tripmart.llm.linking import Union
from tripmart.llm.tables import free_name, stored
from tripmart.llm.textarrays import LOWER, NON_SPACE_BYTES, mix, shingles, text_chunks, word_hashes

WIDTH = 4
#: The threshold as a whole number of hundredths: comparisons stay exact.
PERCENT = 85
#: Counters of shingles: 8 MB once reduced to a byte each.
SKETCH = 1 << 23
SKETCH_SLICES = 64
#: A shingle whose counter has this rank is in one document.
ALONE = 8
#: Bytes of text whose shingles are sent at once.
SEND_BYTES = 4 << 20
#: The largest boundary tried between small and large sets.
MAX_SMALL = 20
#: Lists up to this length are enumerated pair by pair when overlaps are counted.
SHORT_LIST = 24


_LAST_ID = (1 << 63) - 1


def row_key() -> Column:
    """What tells documents apart: their id and text."""
    return F.xxhash64("doc_id", "text").alias("row_key")


def needed(size: int | np.ndarray, percent: int) -> int | np.ndarray:
    """The least overlap with a set that is similar and not larger."""
    return -(-size * percent // 100)


def document_sets(column: pa.Array, width: int = WIDTH) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Per chunk (first row, end row, shingles, set starts): each text's distinct shingles in ascending order."""
    for lo, hi, data, offsets in text_chunks(column):
        words, rows = word_hashes(LOWER[data], offsets, NON_SPACE_BYTES)
        found, rows = shingles(words, rows, hi - lo, width)
        ends = np.cumsum(np.bincount(rows, minlength=hi - lo))
        begin = 0
        for end in ends:
            found[begin:end].sort()
            begin = end
        fresh = np.ones(len(found), bool)
        fresh[1:] = (found[1:] != found[:-1]) | (rows[1:] != rows[:-1])
        starts = np.concatenate([[0], np.cumsum(np.bincount(rows[fresh], minlength=hi - lo))])
        yield lo, hi, found[fresh], starts


def set_hashes(found: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """One hash per set; meaningless for an empty one."""
    sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(found), dtype=np.uint64)])
    sizes = np.diff(starts).astype(np.uint64)
    return mix(sums[starts[1:]] - sums[starts[:-1]] + sizes * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)


def frequency_ranks(docs: DataFrame, width: int = WIDTH, sketch: int = SKETCH) -> tuple[np.ndarray, np.ndarray, float]:
    """A byte per counter that grows with the logarithm of its count; documents by set size up to ``MAX_SMALL``; mean list length."""
    part = sketch // SKETCH_SLICES

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(sketch, np.uint16)
        by_size = np.zeros(MAX_SMALL + 2, np.int64)
        for batch in batches:
            for _, _, found, starts in document_sets(batch.column(0), width):
                place, times = np.unique((found >> np.uint64(8)) % np.uint64(sketch), return_counts=True)
                counts[place] = np.minimum(counts[place] + times, 65535).astype(np.uint16)
                by_size += np.bincount(np.minimum(np.diff(starts), MAX_SMALL + 1), minlength=MAX_SMALL + 2)
        rows = [{"slice": -1, "counts": by_size.tobytes()}]
        rows += [{"slice": k, "counts": zlib.compress(counts[k * part:(k + 1) * part].tobytes(), 1)} for k in range(SKETCH_SLICES)]
        yield pa.RecordBatch.from_pylist(rows, pa.schema([("slice", pa.int32()), ("counts", pa.binary())]))

    def add(group: pa.Table) -> pa.Table:
        number = group["slice"][0].as_py()
        if number < 0:
            total = sum(np.frombuffer(x.as_py(), np.int64) for x in group["counts"])
            return pa.table({"slice": pa.array([-1], pa.int32()), "ranks": pa.array([total.tobytes()]), "rows": [0.0], "squares": [0.0]})
        total = np.zeros(part, np.float64)
        for x in group["counts"]:
            total += np.frombuffer(zlib.decompress(x.as_py()), "<u2")
        ranks = np.minimum(255, 8 * np.log2(1 + total)).astype(np.uint8)
        return pa.table({"slice": pa.array([number], pa.int32()), "ranks": pa.array([ranks.tobytes()]), "rows": [total.sum()], "squares": [(total * total).sum()]})

    rows = docs.select("text").mapInArrow(count, "slice int, counts binary").groupBy("slice").applyInArrow(
        add, "slice int, ranks binary, rows double, squares double"
    ).collect()  # SKETCH bytes in all
    ranks, by_size = np.zeros(sketch, np.uint8), np.zeros(MAX_SMALL + 2, np.int64)
    for row in rows:
        if row["slice"] < 0:
            by_size = np.frombuffer(row["ranks"], np.int64)
        else:
            ranks[row["slice"] * part:(row["slice"] + 1) * part] = np.frombuffer(row["ranks"], np.uint8)
    return ranks, by_size, mean_list(sum(row["rows"] for row in rows), sum(row["squares"] for row in rows), sketch)


def mean_list(total: float, squares: float, sketch: int) -> float:
    """The mean list length of a shingle, from the counters' sum and sum of squares less what sharing a counter adds."""
    return max(1.0, (squares - total * total / sketch) / (1 - 1 / sketch) / total) if total else 0.0


def subset_sizes(size: int, boundary: int, percent: int) -> list[int]:
    """Sizes of the subsets that a small set enumerates: one per size of a similar small set as large or larger."""
    largest = min(boundary, size * 100 // percent)
    return sorted({int(needed(m, percent)) for m in range(size, largest + 1)})


def choose_boundary(by_size: np.ndarray, list_length: float, percent: int) -> int:
    """The boundary at which subsets of small and lists of large sets cost least."""

    def cost(boundary: int) -> float:
        total = 0.0
        for size in range(1, MAX_SMALL + 1):
            prefix = (size - needed(size, percent) + 1) * (1 + list_length)
            if size <= boundary:
                total += by_size[size] * sum(math.comb(size, c) for c in subset_sizes(size, boundary, percent) if c <= size)
            if size > boundary or size >= needed(boundary + 1, percent):
                total += by_size[size] * prefix
        return total

    return min(range(MAX_SMALL + 1), key=lambda s: (cost(s), s))


def _subset_keys(tokens: np.ndarray, boundary: int, percent: int) -> np.ndarray:
    """A hash of each subset of the enumerated sizes."""
    n = len(tokens)
    values = mix(tokens)
    whole = values.sum(dtype=np.uint64)
    keys = []
    for size in subset_sizes(n, boundary, percent):
        if size <= n:
            out = np.array(list(combinations(range(n), n - size)), np.int64).reshape(math.comb(n, size), n - size)
            keys.append(mix(whole - values[out].sum(axis=1, dtype=np.uint64) + np.uint64(size * 0xD1B54A32D192ED03 % (1 << 64))))
    return np.concatenate(keys)


def candidate_parts(docs: DataFrame, ranks: np.ndarray, boundary: int, buckets: int, width: int, percent: int) -> DataFrame:
    """Subset keys of small sets, the shingles of large ones, and as info columns (row key, id, size, node) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        emitted: set[int] = set()
        columns, keys, nodes, sizes, tokens, owners = [], [], [], [], [], []
        rows = held = 0

        def send() -> pa.RecordBatch:
            parts = [linking.info_part(number, *(np.concatenate(c) for c in zip(*columns, strict=True)))]
            if keys:
                parts += linking.parts_of(np.concatenate(keys), np.concatenate(nodes), np.concatenate(sizes).astype("<i4"), 1, buckets)
            parts += _token_parts(number, np.concatenate(tokens), np.concatenate(owners), rows, buckets)
            for held_back in (columns, keys, nodes, sizes, tokens, owners):
                held_back.clear()
            return linking.part_batch(parts)

        for batch in batches:
            ids, row_keys = np.asarray(batch.column(0).fill_null(_LAST_ID)), np.asarray(batch.column(2))
            for lo, hi, found, starts in document_sets(batch.column(1), width):
                size, node = np.diff(starts), set_hashes(found, starts)
                columns.append((row_keys[lo:hi], ids[lo:hi], size, node))
                # a set seen before in this task has sent its keys
                fresh = np.array([n > 0 and x not in emitted and not emitted.add(x) for x, n in zip(node.tolist(), size.tolist(), strict=True)], bool)
                sent = np.repeat(fresh & (size >= needed(boundary + 1, percent)), size)
                sent &= ranks[((found >> np.uint64(8)) % np.uint64(len(ranks))).astype(np.int64)] > ALONE
                tokens.append(mix(found[sent]))
                owners.append(np.repeat(np.arange(rows, rows + hi - lo), size)[sent])
                for k in np.flatnonzero(fresh & (size <= boundary)):
                    own = _subset_keys(found[starts[k]:starts[k + 1]], boundary, percent)
                    keys.append(own)
                    nodes.append(np.full(len(own), node[k]))
                    sizes.append(np.full(len(own), size[k]))
                rows, held = rows + hi - lo, held + 8 * len(found)
                if held > SEND_BYTES:
                    yield send()
                    rows, held, number = 0, 0, number + 1
        if columns:
            yield send()

    return docs.select(F.col("doc_id").cast("long"), "text", row_key()).mapInArrow(run, linking.PART_SCHEMA)


def _token_parts(number: int, tokens: np.ndarray, owners: np.ndarray, rows: int, buckets: int) -> Iterator[dict]:
    """One row per bucket with the shingles (as 32 bits) of a batch and the place of their document in it."""
    for row in linking.parts_of(tokens, owners.astype("<u2" if rows <= 1 << 16 else "<u4"), None, 2, buckets):
        yield row | {"extra": np.int64(number).tobytes()}


def _places(row: dict) -> np.ndarray:
    return np.frombuffer(row["nodes"], "<u2" if 2 * len(row["nodes"]) == len(row["keys"]) else "<u4")


def shared_keys(parts: DataFrame) -> DataFrame:
    """The parts without subset keys and shingles that only one document sent; shingles return to their batch, with their counts."""

    def run(group: pa.Table) -> pa.Table:
        bucket = group["bucket"][0].as_py()
        if bucket < 0:
            return group
        rows, out = group.to_pylist(), []
        subsets = [r for r in rows if r["kind"] == 1]
        if subsets:
            keys, nodes, sizes = (np.concatenate([np.frombuffer(r[c], t) for r in subsets]) for c, t in (("keys", "<u4"), ("nodes", "<i8"), ("extra", "<i4")))
            order = np.lexsort((nodes, keys))
            keys, nodes, sizes = keys[order], nodes[order], sizes[order]
            first, length = _groups(keys)
            several = np.repeat(nodes[first] != nodes[first + length - 1], length)
            if several.any():
                out.append({"bucket": bucket, "kind": 1, "keys": keys[several].tobytes(), "nodes": nodes[several].tobytes(), "extra": sizes[several].tobytes()})
        listed = [r for r in rows if r["kind"] == 2]
        if listed:
            each = [np.frombuffer(r["keys"], "<u4") for r in listed]
            keys = np.concatenate(each)
            order = np.argsort(keys)
            _, length = _groups(keys[order])
            count = np.zeros(len(keys), np.int64)
            count[order] = np.repeat(length, length)
            end = np.cumsum([len(k) for k in each])
            for row, own, hi in zip(listed, each, end, strict=True):
                mine = count[hi - len(own):hi]
                kept = np.flatnonzero(mine > 1)
                if len(kept):
                    out.append({
                        "bucket": -1 - int(np.frombuffer(row["extra"], np.int64)[0]), "kind": 2, "keys": own[kept].tobytes(), "nodes": _places(row)[kept].tobytes(),
                        "extra": np.int64(bucket).tobytes() + count_code(mine[kept]).tobytes(),
                    })
        return pa.Table.from_batches([linking.part_batch(out)])

    return parts.groupBy("bucket").applyInArrow(run, linking.PART_SCHEMA)


def _groups(ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first places, lengths) of runs of equal values."""
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(ordered) else np.zeros(0, np.int64)
    return first, np.diff(np.append(first, len(ordered)))


def count_code(count: np.ndarray) -> np.ndarray:
    """A byte that grows with the count: the count up to 64, then by its logarithm."""
    return np.minimum(255, np.where(count <= 64, count, 64 + 8 * np.log2(np.maximum(count, 64) / 64))).astype(np.uint8)


def listed_keys(shared: DataFrame, buckets: int, percent: int) -> DataFrame:
    """The parts with, instead of the returned shingles, keys of those among the rarest of their set."""

    def run(group: pa.Table) -> pa.Table:
        if group["bucket"][0].as_py() >= 0:
            return group
        rows = group.to_pylist()
        out, back = [r for r in rows if r["kind"] == 0], [r for r in rows if r["kind"] == 2]
        if back:
            _, _, size, node = np.frombuffer(out[0]["extra"], np.int64).reshape(4, -1)
            place = np.concatenate([_places(r) for r in back]).astype(np.int64)
            count = np.concatenate([np.frombuffer(r["extra"], np.uint8, offset=8) for r in back])
            token = np.concatenate([
                np.frombuffer(r["keys"], "<u4").astype(np.uint64) | np.frombuffer(r["extra"], np.uint64, 1) << np.uint64(32) for r in back
            ])
            order = np.lexsort((token, count, place))
            place, token = place[order], token[order]
            first, length = _groups(place)
            size, node = size[place[first]], node[place[first]]
            # the shingles that didn't return come first
            rarest = np.clip(size - needed(size, percent) + 1 - (size - length), 0, length)
            at = np.repeat(first, rarest) + np.arange(rarest.sum()) - np.repeat(np.cumsum(rarest) - rarest, rarest)
            out += linking.parts_of(mix(token[at]), np.repeat(node, rarest), np.repeat(size, rarest).astype("<i4"), 1, buckets)
        return pa.Table.from_batches([linking.part_batch(out)])

    return shared.groupBy("bucket").applyInArrow(run, linking.PART_SCHEMA)


def list_edges(percent: int):
    """Star edges among the nodes of each key whose sizes lie close enough."""

    def edges(by_kind: dict) -> tuple[np.ndarray, np.ndarray]:
        keys, nodes, sizes = by_kind[1]
        order = np.lexsort((nodes, sizes, keys))
        keys, nodes, sizes = keys[order], nodes[order], sizes[order].astype(np.int64)
        # in size order, a gap too wide for neighbours is too wide for any pair across it
        apart = np.ones(len(keys), bool)
        apart[1:] = (keys[1:] != keys[:-1]) | (sizes[:-1] * 100 < percent * sizes[1:])
        first = np.flatnonzero(apart)
        return nodes, nodes[np.repeat(first, np.diff(np.append(first, len(keys))))]

    return edges


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Common elements of every two sets."""
    n = len(sets)
    tokens = np.concatenate(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    order = np.argsort(tokens, kind="stable")
    tokens, owner = tokens[order], owner[order]
    first = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]]))
    length = np.diff(np.append(first, len(tokens)))
    common = np.zeros(n * n, np.int64)
    for size in np.unique(length[(length > 1) & (length <= SHORT_LIST)]):
        lists = owner[first[length == size][:, None] + np.arange(size)]
        i, j = np.triu_indices(size, 1)
        common += np.bincount((lists[:, i] * n + lists[:, j]).ravel(), minlength=n * n)
    common = common.reshape(n, n)
    long = np.flatnonzero(length > SHORT_LIST)
    for lo in range(0, len(long), 2048):
        some = long[lo:lo + 2048]
        where = np.repeat(first[some], length[some]) + np.arange(length[some].sum()) - np.repeat(np.cumsum(length[some]) - length[some], length[some])
        holds = np.zeros((n, len(some)), np.float32)
        holds[owner[where], np.repeat(np.arange(len(some)), length[some])] = 1
        common += np.triu(holds @ holds.T, 1).astype(np.int64)
    return common  # above the diagonal


def similar_pairs(percent: int):
    def links(contents: list[bytes], split: int, seen: Union) -> Iterator[tuple[int, int]]:
        sets = [np.frombuffer(c, "<u8") for c in contents]
        sizes = np.array([len(s) for s in sets])
        if len(sets) == 2:
            both = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
            if 100 * both >= percent * (int(sizes.sum()) - both):
                yield 0, 1
            return
        common = overlaps(sets)
        near = 100 * common >= percent * (sizes[:, None] + sizes[None, :] - common)
        near &= np.triu(np.ones_like(near), 1)
        if split:
            near[:split, :split] = False
            near[split:, split:] = False
        for i, j in zip(*(x.tolist() for x in np.nonzero(near)), strict=True):
            yield i, j

    return links


def _set_contents(docs: DataFrame, marks: np.ndarray, width: int) -> DataFrame:
    """``node, row_key, content`` of the documents whose (node, row key) may be marked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row_keys = np.asarray(batch.column(1))
            for lo, hi, found, starts in document_sets(batch.column(0), width):
                node = set_hashes(found, starts)
                wanted = np.flatnonzero(asked(marks, spread(node, row_keys[lo:hi])) & (np.diff(starts) > 0))
                yield pa.RecordBatch.from_arrays([
                    pa.array(node[wanted]), pa.array(row_keys[lo:hi][wanted]),
                    pa.array([found[starts[k]:starts[k + 1]].tobytes() for k in wanted], pa.binary()),
                ], ["node", "row_key", "content"])

    return docs.select("text", row_key()).mapInArrow(run, "node long, row_key long, content binary")


def classes(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """``row_key, doc_id, n_shingles, component_id, first`` of every row of ``docs(doc_id, text)``.

    ``first`` is the row key of the component's first document, by id and then row key.
    """
    ranks, by_size, list_length = frequency_ranks(docs, width)
    boundary = choose_boundary(by_size, list_length, percent)
    buckets = linking.bucket_count(docs)
    shared = shared_keys(candidate_parts(docs, ranks, boundary, buckets, width, percent))
    found = stored(linking.met(listed_keys(shared, buckets, percent), list_edges(percent), "<i4"), "jaccard_candidates")
    info = found.where("kind = 0").select(
        F.col("a").alias("row_key"), F.col("b").alias("id"), F.col("c").alias("n"), F.when(F.col("c") > 0, F.col("d")).alias("node")
    )
    full = info.where("node is not null")

    near = linking.components(found.where("kind = 1").select("a", "b"))
    # each node is compared through one of its documents
    chosen = full.groupBy("node").agg(F.min("n").alias("n"), F.min("row_key").alias("row_key")).join(near, "node").checkpoint()
    dealt = linking.cells(chosen.select(
        "node", "root", F.floor(F.log("n") / -math.log(percent / 100 - 0.001)).cast("int").alias("size_class"), (F.col("n") * 8).alias("bytes")
    ))
    marks = bitmap(chosen.select(spread_column(F.col("node"), F.col("row_key")).alias("place")), "place")
    # the sets move twice: to their cells' rows and with them to the cells
    members = dealt.join(chosen.select("node", "row_key"), "node").join(_set_contents(docs, marks, width), ["node", "row_key"])
    links = linking.verified(members, similar_pairs(percent))

    of_node = linking.components(links).withColumnRenamed("root", "class")
    least = full.groupBy("node").agg(F.min(F.struct("id", "row_key")).alias("least")).join(of_node, "node", "left")
    least = least.withColumn("class", F.coalesce("class", "node"))
    firsts = least.groupBy("class").agg(F.min("least").alias("first"))
    by_node = least.select("node", "class").join(firsts, "class").drop("class")
    own = F.coalesce("first", F.struct("id", "row_key"))
    return info.join(by_node, "node", "left").select(
        "row_key", F.nullif("id", F.lit(_LAST_ID)).alias("doc_id"), F.col("n").alias("n_shingles"),
        F.nullif(own["id"], F.lit(_LAST_ID)).alias("component_id"), own["row_key"].alias("first"),
    )


def jaccard_components(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row of ``docs(doc_id, text)``."""
    return classes(docs, width, percent).select("doc_id", "n_shingles", "component_id")


def drop_near_copies(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """The first document of each component, with all columns of ``docs``; of rows alike in id and text, one."""
    key = free_name(docs, "_row_key")
    kept = classes(docs, width, percent).where("row_key = first").select(F.col("row_key").alias(key))
    return docs.withColumn(key, row_key()).join(kept, key, "left_semi").dropDuplicates([key]).select(docs.columns)
