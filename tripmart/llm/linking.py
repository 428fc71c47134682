"""Steps that similarity joins share: candidate keys, components, verification cells.

A join over nodes (distinct texts, by hash) runs in four steps.

1. One scan emits candidate keys: similar nodes share at least one.  The keys
   travel as sorted arrays, one row per task batch and bucket of the key space,
   and each bucket's keys are grouped where they meet.  The nodes of a key
   become star edges to one of them, never all pairs.
2. Connected components of those edges hold every pair that may be similar.
3. Each component's nodes are dealt into cells: a small component is one cell,
   packed with others; a large one is cut by size class and hash into blocks,
   and only pairs of blocks whose sizes can be similar form a cell.  Each cell
   is bounded, however many copies a text has.
4. A cell compares its nodes exactly and returns the links that connect it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.session import ensure_checkpoint_dir

#: Rows that take part in one block of a cell, and the bytes of content they may hold.
BLOCK_ROWS = 512
BLOCK_BYTES = 4 << 20
#: Key buckets: about so many bytes of text each, and at least so many buckets.
TEXT_PER_BUCKET = 8 << 20
LEAST_BUCKETS = 96

PART_SCHEMA = "bucket long, kind int, keys binary, nodes binary, extra binary"
FOUND_SCHEMA = "kind int, a long, b long, c long, d long"


def bucket_count(docs: DataFrame) -> int:
    """Buckets for the keys of all texts of ``docs(text)``."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(LEAST_BUCKETS, -(-size // TEXT_PER_BUCKET))


def parts_of(keys: np.ndarray, nodes: np.ndarray, extra: np.ndarray | None, kind: int, buckets: int) -> Iterator[dict]:
    """One row per bucket with its keys (as 32 bits), nodes and extra values.

    Keys that agree in bucket and 32 bits but not in full only add candidates.
    """
    if not len(keys):
        return
    place = (keys >> np.uint64(32)) % np.uint64(buckets)
    order = np.argsort(place.astype(np.uint16 if buckets < 1 << 16 else np.int64), kind="stable")
    place, keys, nodes = place[order], keys[order].astype(np.uint32), nodes[order]
    extra = extra[order] if extra is not None else None
    edges = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    for lo, hi in zip(edges, [*edges[1:], len(place)], strict=True):
        yield {
            "bucket": int(place[lo]), "kind": kind, "keys": keys[lo:hi].tobytes(),
            "nodes": nodes[lo:hi].tobytes(), "extra": extra[lo:hi].tobytes() if extra is not None else b"",
        }


def info_part(number: int, *columns: np.ndarray) -> dict:
    """A row that carries columns of long values past the grouping, in a bucket of its own."""
    return {
        "bucket": -1 - number, "kind": 0, "keys": b"", "nodes": b"",
        "extra": np.stack([c.astype(np.int64) for c in columns]).tobytes(),
    }


def part_batch(rows: list[dict]) -> pa.RecordBatch:
    schema = pa.schema([("bucket", pa.int64()), ("kind", pa.int32()), ("keys", pa.binary()), ("nodes", pa.binary()), ("extra", pa.binary())])
    return pa.RecordBatch.from_pylist(rows, schema)


def found_table(kind: int, *columns: np.ndarray) -> pa.Table:
    n = len(columns[0])
    filled = [*columns, *[np.zeros(n, np.int64)] * (4 - len(columns))]
    return pa.table({"kind": pa.array(np.full(n, kind, np.int32)), **{name: pa.array(c.astype(np.int64)) for name, c in zip("abcd", filled, strict=True)}})


def met(parts: DataFrame, edges_of: Callable[[dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]], tuple[np.ndarray, np.ndarray]], extra_type: str) -> DataFrame:
    """Group the parts by bucket: ``kind`` 0 rows are the info columns, ``kind`` 1 rows the star edges (a, b).

    ``edges_of`` gets (keys, nodes, extra) by kind and returns two node arrays.
    """

    def run(group: pa.Table) -> pa.Table:
        if group["bucket"][0].as_py() < 0:
            width = [np.frombuffer(x.as_py(), np.int64) for x in group["extra"]]
            return pa.concat_tables([found_table(0, *w.reshape(4, -1)) for w in width])
        by_kind = {}
        for kind in set(group["kind"].to_pylist()):
            rows = group.filter(pa.array(np.asarray(group["kind"]) == kind))
            by_kind[kind] = tuple(
                np.concatenate([np.frombuffer(x.as_py(), t) for x in rows[c]]) for c, t in (("keys", "<u4"), ("nodes", "<i8"), ("extra", extra_type))
            )
        a, b = edges_of(by_kind)
        pairs = np.unique(np.stack([np.maximum(a, b), np.minimum(a, b)], axis=1)[a != b], axis=0) if len(a) else np.zeros((0, 2), np.int64)
        return found_table(1, pairs[:, 0], pairs[:, 1])

    return parts.groupBy("bucket").applyInArrow(run, FOUND_SCHEMA)


def components(edges: DataFrame) -> DataFrame:
    """``node, root``: the smallest node reachable from each node of ``edges(a, b)``.

    Alternating large and small stars until nothing changes: each round points
    every node's larger, then smaller, neighbours at its smallest one.  Rounds
    grow with the logarithm of the graph, and each is a grouped minimum and a
    join, so a hub with many edges is no group in memory.
    """
    ensure_checkpoint_dir(edges.sparkSession)
    state = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct().checkpoint()
    before = None
    while True:
        both = state.unionByName(state.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct(F.col("a"), F.col("m").alias("b")))).alias("e"))
        state = small.select("e.*").where("a <> b").distinct().checkpoint()
        now = state.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return state.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        state.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def cells(nodes: DataFrame, block_rows: int = BLOCK_ROWS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``node, root, cell, side`` of ``nodes(node, root, size_class, bytes)``.

    Two nodes of one component whose size classes differ by at most one meet in
    exactly one cell; in a cell with both sides only pairs across count.
    """
    ensure_checkpoint_dir(nodes.sparkSession)
    sizes = nodes.groupBy("root").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes")).where("n > 1")
    is_small = (F.col("n") <= block_rows) & (F.col("bytes") <= block_bytes)
    sizes = sizes.select("root", "n", "bytes", is_small.alias("small")).checkpoint()
    total = sizes.where("small").agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n")).first()
    packs = max((total["bytes"] or 0) // block_bytes, (total["n"] or 0) // block_rows) + 1
    placed = nodes.join(sizes.select("root", "small"), "root")
    packed = placed.where("small").select(
        "node", "root", F.concat(F.lit("p"), F.pmod(F.xxhash64("root"), F.lit(packs)).cast("string")).alias("cell"), F.lit(0).alias("side")
    )
    large = placed.where("not small").drop("small")
    blocks = large.groupBy("root", "size_class").agg(
        F.greatest(F.ceil(F.count("*") / block_rows), F.ceil(F.sum("bytes") / block_bytes)).cast("int").alias("blocks")
    )
    beside = lambda step, name: blocks.select("root", (F.col("size_class") - step).alias("size_class"), F.col("blocks").alias(name))
    around = blocks.join(beside(1, "above"), ["root", "size_class"], "left").join(beside(-1, "below"), ["root", "size_class"], "left")
    dealt = large.join(around, ["root", "size_class"]).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))

    def name(cls, kind: str, low, high):
        return F.concat_ws("/", F.lit("c"), F.col("root"), cls, F.lit(kind), low, high)

    def upto(column: str):
        return F.when(F.col(column) > 0, F.sequence(F.lit(0), F.col(column) - 1)).otherwise(F.array().cast("array<int>"))

    block = F.col("block")
    own = F.transform(upto("blocks"), lambda j: F.struct(
        name(F.col("size_class"), "w", F.least(block, j), F.greatest(block, j)).alias("cell"), (block > j).cast("int").alias("side")))
    up = F.transform(F.coalesce(upto("above"), F.array().cast("array<int>")), lambda j: F.struct(
        name(F.col("size_class"), "x", block, j).alias("cell"), F.lit(0).alias("side")))
    down = F.transform(F.coalesce(upto("below"), F.array().cast("array<int>")), lambda j: F.struct(
        name(F.col("size_class") - 1, "x", j, block).alias("cell"), F.lit(1).alias("side")))
    spread = dealt.select("node", "root", F.explode(F.concat(own, up, down)).alias("at")).select("node", "root", "at.cell", "at.side")
    return packed.unionByName(spread)


class Union:
    """Union-find over a cell's rows."""

    def __init__(self, n: int) -> None:
        self.up = list(range(n))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        if x == y:
            return False
        self.up[max(x, y)] = min(x, y)
        return True


def verified(members: DataFrame, links_of: Callable[[list[bytes], int, Union], Iterator[tuple[int, int]]]) -> DataFrame:
    """Links ``a, b`` that connect the similar nodes of ``members(node, root, cell, side, content)``.

    ``links_of(contents, split, seen)`` yields index pairs of similar nodes: of all
    pairs if ``split`` is 0, else of those across the split.  It may leave out
    pairs that ``seen`` has connected.  Links that connect nothing new are
    dropped, so a cell returns fewer links than it has nodes.  A node that
    comes twice (from repeated rows) counts once.
    """

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by([("root", "ascending"), ("side", "ascending"), ("node", "ascending")])
        root, side, node = (np.asarray(group[c]) for c in ("root", "side", "node"))
        fresh = np.ones(len(node), bool)
        fresh[1:] = (node[1:] != node[:-1]) | (side[1:] != side[:-1])
        if not fresh.all():
            group, root, side, node = group.filter(pa.array(fresh)), root[fresh], side[fresh], node[fresh]
        content = group["content"].to_pylist()
        edges = np.flatnonzero(np.concatenate([[True], root[1:] != root[:-1]]))
        a, b = [], []
        for lo, hi in zip(edges, [*edges[1:], len(root)], strict=True):
            split = int(np.searchsorted(side[lo:hi], 1))
            if split == 0 or hi - lo == 1:
                continue  # nothing on the other side
            seen = Union(hi - lo)
            for i, j in links_of(content[lo:hi], split % (hi - lo), seen):
                if seen.join(i, j):
                    a.append(node[lo + i])
                    b.append(node[lo + j])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return members.groupBy("cell").applyInArrow(run, "a long, b long")
