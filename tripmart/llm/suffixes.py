"""Removal of passages that repeat across documents, by a logarithmic family of suffix arrays.

Every byte covered by a string of ``LENGTH`` bytes that also starts in a document
with a smaller id is removed, judged on the input.

Sampling.  A suffix array of every position would be many times the corpus.
Instead a sparse one is kept: of the ``LENGTH`` - ``SEED`` + 1 seeds (strings of
``SEED`` bytes) inside each window of ``LENGTH`` bytes the one with the smallest
hash is its anchor, the leftmost of equals.  Which one that is depends on the
window's bytes alone, so two equal windows have equal anchors, and consecutive
windows mostly share one.  The windows of one anchor form a stretch, the unit
of the index: an entry is (hash of the seed, hash of the whole stretch,
document).  If the stretch occurs in a smaller document, so do all its windows.

Index.  Documents are dealt into batches.  The entries of a batch, sorted by
seed and stretch, are its suffix array, a run.  The space of seeds is cut into
buckets, and each bucket holds a family of levels: the runs of several batches,
``GATHERED`` entries or more, enter as the lowest level, and while the two
lowest are of about equal size they are merged, so there are logarithmically
many levels and an entry is merged logarithmically often, however many batches
there are.  Once the last run is in, the levels are merged into one, and all
runs are scanned against it together: a stretch with a smaller document is a
match.  Parts of different stretches of one seed may still agree.  A window
reaches some bytes beyond its seed on the left or else on the right: those
whose seed starts at half of the room or later hold the half on its left, the
others that on its right.  So a half of a stretch is contested if a different
stretch has the same seed and the same bytes on that side; an entry has 16 bits
of the hash of either.  Without them the seeds that stretches share by chance,
and with them the windows, would be more with every document.

Windows.  For contested halves of stretches without a match, one of each kind,
the windows are indexed themselves in the same way, which settles them exactly.

Batches and buckets hold bounded amounts of text and entries; a stretch that
occurs in any number of documents is one entry per batch.

Defined results: a null text is an empty one; rows with a null id lose nothing
and take nothing from others; rows that repeat an id don't match each other,
as neither id is smaller; texts shorter than ``LENGTH`` lose nothing; an empty
table gives an empty result; further columns are not read.  Strings are
compared by 96 bits of hashes and more.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.textarrays import CHUNK_BYTES, Hasher, chunks, flat, mix

LENGTH = 50
SEED = 20
BATCH_BYTES = 4 << 20
BUCKET_BYTES = 16 << 20
LEAST_BUCKETS = 48
LEAST_BATCHES = 16
#: Entries that enter or are scanned against the levels together, at least.
GATHERED = 1 << 16

_NO_ID = (1 << 63) - 1
_LOW = np.uint64(0xFFFFFFFF)

_RUN = "batch long, bucket int, docs binary, seeds binary, rest binary, sides binary, owner binary, counts binary"
_FLAGS = "batch long, bucket int, kind int, matched binary, left binary, right binary"


@dataclass
class Stretches:
    """The stretches of a batch: first window, number of windows, of those the ones of the left half, document, key halves, sides."""

    start: np.ndarray
    windows: np.ndarray
    lefts: np.ndarray
    doc: np.ndarray
    key: np.ndarray  # 32 bits of the seed's hash, 32 of the stretch's
    rest: np.ndarray  # 32 further bits of the stretch's
    sides: np.ndarray  # 16 bits of the hash of the seed with what is left of it, 16 with what is right; 0 where no window has that half


def stretches(data: np.ndarray, offsets: np.ndarray, length: int, seed: int) -> Stretches:
    """All stretches of the texts in ``data``, in order of position."""
    n_windows = len(data) - length + 1
    if n_windows <= 0:
        none = np.zeros(0, np.int64)
        return Stretches(none, none, none, none, none.astype(np.uint64), none.astype(np.uint32), none.astype(np.uint32))
    hasher = Hasher(data)
    seeds = mix(hasher.windows(seed))
    # hash above, place below: the smallest is the leftmost of the smallest
    least = (seeds & ~_LOW) | np.arange(len(seeds), dtype=np.uint64)
    width, wanted = 1, length - seed + 1
    while width < wanted:
        step = min(width, wanted - width)
        least = np.minimum(least[:-step], least[step:])
        width += step
    sizes = np.diff(offsets)
    ends = np.repeat(offsets[1:], sizes)[:n_windows]
    window = np.flatnonzero(np.arange(n_windows) + length <= ends)
    anchor = (least[window] & _LOW).astype(np.int64)
    fresh = np.ones(len(window), bool)
    fresh[1:] = (anchor[1:] != anchor[:-1]) | (window[1:] != window[:-1] + 1)
    at = np.flatnonzero(fresh)
    start, count, anchor = window[at], np.diff(np.append(at, len(window))), anchor[at]
    whole = hasher.spans(start, start + count + length - 1)
    whole = mix(whole + (anchor - start).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    key = (seeds[anchor] << np.uint64(32)) | (whole & _LOW)
    half = (length - seed + 1) // 2
    lefts = np.clip(anchor - half - start + 1, 0, count)
    sides = np.zeros(len(start), np.uint32)
    for has, low, high, shift in ((lefts > 0, -half, seed, 16), (lefts < count, 0, length - half + 1, 0)):
        at = anchor[has]
        sides[has] |= (hasher.spans(at + low, at + high) % np.uint64(0xFFFF) + np.uint64(1)).astype(np.uint32) << np.uint32(shift)
    return Stretches(start, count, lefts, np.searchsorted(offsets, start, "right") - 1, key, (whole >> np.uint64(32)).astype(np.uint32), sides)


def _sorted(key: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, group starts) by key and rest; equal entries keep their order."""
    order = np.argsort(key, kind="stable")
    k, r = key[order], rest[order]
    same = k[1:] == k[:-1]
    if (same & (r[1:] != r[:-1])).any():
        order = np.lexsort((rest, key))
        k, r = key[order], rest[order]
        same = (k[1:] == k[:-1]) & (r[1:] == r[:-1])
    return order, np.flatnonzero(np.concatenate([[True], ~same])) if len(k) else np.zeros(0, np.int64)


class Levels:
    """Sorted levels of (key, rest, smallest document), merged when about equally large."""

    def __init__(self) -> None:
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def add(self, key: np.ndarray, rest: np.ndarray, doc: np.ndarray) -> None:
        self.levels.append((key, rest, doc))
        while len(self.levels) > 1 and len(self.levels[-2][0]) <= 2 * len(self.levels[-1][0]):
            self._merge()

    def _merge(self) -> None:
        upper, lower = self.levels.pop(), self.levels.pop()
        key, rest, doc = (np.concatenate(x) for x in zip(lower, upper, strict=True))
        order, first = _sorted(key, rest)  # two sorted halves: one merge pass
        self.levels.append((key[order][first], rest[order][first], np.minimum.reduceat(doc[order], first)) if len(first) else (key, rest, doc))

    def compact(self) -> None:
        while len(self.levels) > 1:
            self._merge()

    def scan(self, key: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each entry the smallest document it is known from, and its place in the last level that has it, or -1."""
        least, places = np.full(len(key), _NO_ID), np.full(len(key), -1)
        for known, known_rest, doc in self.levels:
            at = np.searchsorted(known, key)
            open_ = np.flatnonzero(at < len(known))
            while len(open_):  # more than one step only where keys agree and the rest does not
                place = at[open_]
                same = known[place] == key[open_]
                hit = same & (known_rest[place] == rest[open_])
                least[open_[hit]] = np.minimum(least[open_[hit]], doc[place[hit]])
                places[open_[hit]] = place[hit]
                open_ = open_[same & ~hit]
                at[open_] += 1
                open_ = open_[at[open_] < len(known)]
        return least, places


class Batch:
    """One batch's texts with their stretches, grouped by equal stretch."""

    def __init__(self, table: pa.Table, length: int, seed: int, buckets: int) -> None:
        table = table.sort_by("doc_id")  # nulls last
        self.length = length
        self.ids = table["doc_id"]
        self.data, self.offsets = flat(table["text"])
        values = np.asarray(self.ids.fill_null(_NO_ID).combine_chunks(), np.int64) if table.num_rows else np.zeros(0, np.int64)
        self.values = np.unique(values)
        rank = np.searchsorted(self.values, values)
        found = []
        for lo, hi in chunks(self.offsets):
            begin = self.offsets[lo]
            part = stretches(self.data[begin:self.offsets[hi]], self.offsets[lo:hi + 1] - begin, length, seed)
            part.start, part.doc = part.start + begin, rank[part.doc + lo]
            usable = self.values[part.doc] < _NO_ID if len(part.doc) else np.zeros(0, bool)
            found.append([x[usable] for x in (part.start, part.windows, part.lefts, part.doc, part.key, part.rest, part.sides)])
        if not found:
            found = [[np.zeros(0, t) for t in (*[np.int64] * 4, np.uint64, np.uint32, np.uint32)]]
        self.start, self.windows, self.lefts, self.doc, self.key, self.rest, self.sides = (np.concatenate(x) for x in zip(*found, strict=True))
        self.order, self.first = _sorted(self.key, self.rest)
        self.group = np.repeat(np.arange(len(self.first)), np.diff(np.append(self.first, len(self.order))))
        self.head = self.order[self.first]  # documents ascend, so the first of a group has its smallest
        self.bucket = ((self.key[self.head] >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)

    def runs(self, number: int) -> Iterator[dict]:
        """The batch's suffix array, cut at the bucket borders (buckets ascend with keys)."""
        for bucket, lo, hi in _cuts(self.bucket):
            head = self.head[lo:hi]
            yield _run(number, bucket, self.values, self.key[head], self.rest[head], self.sides[head], self.doc[head], None)

    def flags(self, rows: list[dict]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of every group, from the rows of all buckets, whether it is matched and contested left and right."""
        by_bucket = {r["bucket"]: r for r in rows if r["kind"] == 1}
        out = tuple(np.zeros(len(self.head), bool) for _ in range(3))
        for bucket, lo, hi in _cuts(self.bucket):
            for name, flag in zip(("matched", "left", "right"), out, strict=True):
                flag[lo:hi] = _bits(by_bucket[bucket][name], hi - lo)
        return out

    def contested(self, matched: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(groups, first window, number of windows) of the groups whose windows, some or all, are to be indexed themselves."""
        lefts, windows = self.lefts[self.head], self.windows[self.head]
        low, high = np.where(left, 0, lefts), np.where(right, windows, lefts)
        groups = np.flatnonzero(~matched & (high > low))
        return groups, low[groups], (high - low)[groups]

    def window_runs(self, number: int, groups: np.ndarray, low: np.ndarray, counts: np.ndarray) -> Iterator[dict]:
        heads = self.head[groups]
        hashes = window_hashes(self.data, self.length, self.start[heads] + low, counts)
        at = np.concatenate([[0], np.cumsum(counts)])
        for bucket, lo, hi in _cuts(self.bucket[groups]):
            head, mine = heads[lo:hi], hashes[at[lo]:at[hi]]
            below, above = (mine & _LOW).astype("<u4"), ((mine >> np.uint64(32)) & np.uint64(0xFFFF)).astype("<u2")
            seeds = (self.key[head] >> np.uint64(32)).astype(np.uint32)
            yield _run(number, bucket, self.values, seeds, below.tobytes() + above.tobytes(), None, self.doc[head], counts[lo:hi])

    def marks(self, matched: np.ndarray, groups: np.ndarray, low: np.ndarray, counts: np.ndarray, rows: list[dict]) -> np.ndarray:
        """Which bytes go, from the groups' flags and the flags of contested windows."""
        change = np.zeros(len(self.data) + 1, np.int32)
        head_doc = self.doc[self.head][self.group]
        doc, start, windows = self.doc[self.order], self.start[self.order], self.windows[self.order]
        gone = matched[self.group] | (doc > head_doc)
        np.add.at(change, start[gone], 1)
        np.add.at(change, start[gone] + windows[gone] + self.length - 1, -1)
        by_bucket = {r["bucket"]: r for r in rows if r["kind"] == 2}
        hit = np.zeros(int(counts.sum()), bool)
        ends = np.cumsum(counts)
        for bucket, lo, hi in _cuts(self.bucket[groups]):
            begin, end = ends[lo] - counts[lo], ends[hi - 1]
            hit[begin:end] = _bits(by_bucket[bucket]["matched"], int(end - begin))
        # every stretch of this kind in the same document holds the same windows
        chosen = np.zeros(len(self.head), bool)
        chosen[groups] = True
        alike = np.flatnonzero(chosen[self.group] & (doc == head_doc))
        times = np.bincount(self.group[alike], minlength=len(self.head))[groups]
        at = np.flatnonzero(hit)
        of = np.searchsorted(ends, at, "right")
        inside = at - (ends - counts)[of] + low[of]
        each = times[of]
        place = np.repeat((np.cumsum(times) - times)[of], each) + np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
        found = start[alike][place] + np.repeat(inside, each)
        np.add.at(change, found, 1)
        np.add.at(change, found + self.length, -1)
        return np.cumsum(change[:-1]) > 0


def window_hashes(data: np.ndarray, length: int, start: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The hash of each of ``counts`` windows from each start on, in that order; a chunk of text at a time."""
    total = int(counts.sum())
    begin = np.repeat(start, counts) + np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts)
    order = np.argsort(begin, kind="stable")
    placed = begin[order]
    out = np.zeros(total, np.uint64)
    at = 0
    while at < total:
        base = int(placed[at])
        end = int(np.searchsorted(placed, base + CHUNK_BYTES))
        piece = Hasher(data[base:int(placed[end - 1]) + length])
        out[order[at:end]] = piece.spans(placed[at:end] - base, placed[at:end] - base + length)
        at = end
    return out


def _cuts(bucket: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(bucket, first, end) of each run of equal buckets."""
    edges = np.flatnonzero(np.diff(bucket, prepend=-1))
    for lo, hi in zip(edges, [*edges[1:], len(bucket)][:len(edges)], strict=True):
        yield int(bucket[lo]), int(lo), int(hi)


def _run(batch: int, bucket: int, values: np.ndarray, seeds: np.ndarray, rest: np.ndarray | bytes, sides: np.ndarray | None, owner: np.ndarray, counts: np.ndarray | None) -> dict:
    held = np.zeros(len(values), bool)
    held[owner] = True
    docs, owner = values[held], (np.cumsum(held) - 1)[owner]
    return {
        "batch": batch, "bucket": bucket, "docs": _packed(docs), "seeds": seeds.tobytes(), "rest": rest if isinstance(rest, bytes) else rest.tobytes(),
        "sides": b"" if sides is None else sides.tobytes(), "owner": owner.astype(np.min_scalar_type(len(docs) - 1)).tobytes(),
        "counts": b"" if counts is None else counts.astype("<u2").tobytes(),
    }


def _packed(ascending: np.ndarray) -> bytes:
    """Distinct ascending numbers, at least one: the first, then the steps in as few bytes each as the largest needs."""
    steps = np.diff(ascending).view(np.uint64)
    kind = np.min_scalar_type(steps.max() if len(steps) else 0)
    return np.int64(ascending[0]).tobytes() + bytes([kind.itemsize]) + steps.astype(kind).tobytes()


def _unpacked(packed: bytes) -> np.ndarray:
    steps = np.frombuffer(packed, f"<u{packed[8]}", offset=9)
    return np.concatenate([np.frombuffer(packed, np.int64, 1), steps.astype(np.int64)]).cumsum()


def _bits(packed: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(packed, np.uint8), count=n).astype(bool)


def _owners(row: dict, n: int) -> np.ndarray:
    return _unpacked(row["docs"])[np.frombuffer(row["owner"], f"<u{len(row['owner']) // n}")]


def _table(rows: list[dict], ddl: str) -> pa.Table:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    schema = pa.schema([(name, kinds[kind]) for name, kind in (x.split() for x in ddl.split(", "))])
    return pa.Table.from_pylist(rows, schema)


def _gathered(sizes: list[int]) -> Iterator[tuple[int, int, int, int]]:
    """(first run, end run, first entry, end entry) of consecutive runs that have ``GATHERED`` entries or are the last."""
    lo = begin = end = 0
    for k, size in enumerate(sizes):
        end += size
        if end - begin >= GATHERED or k == len(sizes) - 1:
            yield lo, k + 1, begin, end
            lo, begin = k + 1, end


def _levels(sizes: list[int], key: np.ndarray, rest: np.ndarray, doc: np.ndarray) -> Levels:
    """All entries in one level."""
    levels = Levels()
    for _, _, lo, hi in _gathered(sizes):
        order, first = _sorted(key[lo:hi], rest[lo:hi])
        if len(first):
            levels.add(key[lo:hi][order][first], rest[lo:hi][order][first], np.minimum.reduceat(doc[lo:hi][order], first))
    levels.compact()
    return levels


def _several(values: np.ndarray) -> np.ndarray:
    """Which values stand more than once."""
    order = np.argsort(values, kind="stable")
    ordered = values[order]
    same = np.concatenate([[False], ordered[1:] == ordered[:-1], [False]])
    out = np.zeros(len(values), bool)
    out[order] = same[1:] | same[:-1]
    return out


def _scan_stretches(group: pa.Table) -> pa.Table:
    """All runs of a bucket: they enter the levels, then all are scanned against them."""
    rows, out = group.to_pylist(), []
    keys = [np.frombuffer(row["seeds"], "<u8") for row in rows]
    sizes = [len(k) for k in keys]
    key = np.concatenate(keys)
    rest, sides = (np.concatenate([np.frombuffer(row[c], "<u4") for row in rows]) for c in ("rest", "sides"))
    doc = np.concatenate([_owners(row, n) for row, n in zip(rows, sizes, strict=True)])
    levels = _levels(sizes, key, rest, doc)
    least, place = levels.scan(key, rest)
    side = np.zeros(len(levels.levels[0][0]) if levels.levels else 0, np.uint32)
    side[place] = sides
    seed = (levels.levels[0][0] >> np.uint64(32)) << np.uint64(16) if levels.levels else np.zeros(0, np.uint64)
    matched = least < doc
    left, right = ((_several(seed | half.astype(np.uint64)) & (half > 0))[place] for half in (side >> np.uint32(16), side & np.uint32(0xFFFF)))
    end = np.cumsum(sizes)
    for row, lo, hi in zip(rows, end - sizes, end, strict=True):
        out.append({
            "batch": row["batch"], "bucket": row["bucket"], "kind": 1,
            **{name: np.packbits(flag[lo:hi]).tobytes() for name, flag in (("matched", matched), ("left", left), ("right", right))},
        })
    return _table(out, _FLAGS)


def _scan_windows(group: pa.Table) -> pa.Table:
    """The same for the windows of contested stretches; a window's key is its seed and its hash."""
    rows, out, entries = group.to_pylist(), [], []
    for row in rows:
        counts = np.frombuffer(row["counts"], "<u2").astype(np.int64)
        total = int(counts.sum())
        seeds = np.repeat(np.frombuffer(row["seeds"], "<u4").astype(np.uint64), counts)
        entries.append((
            (seeds << np.uint64(32)) | np.frombuffer(row["rest"], "<u4", total), np.frombuffer(row["rest"], "<u2", total, 4 * total),
            np.repeat(_owners(row, len(counts)), counts),
        ))
    sizes = [len(key) for key, _, _ in entries]
    key, rest, doc = (np.concatenate(x) for x in zip(*entries, strict=True))
    entries.clear()
    levels = _levels(sizes, key, rest, doc)
    for first, last, begin, end in _gathered(sizes):
        matched = levels.scan(key[begin:end], rest[begin:end])[0] < doc[begin:end]
        stop = np.cumsum(sizes[first:last])
        for row, lo, hi in zip(rows[first:last], stop - sizes[first:last], stop, strict=True):
            out.append({"batch": row["batch"], "bucket": row["bucket"], "kind": 2, "matched": np.packbits(matched[lo:hi]).tobytes(), "left": b"", "right": b""})
    return _table(out, _FLAGS)


def remove_repeats(docs: DataFrame, length: int = LENGTH, seed: int = SEED, batch_bytes: int = BATCH_BYTES, with_text: bool = False) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every row; ``with_text`` adds ``kept`` (binary) and ``spans``."""
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    batches = max(LEAST_BATCHES, -(-size // batch_bytes))
    buckets = max(LEAST_BUCKETS, -(-size // BUCKET_BYTES))
    # one exchange of the texts, which all three passes over them read
    dealt = docs.withColumn("batch", F.pmod(F.xxhash64("doc_id"), F.lit(batches)))

    def index(texts: pa.Table) -> pa.Table:
        return _table(list(Batch(texts, length, seed, buckets).runs(texts["batch"][0].as_py())), _RUN)

    def settle(texts: pa.Table, flags: pa.Table) -> pa.Table:
        if not texts.num_rows:
            return _table([], _RUN)
        batch = Batch(texts, length, seed, buckets)
        return _table(list(batch.window_runs(texts["batch"][0].as_py(), *batch.contested(*batch.flags(flags.to_pylist())))), _RUN)

    report = [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())]
    ddl = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    if with_text:
        report += [("kept", pa.binary()), ("spans", pa.list_(pa.list_(pa.int64())))]
        ddl += ", kept binary, spans array<array<long>>"

    def remove(texts: pa.Table, flags: pa.Table) -> pa.Table:
        if not texts.num_rows:
            return pa.Table.from_pylist([], pa.schema(report))
        batch = Batch(texts, length, seed, buckets)
        rows = flags.to_pylist()
        matched, left, right = batch.flags(rows)
        gone = batch.marks(matched, *batch.contested(matched, left, right), rows)
        out = []
        for k, doc_id in enumerate(batch.ids.to_pylist()):
            lo, hi = batch.offsets[k], batch.offsets[k + 1]
            mine, text = gone[lo:hi], batch.data[lo:hi]
            step = np.diff(np.concatenate([[0], mine.astype(np.int8), [0]]))
            kept = text[~mine].tobytes()
            row = {
                "doc_id": doc_id, "n_bytes": int(hi - lo), "n_removed": int(mine.sum()), "n_spans": int((step > 0).sum()),
                "kept_sha256": hashlib.sha256(kept).hexdigest(),
            }
            if with_text:
                row |= {"kept": kept, "spans": np.stack([np.flatnonzero(step > 0), np.flatnonzero(step < 0)], axis=1).tolist()}
            out.append(row)
        return pa.Table.from_pylist(out, pa.schema(report))

    by_batch = dealt.groupBy("batch")
    seen = by_batch.applyInArrow(index, _RUN).groupBy("bucket").applyInArrow(_scan_stretches, _FLAGS)
    windows = by_batch.cogroup(seen.groupBy("batch")).applyInArrow(settle, _RUN)
    settled = windows.groupBy("bucket").applyInArrow(_scan_windows, _FLAGS)
    return by_batch.cogroup(seen.unionByName(settled).groupBy("batch")).applyInArrow(remove, ddl)
