"""Line dedup by an edit-distance join on partitioned segments.

A line is trimmed of spaces, tabs and carriage returns; empty lines are never
dropped.  Equal lines are linked, and so are lines whose edit distance, in
characters, is at most the limit of the shorter one: ``edit_limit``, none below
20 characters, 1 up to 39, 2 up to 319, 3 up to 1279, and one more with every
fourfold length.
Linked lines form classes, and of a class the first line stays, in the order of
(doc_id, line number); the others are dropped from their texts.

Candidates come from segments.  A line with limit k is cut into k + 1 even
segments.  If another line is not shorter and within k edits, some segment
stands unchanged in it.  Each line is indexed by (its length, segment number,
segment) and probes the index for every shorter length whose limit allows the
difference, only with the substrings that a segment can have moved to: for
segment i, not further than i edits on its left and k - i on its right allow.

Distinct lines are the nodes of the join; candidates are connected, dealt into
bounded cells and compared there (see ``linking``) by banded bit-parallel edit
distance: one integer per number of edits holds, as bits, which of the
diagonals of the band are reachable, and each character updates all pairs of a
line at once.

Defined results: a null or empty text has no lines that can be dropped and
comes back as it is; rows that repeat an id and a text are treated alike; null
ids come last in the order; an empty table gives an empty result.  Lines are
told apart by 64-bit hashes.  Other columns of ``docs`` pass through
``drop_repeated_lines``, whatever their names, and are not read by
``line_report``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.llm import linking
from tripmart.llm.bitmaps import asked, bitmap, spread, spread_column
from tripmart.llm.linking import Union
from tripmart.llm.tables import free_name, stored
from tripmart.llm.textarrays import Hasher, mix, text_chunks

LEAST_BYTES = 1
#: Bytes of text whose keys a task holds before it sends them.
SENT_BYTES = 4 << 20
#: Characters from which on a line may be 1, 2, 3 ... edits away; on to lengths that no text has.
LIMIT_STARTS = np.array([20, 40, *(80 << 2 * k for k in range(1, 20))], np.int64)

_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 0x09, 0x0D]] = True
_LAST_ID = (1 << 63) - 1


def _key(docs: DataFrame) -> Column:
    """What tells rows apart: their id and text."""
    return F.xxhash64("doc_id", "text")


def split_lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, text index, number in its text) of each line, trimmed; an empty text has one empty line."""
    breaks = np.flatnonzero(data == 0x0A)
    owner = np.searchsorted(offsets, breaks, "right") - 1
    starts = np.concatenate([offsets[:-1], breaks + 1])
    ends = np.concatenate([breaks, offsets[1:]])
    rows = np.concatenate([np.arange(len(offsets) - 1), owner])
    rows_of_ends = np.concatenate([owner, np.arange(len(offsets) - 1)])
    starts = starts[np.lexsort((starts, rows))]
    ends = ends[np.lexsort((ends, rows_of_ends))]
    rows = np.sort(rows)
    number = np.arange(len(rows)) - np.searchsorted(rows, rows)
    # trimmed: from the first to the last byte that isn't blank, if there is one
    full = np.append(np.flatnonzero(~_BLANK[data]), len(data) + 1)
    first = full[np.searchsorted(full, starts)]
    empty = first >= ends
    last = full[np.maximum(np.searchsorted(full, ends) - 1, 0)] + 1
    starts, ends = np.where(empty, starts, first), np.where(empty, starts, last)
    return starts, ends, rows, number


def segments(length: np.ndarray, pieces: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, size) of each even segment of lines of the given lengths; the last ones take what is left over."""
    base, more = length // pieces, length % pieces
    number = np.arange(pieces)[:, None]
    size = base + (number >= pieces - more)
    return number * base + np.maximum(0, number - (pieces - more)), size


def edit_limit(chars: np.ndarray) -> np.ndarray:
    """Edits that a line of so many characters may be away from one that is not shorter."""
    return np.searchsorted(LIMIT_STARTS, chars, "right")


def segment_keys(hasher: Hasher, chars: np.ndarray, first: np.ndarray, length: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(1 to index or 2 to probe, keys, line index) of the lines that may have near ones.

    ``chars`` holds where each character begins, ``first`` and ``length`` which
    characters a line has.
    """
    most = edit_limit(length)
    for shorter in range(int(most.max(initial=0)) + 1):
        other = length - shorter
        limit = edit_limit(other)
        for edits in range(max(1, shorter), int(limit.max(initial=0)) + 1):
            lines = np.flatnonzero(limit == edits)
            at, size = segments(other[lines], edits + 1)
            for i in range(edits + 1):
                low = max(-i, shorter - (edits - i))
                high = min(i, shorter + (edits - i))
                name = mix((other[lines] * (edits + 1) + i).astype(np.uint64))
                for move in range(low, high + 1):
                    begin = at[i] + move
                    fits = (begin >= 0) & (begin + size[i] <= length[lines])
                    begin = first[lines[fits]] + begin[fits]
                    keys = mix(hasher.spans(chars[begin], chars[begin + size[i][fits]]) + name[fits])
                    yield 2, keys, lines[fits]
                    if shorter == 0 and move == 0:
                        yield 1, keys, lines[fits]


def _sent(number: int, info: list, keyed: dict[int, list], buckets: int) -> pa.RecordBatch:
    rows = [linking.info_part(number, *(np.concatenate(c) for c in zip(*info, strict=True)))]
    for kind, found in keyed.items():
        if found:
            keys, nodes = (np.concatenate(c) for c in zip(*found, strict=True))
            rows += linking.parts_of(keys, nodes, None, kind, buckets)
    return linking.part_batch(rows)


def _parts(docs: DataFrame, buckets: int, least_bytes: int) -> DataFrame:
    """Segment keys of all lines, and as info columns (row key, doc_id, line number, line hash)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            ids = np.asarray(batch.column(0).fill_null(_LAST_ID))
            row_keys = np.asarray(batch.column(2))
            info, keyed, held = [], {1: [], 2: []}, 0
            emitted = np.zeros(0, np.int64)
            for lo, hi, data, offsets in text_chunks(batch.column(1)):
                starts, ends, rows, line = split_lines(data, offsets)
                long = ends - starts >= least_bytes
                starts, ends, rows, line = starts[long], ends[long], rows[long] + lo, line[long]
                hasher = Hasher(data)
                node = hasher.spans(starts, ends).view(np.int64)
                info.append((row_keys[rows], ids[rows], line, node))
                fresh, first = np.unique(node, return_index=True)
                first = first[~np.isin(fresh, emitted)]
                emitted = np.union1d(emitted, fresh)  # one batch sends a line's keys once
                chars = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
                begin = np.searchsorted(chars, starts[first])
                length = np.searchsorted(chars, ends[first]) - begin
                for kind, keys, which in segment_keys(hasher, chars, begin, length):
                    keyed[kind].append((keys, node[first][which]))
                held += len(data)
                if held >= SENT_BYTES or hi == batch.num_rows:
                    yield _sent(number, info, keyed, buckets)
                    info, keyed, held, number = [], {1: [], 2: []}, 0, number + 1

    return docs.select(F.col("doc_id").cast("long"), "text", _key(docs).alias("row_key")).mapInArrow(run, linking.PART_SCHEMA)


def _segment_edges(by_kind: dict) -> tuple[np.ndarray, np.ndarray]:
    """Star edges from each indexed segment's first line to all that hold it."""
    if 1 not in by_kind or 2 not in by_kind:
        none = np.zeros(0, np.int64)
        return none, none
    keys, nodes, _ = by_kind[1]
    order = np.lexsort((nodes, keys))
    keys, nodes = keys[order], nodes[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    named, hub = keys[first], nodes[first]
    # a probe of its own length includes the indexed lines themselves
    probes, probing, _ = by_kind[2]
    at = np.searchsorted(named, probes)
    at[at == len(named)] = 0
    hit = named[at] == probes
    return probing[hit], hub[at[hit]]


def within_edits(one: np.ndarray, others: list[np.ndarray], edits: np.ndarray) -> np.ndarray:
    """Whether each of ``others`` is within its number of ``edits`` of ``one`` (arrays of characters), in a band of diagonals."""
    m, n = len(one), np.array([len(o) for o in others])
    out = np.abs(n - m) <= edits
    keep = np.flatnonzero(out)
    if not len(keep):
        return out
    # what all of them begin with alike costs nothing
    alike = min(m, int(n[keep].min()))
    for k in keep:
        differ = np.flatnonzero(one[:alike] != others[k][:alike])
        alike = int(differ[0]) if len(differ) else alike
    one, m, lengths, allowed = one[alike:], m - alike, n[keep] - alike, edits[keep]
    most, longest = int(allowed.max()), int(lengths.max())
    width = 2 * most + 1
    kind = np.uint32 if width <= 32 else np.uint64
    text = np.full((len(keep), longest), -1, np.int32)
    for row, k in enumerate(keep):
        text[row, :lengths[row]] = others[k][alike:]
    # bit b of a mask after t characters: t + b - most characters of ``one`` are matched
    padded = np.full(longest + 2 * width + m, -2, np.int32)
    padded[most:most + m] = one
    equal = np.zeros((longest, len(keep)), kind)
    for b in range(width):
        equal |= (text == padded[None, b:b + longest]).T.astype(kind) << kind(b)
    band = kind((1 << width) - 1)
    one_bit = kind(1)
    state = [np.full(len(keep), ((1 << most + k + 1) - (1 << most)) & int(band), kind) for k in range(most + 1)]
    fine = np.zeros(len(keep), bool)

    def capture(t: int) -> None:
        place = m - t + most
        reached = np.zeros(len(keep), bool)
        for k in range(most + 1):
            reached |= (state[k] >> kind(place) & one_bit == 1) & (allowed >= k) if 0 <= place < width else False
        done = lengths == t
        fine[done] = reached[done]

    ends = set(lengths.tolist())
    for t in range(longest):
        if t in ends:
            capture(t)
        match = equal[t]
        fresh = [state[0] & match]
        for k in range(1, most + 1):
            fresh.append(((state[k] & match) | state[k - 1] | (state[k - 1] >> one_bit) | (fresh[k - 1] << one_bit)) & band)
        state = fresh
        if not state[most].any():
            break
    else:
        capture(longest)
    out[keep] = fine
    return out


def near_lines(contents: list[bytes], split: int, seen: Union) -> Iterator[tuple[int, int]]:
    """Index pairs of lines that are within the limit of the shorter one."""
    lines = [np.frombuffer(c.decode().encode("utf-32-le"), "<i4") for c in contents]
    length = np.array([len(c) for c in lines])
    limit = edit_limit(length)
    counts = np.stack([np.bincount(c & 0xFF, minlength=256) for c in lines]).astype(np.int32)
    for i in range(split or len(lines)):
        later = np.arange(split or i + 1, len(lines))
        allowed = np.minimum(limit[later], limit[i])
        # an edit changes at most two character counts by one each
        able = (np.abs(length[later] - length[i]) <= allowed) & (np.abs(counts[later] - counts[i]).sum(axis=1) <= 2 * allowed)
        later = [j for j in later[able].tolist() if seen.find(i) != seen.find(j)]
        if later:
            allowed = np.minimum(limit[later], limit[i])
            for j, near in zip(later, within_edits(lines[i], [lines[j] for j in later], allowed).tolist(), strict=True):
                if near:
                    yield i, j


def _size_class(chars: Column) -> Column:
    """Classes of lengths: two lines within their limit are in the same or in neighbouring ones.

    Among lengths of one limit a class is as wide as the limit and one more;
    the last one takes what is left over, so no pair skips a class.
    """
    classes, before = F.lit(0), 1
    starts = LIMIT_STARTS.tolist()
    for k, (start, end) in enumerate(zip(starts, [*starts[1:], 4 * starts[-1]], strict=True), 1):
        n = (end - start) // (k + 1)
        classes = F.when(chars >= start, F.least(F.floor((chars - start) / (k + 1)), F.lit(n - 1)) + before).otherwise(classes)
        before += n
    return classes.cast("long")


def _line_contents(docs: DataFrame, marks: np.ndarray, least_bytes: int) -> DataFrame:
    """``node, row_key, line, content`` of the lines whose (node, row key, number) may be marked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row_keys = np.asarray(batch.column(1))
            for lo, _, data, offsets in text_chunks(batch.column(0)):
                starts, ends, rows, line = split_lines(data, offsets)
                long = ends - starts >= least_bytes
                starts, ends, rows, line = starts[long], ends[long], rows[long] + lo, line[long]
                node = Hasher(data).spans(starts, ends).view(np.int64)
                wanted = np.flatnonzero(asked(marks, spread(node, row_keys[rows], line)))
                yield pa.RecordBatch.from_arrays([
                    pa.array(node[wanted]), pa.array(row_keys[rows[wanted]]), pa.array(line[wanted]),
                    pa.array([data[starts[k]:ends[k]].tobytes() for k in wanted], pa.binary()),
                ], ["node", "row_key", "line", "content"])

    return docs.select("text", _key(docs).alias("row_key")).mapInArrow(run, "node long, row_key long, line long, content binary")


def repeated_lines(docs: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """``row_key, drop``: per row (by the hash of its id and text) the numbers of the lines to drop."""
    buckets = linking.bucket_count(docs)
    found = stored(linking.met(_parts(docs, buckets, least_bytes), _segment_edges, "<i1"), "line_candidates")
    info = found.where("kind = 0").select(F.col("a").alias("row_key"), F.col("b").alias("id"), F.col("c").alias("line"), F.col("d").alias("node"))

    near = linking.components(found.where("kind = 1").select("a", "b"))
    # each distinct line is compared through its first place
    place = info.join(near, "node").groupBy("node", "root").agg(F.min(F.struct("id", "row_key", "line")).alias("first"), F.count("*").alias("copies"))
    place = place.select("node", "root", "first.row_key", "first.line").checkpoint()
    marks = bitmap(place.select(spread_column(F.col("node"), F.col("row_key"), F.col("line")).alias("place")), "place")
    contents = _line_contents(docs, marks, least_bytes).join(place, ["node", "row_key", "line"]).dropDuplicates(["node"])
    contents = stored(contents.select("node", "root", "content"), "line_contents")
    chars = F.length(F.col("content").cast("string"))
    dealt = linking.cells(contents.select("node", "root", _size_class(chars).alias("size_class"), F.length("content").cast("long").alias("bytes")))
    links = linking.verified(dealt.join(contents.select("node", "content"), "node"), near_lines)

    of_node = linking.components(links).withColumnRenamed("root", "class")
    classed = info.join(of_node, "node", "left").select("row_key", "id", "line", F.coalesce("class", "node").alias("class"))
    # only classes with more than one line have anything to drop; rows alike in id and text count once
    many = classed.groupBy("class").agg(
        F.min(F.struct("id", "row_key", "line")).alias("first"), F.max(F.struct("id", "row_key", "line")).alias("last")
    ).where("first <> last")
    many = stored(many, "line_classes")  # a table of its own, so that the join can split a class that many lines share
    extra = classed.join(many, "class").where(F.struct("id", "row_key", "line") != F.col("first"))
    return extra.groupBy("row_key").agg(F.array_sort(F.collect_set("line")).alias("drop"))


def _without(text: str | None, drop: list[int] | None) -> tuple[str | None, int]:
    """A text without the lines of the given numbers, and how many lines it had."""
    if text is None:
        return None, 0
    lines = text.split("\n")
    gone = set(drop or ())
    return ("\n".join(x for k, x in enumerate(lines) if k not in gone) if gone else text), len(lines)


def drop_repeated_lines(docs: DataFrame, drop_emptied: bool = True, **limits: int) -> DataFrame:
    """``docs`` with repeated lines taken out of ``text`` (and ``n_chars``, if there, counted anew).

    With ``drop_emptied``, rows that lose all their text go.
    """
    columns = docs.columns
    key, drop = free_name(docs, "_row_key"), free_name(docs, "_drop")
    keyed = docs.withColumn(key, _key(docs)).join(repeated_lines(docs, **limits).withColumnsRenamed({"row_key": key, "drop": drop}), key, "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [_without(t.as_py(), d.as_py())[0] for t, d in zip(batch.column("text"), batch.column(drop), strict=True)]
            emptied = np.array([d.is_valid and not (t or "").strip() for t, d in zip(texts, batch.column(drop), strict=True)], bool)
            table = pa.Table.from_batches([batch]).select(columns)
            table = table.set_column(columns.index("text"), "text", pa.array(texts, pa.string()))
            if "n_chars" in columns:
                kind = table.schema.field("n_chars").type
                changed = [len(t) if d.is_valid else n.as_py() for t, d, n in zip(texts, batch.column(drop), batch.column("n_chars"), strict=True)]
                table = table.set_column(columns.index("n_chars"), "n_chars", pa.array(changed, kind))
            if drop_emptied:
                table = table.filter(pa.array(~emptied))
            yield from table.combine_chunks().to_batches()

    ddl = ", ".join(f"`{name}` {kind}" for name, kind in docs.dtypes)
    return keyed.select(*columns, drop).mapInArrow(run, ddl)


def line_report(docs: DataFrame, **limits: int) -> DataFrame:
    """``doc_id, n_lines, n_dropped, kept_sha256`` (of the text that stays; of an empty one for a null) of every row."""
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    keyed = docs.withColumn("row_key", _key(docs)).join(repeated_lines(docs, **limits), "row_key", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            drops = batch.column(2).to_pylist()
            kept = [_without(t.as_py(), d) for t, d in zip(batch.column(1), drops, strict=True)]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([n for _, n in kept], pa.int64()), pa.array([len(d or ()) for d in drops], pa.int64()),
                pa.array([hashlib.sha256((t or "").encode()).hexdigest() for t, _ in kept], pa.string()),
            ], ["doc_id", "n_lines", "n_dropped", "kept_sha256"])

    return keyed.select("doc_id", "text", "drop").mapInArrow(run, "doc_id long, n_lines long, n_dropped long, kept_sha256 string")
