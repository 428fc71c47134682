"""Benchmark decontamination with a distributed positional inverted index.

The training documents are cut into shards of a few megabytes.  Each shard is
indexed where it is read: per term, the ascending list of word positions at
which it stands.  One shard is one row of a stored table, so the index is
distributed by document, needs no shuffle, and is read again by any number of
searches.

A search looks up the terms of a phrase in every shard.  A phrase of which a
term is missing is out at once.  Otherwise the terms are taken from the rarest
in that shard on: the rarest list, shifted back by the term's place in the
phrase, gives the possible starts, and each further list, shifted likewise,
thins them out.  With ``slop`` 0 what remains are exact phrase matches.  A
proximity match needs a start in one document, from which every term stands at
most ``slop`` words from its place; the start may lie up to ``slop`` words
outside the document, and which term is looked up first makes no difference.

Terms are 64-bit hashes of the lower-cased words.

Defined results: a null or empty text has no words and no match; an item with
a null id or without words matches nothing; items that repeat an id count once;
repeated documents are searched each for itself; an empty benchmark leaves
every document clean; an empty document table gives an empty result.  Further
columns of either table are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.llm.tables import stored
from tripmart.llm.textarrays import LOWER, WORD_BYTES, text_chunks, word_hashes

WINDOW = 10
SHARD_BYTES = 2 << 20
#: Words of one broadcast block of benchmark text; a larger benchmark is searched in several blocks.
BLOCK_WORDS = 2_000_000

INDEX_SCHEMA = (
    "shard long, doc_ids array<long>, word_starts binary, terms binary, list_starts binary, postings binary"
)
MATCH_SCHEMA = "shard long, place int, doc_id long, n_words long, hits array<int>, items array<string>, near array<string>"


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of a small column and where each text starts in them."""
    hashes, rows = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for lo, _, data, offsets in text_chunks(texts):
        h, r = word_hashes(LOWER[data], offsets, WORD_BYTES)
        hashes.append(h)
        rows.append(r + lo)
    count = np.bincount(np.concatenate(rows), minlength=len(texts)) if len(texts) else np.zeros(0, int)
    return np.concatenate(hashes), np.concatenate([[0], np.cumsum(count)])


def build_index(docs: DataFrame, vocabulary: np.ndarray | None = None, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Store the positional index of ``docs(doc_id, text)``: one row per shard.

    ``vocabulary`` (sorted term hashes) limits the postings to those terms; the
    word count of every document is kept in any case.  Without it every term is
    indexed.
    """

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            ids = batch.column(0)
            for lo, hi, data, offsets in text_chunks(batch.column(1), shard_bytes):
                hashes, rows = word_hashes(LOWER[data], offsets, WORD_BYTES)
                starts = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=hi - lo))])
                if vocabulary is None:
                    terms, term_of = np.unique(hashes, return_inverse=True)
                    places = np.arange(len(hashes))
                else:
                    at = np.searchsorted(vocabulary, hashes)
                    at[at == len(vocabulary)] = 0
                    places = np.flatnonzero(vocabulary[at] == hashes) if len(vocabulary) else np.zeros(0, int)
                    terms, term_of = vocabulary, at[places]
                narrow = np.uint16 if len(terms) < 1 << 16 else np.int64  # 16-bit keys sort by radix
                order = np.argsort(term_of.astype(narrow), kind="stable")
                list_starts = np.concatenate([[0], np.cumsum(np.bincount(term_of, minlength=len(terms)))])
                full = np.flatnonzero(np.diff(list_starts))
                yield pa.RecordBatch.from_pydict({
                    "shard": pa.array([number], pa.int64()),
                    "doc_ids": pa.array([ids.slice(lo, hi - lo).to_pylist()], pa.list_(pa.int64())),
                    "word_starts": pa.array([starts.astype("<i8").tobytes()]),
                    "terms": pa.array([terms[full].astype("<u8").tobytes()]),
                    "list_starts": pa.array([np.append(list_starts[full], len(order)).astype("<i8").tobytes()]),
                    "postings": pa.array([places[order].astype("<i4").tobytes()]),
                })
                number += 1

    return stored(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(shards, INDEX_SCHEMA), "postings")


class _Phrases:
    """The distinct windows of a block of benchmark items."""

    def __init__(self, item_ids: list[str], hashes: np.ndarray, starts: np.ndarray, window: int) -> None:
        seen: dict[bytes, int] = {}
        phrases: list[np.ndarray] = []
        self.items: list[set[str]] = []
        for k, item in enumerate(item_ids):
            words = hashes[starts[k]:starts[k + 1]]
            for i in range(max(1, len(words) - window + 1) if len(words) else 0):
                phrase = words[i:i + window]
                n = seen.setdefault(phrase.tobytes(), len(phrases))
                if n == len(phrases):
                    phrases.append(phrase)
                    self.items.append(set())
                self.items[n].add(item)
        self.length = np.array([len(p) for p in phrases], np.int64)
        self.terms = np.unique(np.concatenate([*phrases, np.zeros(0, np.uint64)]))
        # a shorter phrase is filled up with its first word at its first place
        self.at = np.zeros((len(phrases), window), np.int64)
        self.offset = np.zeros((len(phrases), window), np.int64)
        for n, p in enumerate(phrases):
            self.at[n] = np.searchsorted(self.terms, np.append(p, np.repeat(p[:1], window - len(p))))
            self.offset[n, :len(p)] = np.arange(len(p))


def _starts(lists: list[np.ndarray], offsets: np.ndarray, slop: int) -> np.ndarray:
    """Start places from which each list has a posting at most ``slop`` from its offset; lists come rarest first."""
    found = lists[0].astype(np.int64) - offsets[0]
    if slop:
        found = np.unique(found[:, None] + np.arange(-slop, slop + 1))
    for postings, offset in zip(lists[1:], offsets[1:], strict=True):
        if not len(found):
            break
        at = np.searchsorted(postings, found + offset - slop)
        inside = at < len(postings)
        at[~inside] = 0
        found = found[inside & (postings[at] <= found + offset + slop)]
    return np.unique(found[found >= 0])


def search(index: DataFrame, phrases: _Phrases, slop: int = 0) -> DataFrame:
    """Matches of the phrases in each indexed document.

    Columns: ``hits`` the word places inside an exact match, ``items`` the items
    matched exactly, ``near`` those matched with every word at most ``slop``
    places from where the phrase has it (and all inside the document).
    """
    # documents set apart by this much have no proximity match across their border
    gap = phrases.at.shape[1] + 2 * slop + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):  # one shard at a time
                row = batch.slice(k, 1).to_pylist()[0]
                word_starts = np.frombuffer(row["word_starts"], "<i8")
                terms = np.frombuffer(row["terms"], "<u8")
                bounds = np.frombuffer(row["list_starts"], "<i8")
                postings = np.frombuffer(row["postings"], "<i4")
                n_docs = len(row["doc_ids"])
                if slop:
                    of_posting = np.searchsorted(word_starts, postings, "right")
                    apart = postings + of_posting * gap
                    apart_starts = word_starts[:-1] + np.arange(1, n_docs + 1) * gap - slop
                at = np.searchsorted(terms, phrases.terms)
                known = at < len(terms)
                known[known] = terms[at[known]] == phrases.terms[known]
                at[~known] = 0
                size = np.where(known, np.diff(bounds)[at] if len(terms) else 0, 0)
                sizes = size[phrases.at]
                marks = np.zeros(word_starts[-1] + 1, np.int64)
                items: dict[int, set[str]] = {}
                near: dict[int, set[str]] = {}
                for n in np.flatnonzero(sizes.min(axis=1, initial=1 << 60) > 0) if len(sizes) else ():
                    length = int(phrases.length[n])
                    rarest = np.argsort(sizes[n, :length], kind="stable")
                    bounded = [slice(bounds[k], bounds[k + 1]) for k in at[phrases.at[n, rarest]]]
                    if slop:
                        found = _starts([apart[b] for b in bounded], phrases.offset[n, rarest], slop)
                        if not len(found):
                            continue  # no proximity match, hence no exact one
                        for d in np.unique(np.searchsorted(apart_starts, found, "right") - 1):
                            near.setdefault(int(d), set()).update(phrases.items[n])
                    found = _starts([postings[b] for b in bounded], phrases.offset[n, rarest], 0)
                    doc = np.searchsorted(word_starts, found, "right") - 1
                    whole = found + length <= word_starts[np.minimum(doc + 1, n_docs)]
                    for d in np.unique(doc[whole]):
                        items.setdefault(int(d), set()).update(phrases.items[n])
                    np.add.at(marks, found[whole], 1)
                    np.add.at(marks, found[whole] + length, -1)
                near = near if slop else items
                hit = np.flatnonzero(np.cumsum(marks)[:-1] > 0)
                cut = np.searchsorted(hit, word_starts)
                yield pa.RecordBatch.from_pydict({
                    "shard": pa.array([row["shard"]] * n_docs, pa.int64()),
                    "place": pa.array(np.arange(n_docs), pa.int32()),
                    "doc_id": pa.array(row["doc_ids"], pa.int64()),
                    "n_words": pa.array(np.diff(word_starts), pa.int64()),
                    "hits": pa.array([hit[cut[d]:cut[d + 1]] - word_starts[d] for d in range(n_docs)], pa.list_(pa.int32())),
                    "items": pa.array([sorted(items.get(d, ())) for d in range(n_docs)], pa.list_(pa.string())),
                    "near": pa.array([sorted(near.get(d, ())) for d in range(n_docs)], pa.list_(pa.string())),
                })

    return index.mapInArrow(run, MATCH_SCHEMA)


def _blocks(benchmark: DataFrame, window: int, block_words: int) -> Iterator[_Phrases]:
    """The benchmark in blocks of a bounded number of words."""
    ids: list[str] = []
    texts: list[str] = []
    words = 0
    items = benchmark.where("item_id is not null and text is not null").select(F.col("item_id").cast("string"), "text")
    for item_id, text in items.toLocalIterator():
        ids.append(item_id)
        texts.append(text)
        words += len(text) // 2 + 1  # at most
        if words >= block_words:
            yield _Phrases(ids, *_words(pa.array(texts, pa.large_string())), window)
            ids, texts, words = [], [], 0
    if ids:
        yield _Phrases(ids, *_words(pa.array(texts, pa.large_string())), window)


def contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, slop: int = 2, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """One row per document: ``doc_id, n_words, hits, items, near`` (see ``search``).

    The benchmark is broadcast in blocks of ``block_words`` words, each searched
    against the whole index; with one block the postings of its terms suffice.
    """
    blocks = list(_blocks(benchmark, window, block_words)) or [_Phrases([], np.zeros(0, np.uint64), np.zeros(1, int), window)]
    index = build_index(docs, blocks[0].terms if len(blocks) == 1 else None)
    found = [search(index, block, slop) for block in blocks]
    if len(found) == 1:
        return found[0].select("doc_id", "n_words", "hits", "items", "near")
    union = found[0]
    for more in found[1:]:
        union = union.unionByName(more)
    merged = [F.array_distinct(F.flatten(F.collect_list(c))).alias(c) for c in ("hits", "items", "near")]
    return union.groupBy("shard", "place", "doc_id", "n_words").agg(*merged).drop("shard", "place")


def decontamination_report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` from the exact matches."""
    return contamination(docs, benchmark, window, slop=0).select(
        "doc_id", "n_words", F.size("hits").cast("long").alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


def proximity_report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, slop: int = 2) -> DataFrame:
    """The columns of ``decontamination_report`` from the exact matches, and ``n_near, near_sha256`` of the items matched by proximity."""
    def digest(items: str) -> Column:
        return F.sha2(F.array_join(F.array_sort(items), ",").cast("binary"), 256)

    return contamination(docs, benchmark, window, slop).select(
        "doc_id", "n_words", F.size("hits").cast("long").alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        digest("items").alias("items_sha256"), (F.size("hits") > 0).alias("contaminated"),
        F.size("near").cast("long").alias("n_near"), digest("near").alias("near_sha256"),
    )
