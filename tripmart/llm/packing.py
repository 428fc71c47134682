"""Best-fit packing by minimum bin slack.

Texts become token ids, each ended by an id of its own; only what is longer
than a sequence is cut into pieces of its capacity.  The pieces go into as few
sequences as the method finds:

* Per sequence, the longest piece left is set and a subset-sum dynamic
  program over the lengths left (a bitset of reachable sums, shifted once per
  length and power of two of its count) finds the fullest feasible
  combination with it; longer pieces are preferred among equally full ones.
  The combination is removed and repeated as long as the lengths last: while
  they do, the next sequence's fullest combination is the same one.
* All the method needs of the pieces is how many there are of each length, at
  most ``capacity`` numbers whatever the corpus.  Spark counts them, the
  driver plans over them, and the plan (ranks of a length's pieces -> places)
  goes back as small arrays.
* A piece's rank among those of its length is its rank within the task that
  wrote it plus the counts of the tasks before, so no group of equal lengths,
  however many, meets in one task.

Tokens: white space never joins two pieces of the tokenizer's splitting rule,
so the ids of a text are those of its words one after another, and a task
encodes a repeated word once (``DICTIONARY_WORDS``).  Words are compared by
64-bit hashes.

Defined results: a null or empty text is its end id alone, a piece of length
1; repeated rows and null ids are packed each for themselves; ties of equal
lengths go by task and row, any choice packs alike; an empty table gives an
empty result; further columns are not read.
"""

from __future__ import annotations

import os
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tripmart.llm.tables import stored
from tripmart.llm.textarrays import NON_SPACE_BYTES, Hasher, chunks, runs, text_chunks

CAPACITY = 4096
#: The id that ends every document.
END_ID = 1
#: Bytes of text whose words are looked up together.
CHUNK_BYTES = 8 << 20
#: Words from which on a task's dictionary is emptied, some 50 bytes each.
DICTIONARY_WORDS = 2_000_000

Pattern = tuple[int, list[tuple[int, int]]]


# ---------------------------------------------------------------- minimum bin slack

def fullest(counts: dict[int, int], room: int) -> list[tuple[int, int]]:
    """(length, number) of a fullest combination of at most ``room``, longer pieces first."""
    reached, steps = 1, []
    all_sums = (1 << (room + 1)) - 1
    for length in sorted(counts, reverse=True):
        left, power = min(counts[length], room // length), 1
        while left > 0:
            take = min(power, left)
            steps.append((length, take, reached))
            reached |= (reached << (length * take)) & all_sums
            left, power = left - take, power * 2
        if reached >> room & 1:
            break
    total = reached.bit_length() - 1
    chosen: dict[int, int] = {}
    for length, take, before in reversed(steps):
        # reachable without this step: the shorter piece is left out
        if not before >> total & 1:
            chosen[length] = chosen.get(length, 0) + take
            total -= length * take
    return sorted(chosen.items(), reverse=True)


def minimum_bin_slack(counts: dict[int, int], capacity: int = CAPACITY) -> list[Pattern]:
    """How often which combination of lengths makes a sequence: (times, [(length, number)]), all pieces placed."""
    left = {length: n for length, n in counts.items() if n}
    patterns: list[Pattern] = []
    order = sorted(left)
    while order:
        longest = order[-1]
        left[longest] -= 1
        combination = dict(fullest({k: n for k, n in left.items() if n and k <= capacity - longest}, capacity - longest))
        left[longest] += 1
        combination[longest] = combination.get(longest, 0) + 1
        times = min(left[length] // n for length, n in combination.items())
        for length, n in combination.items():
            left[length] -= n * times
        patterns.append((times, sorted(combination.items(), reverse=True)))
        order = [length for length in order if left[length]]
    return patterns


class Plan:
    """Where the pieces of each length go, by their rank: sorted arrays, looked up by binary search."""

    def __init__(self, patterns: list[Pattern]) -> None:
        columns = []
        first_sequence = 0
        used: dict[int, int] = {}
        for times, combination in patterns:
            offset = 0
            for length, n in combination:
                columns.append((length, used.get(length, 0), first_sequence, n, offset))
                used[length] = used.get(length, 0) + n * times
                offset += length * n
            first_sequence += times
        self.sequences = first_sequence
        table = np.array(sorted(columns), np.int64).reshape(-1, 5)
        self.length, self.rank, self.sequence, self.number, self.offset = (np.ascontiguousarray(c) for c in table.T)
        # one sorted key per (length, first rank); ranks stay below 2**48
        self.key = (self.length << 48) + self.rank

    def places(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of the pieces of these lengths and ranks."""
        at = np.searchsorted(self.key, (length << 48) + rank, "right") - 1
        beyond = rank - self.rank[at]
        return self.sequence[at] + beyond // self.number[at], self.offset[at] + beyond % self.number[at] * length


# ---------------------------------------------------------------- tokens

class WordTokens:
    """Ids of texts by a tokenizer whose pieces never span white space, with a dictionary of words.

    The dictionary is a table sorted by the words' hashes; the words of a chunk
    of texts are looked up, and their ids gathered, by array operations.
    """

    def __init__(self, content: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs the tasks side by side
        self.tokenizer = Tokenizer.from_str(content)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.forget()

    def forget(self) -> None:
        """Empty the dictionary: what a task held does not stay in its worker."""
        self.known = np.zeros(0, np.uint64)
        self.first, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _tokenise(self, words: list[bytes]) -> dict[bytes, bytes]:
        """The ids of each of these."""
        mixed, ids = [], {}
        tokenize = self.tokenizer.model.tokenize
        for word in words:
            text = word.decode()
            if not text.isascii():
                text = text.lower()
            # lower-case Latin letters alone are one piece, and normalised as they are
            if text.isalpha() and (text.islower() if text.isascii() else max(text) < _NOT_LATIN):
                shown = text if text.isascii() else text.encode().decode("latin-1").translate(_SHOWN)
                ids[word] = array("I", [token.id for token in tokenize(shown)]).tobytes()
            else:
                mixed.append(word)
        for word, found in zip(mixed, self.tokenizer.encode_batch_fast([w.decode() for w in mixed], add_special_tokens=False), strict=True):
            ids[word] = array("I", found.ids).tobytes()
        return ids

    def _learn(self, hashes: np.ndarray, words: list[bytes]) -> None:
        """Put new words into the dictionary."""
        parts = []
        for word in words:
            # a piece of the splitting rule ends between a letter or digit and the signs at a word's end
            stem, signs = word.rstrip(_SIGNS), b""
            if len(stem) != len(word):
                if stem and stem[-1] in _ALNUM and b"<|" not in word:
                    signs = word[len(stem):]
                else:
                    stem = word
            if stem.isalpha():  # ASCII letters
                stem = stem.lower()
            parts.append((stem, signs))
        ids = self._tokenise(list({part for pair in parts for part in pair}))
        found = [ids[stem] + ids[signs] if signs else ids[stem] for stem, signs in parts]
        count = np.fromiter(map(len, found), np.int64, len(found)) // 4
        first = len(self.ids) + np.cumsum(count) - count
        self.ids = np.concatenate([self.ids, np.frombuffer(b"".join(found), np.uint32)])
        known = np.concatenate([self.known, hashes])
        order = np.argsort(known, kind="stable")
        self.known = known[order]
        self.first, self.count = np.concatenate([self.first, first])[order], np.concatenate([self.count, count])[order]

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts of a chunk, one after another, and each text's bounds in them.

        Words end at space and the control white space.
        """
        if len(self.known) > DICTIONARY_WORDS:
            self.forget()
        hashes, starts, ends, rows = [], [], [], []
        for lo, hi in chunks(offsets):
            begin = offsets[lo]
            part = data[begin:offsets[hi]]
            a, b, row = runs(part, offsets[lo:hi + 1] - begin, NON_SPACE_BYTES)
            hashes.append(Hasher(part).spans(a, b))
            for column, values in zip((starts, ends, rows), (a + begin, b + begin, row + lo), strict=True):
                column.append(values)
        starts, ends, rows = (np.concatenate(c) if c else np.zeros(0, np.int64) for c in (starts, ends, rows))
        distinct, example, word = np.unique(np.concatenate(hashes) if hashes else np.zeros(0, np.uint64), return_index=True, return_inverse=True)
        at = np.searchsorted(self.known, distinct)
        is_known = at < len(self.known)
        is_known[is_known] = self.known[at[is_known]] == distinct[is_known]
        new = example[~is_known]
        if len(new):
            raw = data.tobytes()
            self._learn(distinct[~is_known], [raw[a:b] for a, b in zip(starts[new].tolist(), ends[new].tolist())])
            at = np.searchsorted(self.known, distinct)
        first, count = self.first[at][word], self.count[at][word]
        before = np.concatenate([[0], np.cumsum(count)])
        ids = self.ids[np.repeat(first - before[:-1], count) + np.arange(before[-1])]
        return ids, before[np.searchsorted(rows, np.arange(len(offsets)))]


#: ASCII signs, none of them letter or digit, and the ASCII letters and digits.
_SIGNS = bytes(c for c in range(0x21, 0x7F) if not chr(c).isalnum())
_ALNUM = frozenset(c for c in range(0x21, 0x7F) if chr(c).isalnum())
#: The first character beyond the Latin blocks of precomposed letters.
_NOT_LATIN = "\u0250"
#: Characters that stand for the bytes without a printable Latin-1 character, as byte-level vocabularies number them.
_SHOWN = {b: 0x100 + k for k, b in enumerate([*range(0x21), *range(0x7F, 0xA1), 0xAD])}

_LOADED: dict[int, WordTokens] = {}


def _tokens(content: str) -> WordTokens:
    """One tokenizer per worker process and file."""
    key = zlib.crc32(content.encode())
    if key not in _LOADED:
        _LOADED[key] = WordTokens(content)
    return _LOADED[key]


def _content(path: str | None) -> str:
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    with open(path, encoding="utf-8") as file:
        return file.read()


_PIECES = {"doc_id": pa.int64(), "piece": pa.int32(), "start": pa.int64(), "length": pa.int64(), "ids_crc32": pa.int64(),
           "task": pa.int32(), "rank": pa.int64()}


def pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, keep_ids: bool = False) -> DataFrame:
    """Token pieces of every text, each with its rank among those of its length in its task; ``keep_ids`` adds the ids themselves."""
    content = _content(path)
    end = np.array([end_id], "<u4").tobytes()
    kinds = {**_PIECES, **({"ids": pa.binary()} if keep_ids else {})}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        tokenizer = _tokens(content)
        for batch in batches:
            rows = []
            numbers = batch.column(0).to_pylist()
            for lo, hi, data, at in text_chunks(batch.column(1), CHUNK_BYTES):
                found, bounds = tokenizer.encode(data, at)
                for number, a, b in zip(numbers[lo:hi], bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                    ids = found[a:b].astype("<u4").tobytes() + end
                    for k, start in enumerate(range(0, len(ids), 4 * capacity)):
                        part = ids[start:start + 4 * capacity]
                        n = len(part) // 4
                        rows.append((number, k, start // 4, n, zlib.crc32(part), task, int(seen[n]), part))
                        seen[n] += 1
            columns = list(zip(*rows, strict=True)) if rows else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds.values(), strict=False)], list(kinds))
        tokenizer.forget()

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, rank long"
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema + (", ids binary" if keep_ids else ""))


# ---------------------------------------------------------------- packing

def pack(parts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``parts`` (of ``pieces``, stored) with ``sequence_id`` and ``offset`` in place of ``task`` and ``rank``."""
    per_task = stored(parts.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n")), "piece_counts")
    # at most ``capacity`` rows
    counts = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = Plan(minimum_bin_slack(counts, capacity))
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = per_task.select("task", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    kept = [c for c in parts.columns if c not in ("task", "rank")]
    # no broadcast: the counts grow with the tasks
    ranked = parts.join(before.hint("merge"), ["task", "length"]).select(*kept, (F.col("before") + F.col("rank")).alias("rank"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            sequence, offset = plan.places(batch["length"].to_numpy(), batch["rank"].to_numpy())
            arrays = [batch[c] for c in kept] + [pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, [*kept, "sequence_id", "offset"])

    fields = ", ".join(f"{c} {dict(parts.dtypes)[c]}" for c in kept)
    return ranked.mapInArrow(place, f"{fields}, sequence_id long, offset long")


def packed_pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` of every piece of every document."""
    return pack(stored(pieces(docs, path, capacity), "pieces"), capacity)


def sequences(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """``sequence_id, ids`` (array of int): the packed sequences themselves, at most ``capacity`` ids each."""
    placed = pack(stored(pieces(docs, path, capacity, keep_ids=True), "pieces"), capacity)
    # a sequence holds at most ``capacity`` pieces
    parts = placed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = [np.frombuffer(b"".join(p["ids"] for p in part), "<u4").astype(np.int32) for part in batch["parts"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["sequence_id"], pa.array(whole, pa.list_(pa.int32()))], ["sequence_id", "ids"])

    return parts.mapInArrow(join, "sequence_id long, ids array<int>")
