"""Byte-level BPE encoding and decoding with content-defined chunk reuse.

A rolling hash over the last bytes cuts every text into chunks whose borders
depend on the content alone, so a passage that several documents share falls
into the same chunks in each.  A task encodes each distinct chunk once and
looks the repeats up.

A chunk is cut out of its text, so the tokens next to its borders may differ
from those of the whole text.  They are repaired: a place where a non-space
character is followed by a space or newline always ends a piece of the
tokenizer's splitting rule, whatever stands around it, so from there on both
sides agree with the whole text.  Of a chunk only the tokens between its first
and last such place are reused; at every join the text from the last agreed
place on the left to the first one on the right is encoded anew.  If a chunk
has no such place the repair runs on into the next chunk until one is found.

Special tokens in the text are kept as the library keeps them: cut out first,
each as its own id.

The chunk dictionary belongs to one task and is emptied at ``CACHE_BYTES``:
sharing it across tasks would shuffle every text, which costs more than
encoding a shared chunk once per task.

Defined results: a null or empty text has no tokens; repeated documents and
null ids are encoded each for itself; an empty table gives an empty result;
further columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.textarrays import BYTE_VALUES, text_chunks

#: Fixed value: the splitting rule of the byte-level pre-tokenizer.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
ROLLING_BYTES = 16
#: One place in so many is a chunk border.
MEAN_CHUNK = 512
CACHE_BYTES = 16 << 20

_AGREED = re.compile(r"(?<=\S)(?=[ \n])")


class ByteBpe:
    """The tokenizer of one vocabulary file, with its chunk dictionary."""

    def __init__(self, content: str) -> None:
        spec = json.loads(content)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        byte_of = _byte_alphabet()
        ranks = {bytes(byte_of[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in self.special}
        self.encoding = tiktoken.Encoding("byte_bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.split = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        size = max([*ranks.values(), *self.special.values()]) + 1
        self.pieces = [b""] * size
        for piece, i in ranks.items():
            self.pieces[i] = piece
        for text, i in self.special.items():
            self.pieces[i] = text.encode()
        self.known: dict[bytes, tuple[str, bytes, str] | None] = {}
        self.held = 0
        self.encoded_bytes = 0

    def forget(self) -> None:
        """Empty the chunk dictionary: what a task held does not stay in its worker."""
        self.known.clear()
        self.held = 0

    def plain(self, text: str) -> bytes:
        """Ids of ``text`` as little-endian 32-bit integers, without any reuse."""
        self.encoded_bytes += len(text)
        if self.split is None or not any(s in text for s in self.special):
            return np.asarray(self.encoding.encode_to_numpy(text, disallowed_special=()), "<u4").tobytes()
        out = []
        for part in self.split.split(text):
            if part in self.special:
                out.append(np.array([self.special[part]], "<u4").tobytes())
            elif part:
                out.append(np.asarray(self.encoding.encode_to_numpy(part, disallowed_special=()), "<u4").tobytes())
        return b"".join(out)

    def chunk(self, raw: bytes) -> tuple[str, bytes, str] | None:
        """Text before the first agreed place, the ids from there to the last one, text after it; None without two."""
        if raw in self.known:
            return self.known[raw]
        text = raw.decode()
        first = _AGREED.search(text)
        found = None
        if first:
            last = first.start()
            for border in (" ", "\n"):
                at = text.rfind(border)
                while at > last and text[at - 1].isspace():
                    at = text.rfind(border, 0, at)
                last = max(last, at)
            if last > first.start():
                found = (text[:first.start()], self.plain(text[first.start():last]), text[last:])
        if self.held > CACHE_BYTES:
            self.forget()
        self.known[raw] = found
        self.held += 3 * len(raw) + 200
        return found

    def encode(self, raw: bytes, cuts: list[int]) -> bytes:
        """Ids of the text ``raw``, whose chunks end at ``cuts``."""
        out: list[bytes] = []
        open_text: list[str] = []  # from the last agreed place on
        begin = 0
        for end in cuts:
            part = raw[begin:end]
            begin = end
            found = self.chunk(part)
            if found is None:
                open_text.append(part.decode())
                continue
            open_text.append(found[0])
            out.append(self.plain("".join(open_text)))
            out.append(found[1])
            open_text = [found[2]]
        out.append(self.plain("".join(open_text)))
        return b"".join(out)

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.pieces.__getitem__, ids.tolist())).decode("utf-8", "replace")


def _byte_alphabet() -> dict[str, int]:
    """Character that stands for each byte in a byte-level vocabulary file."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(0x100 + k): b for k, b in enumerate(hidden)}


_LOADED: dict[str, ByteBpe] = {}


def _tokenizer(content: str) -> ByteBpe:
    """One tokenizer per worker process and file."""
    key = hashlib.sha256(content.encode()).hexdigest()
    if key not in _LOADED:
        _LOADED[key] = ByteBpe(content)
    return _LOADED[key]


def chunk_ends(data: np.ndarray, offsets: np.ndarray, mean_chunk: int = MEAN_CHUNK) -> list[list[int]]:
    """Content-defined chunk ends of each text, relative to its start; the last is its length."""
    n = len(data)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(BYTE_VALUES[data], out=sums[1:])
    is_border = np.zeros(n + 1, bool)
    if n > ROLLING_BYTES:
        rolling = sums[ROLLING_BYTES:-1] - sums[:n - ROLLING_BYTES]
        # before a character, never inside one; the multiplication spreads the sum's bits
        hit = ((rolling * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)) % np.uint64(mean_chunk) == 0
        is_border[ROLLING_BYTES:n] = hit & ((data[ROLLING_BYTES:] & 0xC0) != 0x80)
    places = np.flatnonzero(is_border)
    bounds = np.searchsorted(places, offsets, "right")
    out = []
    for k in range(len(offsets) - 1):
        start, end = int(offsets[k]), int(offsets[k + 1])
        mine = places[bounds[k]:bounds[k + 1]] - start
        ends = mine[mine < end - start].tolist()
        out.append([*ends, end - start])
    return out


def _encoded(content: str, column: pa.Array) -> Iterator[tuple[int, bytes, bytes]]:
    """(row, text, ids) of each text of a column."""
    tokenizer = _tokenizer(content)
    for lo, hi, data, offsets in text_chunks(column):
        ends = chunk_ends(data, offsets)
        raw = data.tobytes()
        for k in range(hi - lo):
            text = raw[offsets[k]:offsets[k + 1]]
            yield lo + k, text, tokenizer.encode(text, ends[k]) if text else b""


def _content(path: str | None) -> str:
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.json")
    with open(path, encoding="utf-8") as file:
        return file.read()


def encode(docs: DataFrame, path: str | None = None, column: str = "text") -> DataFrame:
    """``doc_id, ids`` (array of int) of every text.  The vocabulary file is read on the driver."""
    content = _content(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [np.frombuffer(x, "<u4").astype(np.int32) for _, _, x in _encoded(content, batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])
        _tokenizer(content).forget()

    return docs.select("doc_id", column).mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, ids array<int>")


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, text`` of rows of ``encode``; null ids give a null text."""
    content = _content(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokenizer = _tokenizer(content)
            texts = [None if x is None else tokenizer.decode(np.array(x, np.int64)) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {dict(encoded.dtypes)['doc_id']}, text string")


def round_trip_report(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every document: encoded, and decoded from its ids."""
    content = _content(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, of_ids, of_text = [], [], []
            tokenizer = _tokenizer(content)
            for _, _, ids in _encoded(content, batch.column(1)):
                n.append(len(ids) // 4)
                of_ids.append(hashlib.sha256(ids).hexdigest())
                of_text.append(hashlib.sha256(tokenizer.decode(np.frombuffer(ids, "<u4")).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )
        _tokenizer(content).forget()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
