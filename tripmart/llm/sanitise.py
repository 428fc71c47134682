"""Personal data, and the words around it that give it away.

Base spans are e-mail addresses, IP addresses, card and phone numbers found by
pattern.  Removing them is not enough where the words next to an address or
number name its owner wherever it is mentioned.  So every distinct value (an
entity) is measured against the words of the documents that mention it, over the
whole corpus: with p the share of documents, a term t reveals an entity e by

    PMI(e, t) = log(p(e, t) / (p(e) p(t)))

out of the IC(e) = -log p(e) there is to learn.  A term that reveals
``REMOVE_SHARE`` of it is to be removed from the documents of that entity, one
above ``GENERALISE_SHARE`` to be replaced by something more general; both are
reported as spans of their own, wherever the term stands in those documents.

Every entity and every such term is judged, by an estimate that its support
corrects: with s contexts that hold both, PMI is lowered by 2 log(1 + ``DOUBT``
/ s), once for each of the two shares it rests on.  Copies of one text prove
nothing, so contexts count, a context being the words within ``WINDOW`` words
of a document's mention.  What a single context holds says nothing but that it
was written once, so there only the terms within that window are judged.

Terms are 64-bit hashes of the lower-cased words outside base spans.  Entities
of a single context need no second scan; the documents of the others are read
again for their terms, found by a fixed-size bitmap, which is what is
broadcast, and an exact join that follows it.  So are the documents that hold a
term, and those in which one has to go.

Defined results: a null or empty text has no spans; repeated rows are reported
each for itself but count as documents each; null ids are kept; an empty table
gives an empty result; further columns are not read.  Offsets are code points,
ends exclusive.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.bitmaps import asked, bitmap
from tripmart.llm.tables import stored
from tripmart.llm.textarrays import BYTE_VALUES, LOWER, WORD_BYTES, mix, text_chunks, word_hashes

KINDS = ("email", "ip", "card", "phone")
WINDOW = 8
#: The squared one-sided 90 percent quantile of the normal distribution, as in Wilson's bound for s of s.
DOUBT = 1.64
REMOVE_SHARE = 0.8
GENERALISE_SHARE = 0.6

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a match can only begin where a run of digits does: from its middle the same text follows
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_DOUBLED = (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches: a local part reaches back from its @ to the end of the last match, @ or other character."""
    taken = 0
    at = text.find("@")
    while at >= 0:
        before = text[taken:at]
        start = taken + len(before.rstrip(_LOCAL))
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
        taken = found.end() if found else at + 1
        at = text.find("@", taken)


def _luhn(digits: str) -> bool:
    values = [int(d) for d in reversed(digits)]
    return (sum(values[::2]) + sum(_DOUBLED[d] for d in values[1::2])) % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if c in "0123456789")


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """Spans of each kind, leftmost and non-overlapping; matches that fail their check are dropped, not retried."""
    out: dict[str, list[tuple[int, int]]] = {kind: [] for kind in KINDS}
    if "@" in text:
        out["email"] = list(_emails(text))
    for m in _IP.finditer(text):
        if all(len(part := p.lstrip("0")) < 4 and int(part or 0) <= 255 for p in m.groups()):
            out["ip"].append(m.span())
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(digits := _digits(m.group())) <= 19 and _luhn(digits):
            out["card"].append(m.span())
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_digits(m.group())) <= 15:
                out["phone"].append(m.span())
    return out


def _value(kind: str, text: str) -> str:
    """An entity's name: the same for different spellings of one value."""
    return f"{kind}:{text.lower() if kind in ('email', 'ip') else _digits(text)}"


def _hash_terms(words: list[str]) -> np.ndarray:
    """Hashes of words, equal to those of ``word_hashes`` over a text."""
    raw = [w.encode() for w in words]
    data = LOWER[np.frombuffer(b"".join(raw), np.uint8)]
    offsets = np.concatenate([[0], np.cumsum([len(w) for w in raw])]).astype(np.int64)
    return word_hashes(data, offsets, np.ones(256, bool))[0]


_MENTION = "struct<entity:string,context:bigint,terms:array<struct<term:bigint,start:int,stop:int>>>"
_FOUND = (
    "row long, doc_id long, n_email long, n_ip long, n_card long, n_phone long, base string, "
    f"mentions array<{_MENTION}>, row_key long"
)


def _visible(words: list[tuple[int, int]], spans: dict[str, list[tuple[int, int]]]) -> np.ndarray:
    """Whether each word lies outside all base spans, of which there is one at least: inside they are hidden anyway."""
    hidden = sorted(x for found in spans.values() for x in found)
    hidden_starts = np.array([s for s, _ in hidden])
    hidden_ends = np.maximum.accumulate([e for _, e in hidden])
    starts, ends = np.array(words, np.int64).reshape(-1, 2).T
    k = np.searchsorted(hidden_starts, ends) - 1
    return (k < 0) | (hidden_ends[k] <= starts)


def _mentions(text: str, spans: dict[str, list[tuple[int, int]]], window: int) -> list[dict]:
    words = [m.span() for m in _WORD.finditer(text)]
    starts = [s for s, _ in words]
    visible = _visible(words, spans)
    out = []
    for kind in KINDS:
        for start, end in spans[kind]:
            first, last = np.searchsorted(starts, [start, end])
            near = [words[k] for k in (*range(max(0, first - window), first), *range(last, min(last + window, len(words)))) if visible[k]]
            if near:
                terms = _hash_terms([text[s:e] for s, e in near])
                context = int(mix(terms * BYTE_VALUES[:len(terms)]).sum(dtype=np.uint64).view(np.int64))
            else:  # no words beside it: the whole text is the context
                terms = np.zeros(0, np.uint64)
                context = int.from_bytes(hashlib.sha256(text.encode()).digest()[:8], "little", signed=True)
            out.append({
                "entity": _value(kind, text[start:end]), "context": context,
                "terms": [{"term": int(t), "start": s, "stop": e} for t, (s, e) in zip(terms.view(np.int64).tolist(), near, strict=True)],
            })
    return out


def _keyed(docs: DataFrame) -> DataFrame:
    """``doc_id, text, row_key``: rows alike in id and text have one key, and the same spans."""
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    return docs.withColumn("row_key", F.xxhash64("doc_id", "text"))


def find(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Base spans of every document and the words near each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33  # rows are told apart by where they were read
        for batch in batches:
            columns: list[list] = [[] for _ in range(6)]
            for value in batch.column(1):
                text = value.as_py() or ""
                spans = base_spans(text)
                for k, kind in enumerate(KINDS):
                    columns[k].append(len(spans[kind]))
                columns[4].append(",".join(f"{kind}:{s}:{e}" for kind in KINDS for s, e in spans[kind]))
                columns[5].append(_mentions(text, spans, window) if any(spans.values()) else [])
            arrays = [pa.array(c, schema.field(k + 2).type) for k, c in enumerate(columns)]
            rows = pa.array(np.arange(row, row + batch.num_rows))
            row += batch.num_rows
            yield pa.RecordBatch.from_arrays([rows, batch.column(0), *arrays, batch.column(2)], names=schema.names)

    schema = _arrow_schema()
    return _keyed(docs).mapInArrow(run, _FOUND)


def _arrow_schema() -> pa.Schema:
    term = pa.struct([("term", pa.int64()), ("start", pa.int32()), ("stop", pa.int32())])
    mention = pa.struct([("entity", pa.string()), ("context", pa.int64()), ("terms", pa.list_(term))])
    return pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), *((f"n_{k}", pa.int64()) for k in KINDS), ("base", pa.string()), ("mentions", pa.list_(mention)), ("row_key", pa.int64())])


def document_counts(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """``term, n``: the documents that hold each term of ``terms(term)``."""
    marks = bitmap(terms, "term")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in text_chunks(batch.column(0)):
                hashes, rows = word_hashes(LOWER[data], offsets, WORD_BYTES)
                maybe = asked(marks, hashes)
                hashes, rows = hashes[maybe], rows[maybe]
                order = np.lexsort((rows, hashes))
                hashes, rows = hashes[order], rows[order]
                fresh = np.ones(len(hashes), bool)
                fresh[1:] = (hashes[1:] != hashes[:-1]) | (rows[1:] != rows[:-1])
                names, count = np.unique(hashes[fresh], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(names.view(np.int64)), pa.array(count)], ["term", "n"])

    counts = docs.select("text").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    return counts.join(terms.select("term").distinct(), "term", "left_semi")


def document_terms(docs: DataFrame, rows: DataFrame, terms: DataFrame | None = None) -> DataFrame:
    """``row_key, words``: the words outside base spans, each with its ``term, start, stop``, of rows that may be among ``rows(row_key)``.

    With ``terms(term)`` only words that may be among them; without, each term once and without its place.
    """
    row_marks, term_marks = bitmap(rows, "row_key"), bitmap(terms, "term") if terms is not None else None
    kind = pa.list_(pa.struct([("term", pa.int64()), ("start", pa.int32()), ("stop", pa.int32())]))

    def words_of(text: str) -> list[dict]:
        words, spans = [m.span() for m in _WORD.finditer(text)], base_spans(text)
        if any(spans.values()):
            visible = _visible(words, spans)
            words = [w for w, seen in zip(words, visible.tolist(), strict=True) if seen]
        if not words:
            return []
        found = _hash_terms([text[s:e] for s, e in words])
        if term_marks is None:
            return [{"term": t} for t in np.unique(found.view(np.int64)).tolist()]
        wanted = np.flatnonzero(asked(term_marks, found))
        return [{"term": int(found[k].view(np.int64)), "start": words[k][0], "stop": words[k][1]} for k in wanted]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = np.flatnonzero(asked(row_marks, np.asarray(batch.column(2)).view(np.uint64)))
            for lo in range(0, len(wanted), 256):
                some = pa.array(wanted[lo:lo + 256])
                words = pa.array([words_of(t.as_py() or "") for t in batch.column(1).take(some)], kind)
                yield pa.RecordBatch.from_arrays([batch.column(2).take(some), words], ["row_key", "words"])

    return _keyed(docs).mapInArrow(run, "row_key long, words array<struct<term:bigint,start:int,stop:int>>")


def disclosing_terms(
    docs: DataFrame, found: DataFrame, remove_share: float = REMOVE_SHARE, generalise_share: float = GENERALISE_SHARE, doubt: float = DOUBT,
) -> DataFrame:
    """``entity, term, action``: the terms that give an entity away, and whether to remove or generalise them."""
    mentions = found.select("row", "row_key", F.explode("mentions").alias("m")).select("row", "row_key", "m.entity", "m.context", F.col("m.terms.term").alias("terms"))
    # a document's context is one of its mentions': copies have the same
    holders = mentions.groupBy("entity", "row", "row_key").agg(F.min("context").alias("context"))
    entities = stored(holders.groupBy("entity").agg(F.count_distinct("context").alias("contexts"), F.count("*").alias("n_entity")), "entities")

    several = holders.join(entities.where("contexts > 1"), "entity").select("row_key", "entity", "context").distinct()
    several = stored(several, "entity_rows")
    whole = document_terms(docs, several).join(several.groupBy("row_key").agg(F.collect_list(F.struct("entity", "context")).alias("e")), "row_key")
    whole = whole.select(F.explode("e").alias("e"), "words.term").select("e.*", F.explode("term").alias("term"))
    whole = whole.groupBy("entity", "term", "context").agg(F.count("*").alias("n"))
    whole = whole.groupBy("entity", "term").agg(F.sum("n").alias("n_both"), F.count("*").alias("support")).where("support > 1")

    near = mentions.select("row", "entity", F.explode("terms").alias("term")).distinct()
    near = near.groupBy("entity", "term").agg(F.count("*").alias("n_both"), F.lit(1).cast("long").alias("support"))
    # the whole documents' figures, where there are any, are the larger ones
    pairs = whole.unionByName(near).groupBy("entity", "term").agg(F.max("n_both").alias("n_both"), F.max("support").alias("support"))
    pairs = stored(pairs.join(entities, "entity"), "entity_terms")
    total = found.count()
    counted = pairs.join(document_counts(docs, pairs), "term")
    pmi = F.log(F.col("n_both") * F.lit(float(total)) / (F.col("n_entity") * F.col("n"))) - 2 * F.log1p(F.lit(doubt) / F.col("support"))
    ic = F.log(F.lit(float(total)) / F.col("n_entity"))
    share = F.when(ic > 0, pmi / ic)
    return counted.select(
        "entity", "term", F.when(share >= remove_share, "remove").when(share >= generalise_share, "generalise").alias("action")
    ).where("action is not null")


def sanitise_report(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans`` and ``n_terms``, the disclosing terms."""
    found = stored(find(docs, window), "personal_data")
    terms = stored(disclosing_terms(docs, found), "disclosing_terms")
    held = found.select("row_key", F.explode("mentions").alias("m")).select("row_key", "m.entity").distinct()
    # one action a term of a row: the stronger of what its entities ask for
    asked_for = stored(held.join(terms, "entity").groupBy("row_key", "term").agg(F.max("action").alias("action")), "terms_of_rows")
    words = document_terms(docs, asked_for, terms).select("row_key", F.explode("words").alias("w")).select("row_key", "w.*").distinct()
    spans = words.join(asked_for, ["row_key", "term"])
    per_row = spans.groupBy("row_key").agg(
        F.count("*").alias("n_terms"),
        F.array_join(F.transform(
            F.array_sort(F.collect_list(F.struct("action", "start", "stop"))),
            lambda s: F.concat_ws(":", s["action"], s["start"], s["stop"]),
        ), ",").alias("extra"),
    )
    return found.drop("mentions").join(per_row, "row_key", "left").select(
        "doc_id", *(f"n_{k}" for k in KINDS), F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"),
        F.concat_ws(",", F.when(F.col("base") != "", F.col("base")), "extra").alias("spans"), F.coalesce("n_terms", F.lit(0)).alias("n_terms"),
    )


def redact(text: str, spans: str) -> str:
    """``text`` with every reported span replaced by its kind in brackets (a generalised term by ``[term]``)."""
    taken = sorted((int(s), -int(e), kind) for kind, s, e in (x.split(":") for x in spans.split(",") if x))
    out, at = [], 0
    for start, minus_end, kind in taken:
        if start >= at:
            out += [text[at:start], {"remove": "", "generalise": "[term]"}.get(kind, f"[{kind}]")]
            at = -minus_end
    return "".join([*out, text[at:]])
