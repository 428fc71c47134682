"""Quality selection by importance resampling of hashed n-gram models.

Two generative models over hashed unigrams and bigrams are counted: the target
model from documents labelled good, the raw model from all documents.  A
document's importance is the log ratio of its probability under both, summed
over its n-grams.  Adding Gumbel noise and taking the k largest samples k
documents without replacement in proportion to importance.

Tokens are lower-cased words and runs of punctuation; a token equal to the one
before it also counts as one fixed "again" token, since repetition is a trait
of its own.  The noise is a hash of the id, so a task that runs again draws
the same.

The k-th largest key is found by counting the keys in equal bins, then those of
the bin that holds rank k in equal bins again, until that bin holds one value:
a few small counts, no sort and no collected rows.

Both models cover all they are about: the target model every document that is
labelled good, found by a join that Spark plans by the size of the labels, the
raw model every document.  The number of buckets is fixed: a task sends at most
a count per bucket, so that counts grow with the input alone, and every task
receives the model (half a megabyte).

Defined results: a null, empty or blank text has no tokens, a null weight and is
never selected, nor counted in k; documents that tie with the k-th key are all
selected; without good labels nothing can be told apart and all with tokens
are selected; repeated documents are scored each for itself; an empty table
gives an empty result; further columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.tables import stored
from tripmart.llm.textarrays import BYTE_VALUES, LOWER, NON_SPACE_BYTES, WORD_BYTES, Hasher, mix, text_chunks

BUCKETS = 1 << 16
#: Added to every bucket of either model.
SMOOTHING = 1.0

_AGAIN = np.uint64(BYTE_VALUES[0])


def _tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text index) of the words and punctuation runs of each text."""
    kind = np.where(WORD_BYTES, 1, np.where(NON_SPACE_BYTES, 2, 0)).astype(np.int8)[data]
    edge = np.ones(len(data) + 1, bool)
    edge[1:-1] = kind[1:] != kind[:-1]
    edge[offsets] = True
    edges = np.flatnonzero(edge)
    starts, ends = edges[:-1], edges[1:]
    full = kind[starts] > 0 if len(starts) else np.zeros(0, bool)
    starts, ends = starts[full], ends[full]
    return Hasher(LOWER[data]).spans(starts, ends), np.searchsorted(offsets, starts, "right") - 1


def _grams(data: np.ndarray, offsets: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, text index) of every n-gram of each text."""
    tokens, rows = _tokens(data, offsets)
    same_text = rows[1:] == rows[:-1]
    pairs = mix(tokens[:-1] * np.uint64(3) + tokens[1:])[same_text]
    again = same_text & (tokens[1:] == tokens[:-1])
    grams = np.concatenate([tokens, pairs, np.full(int(again.sum()), _AGAIN)])
    return (grams % np.uint64(buckets)).astype(np.int64), np.concatenate([rows, rows[1:][same_text], rows[1:][again]])


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``bucket, n``: the n-grams of all rows of ``texts(text)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, data, offsets in text_chunks(batch.column(0)):
                counts += np.bincount(_grams(data, offsets, buckets)[0], minlength=buckets)
        full = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(full), pa.array(counts[full])], ["bucket", "n"])

    return texts.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def _probabilities(texts: DataFrame, buckets: int) -> np.ndarray:
    """Log probability of each bucket, smoothed; none for texts without n-grams."""
    found = bucket_counts(texts, buckets).toArrow()  # at most one row a bucket
    counts = np.zeros(buckets)
    counts[np.asarray(found["bucket"])] = np.asarray(found["n"])
    return np.log((counts + SMOOTHING) / (counts.sum() + SMOOTHING * buckets)) if counts.any() else np.zeros(0)


def fit(docs: DataFrame, good: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Log ratio of target to raw probability per bucket; ``good(doc_id)`` names the target documents."""
    # stored, so that the join knows the size of the ids and may split a hot one
    ids = stored(good.where("doc_id is not null").select("doc_id").distinct(), "good_ids")
    target = _probabilities(docs.join(ids, "doc_id", "left_semi"), buckets)
    if not len(target):
        return np.zeros(buckets)
    return target - _probabilities(docs, buckets)


def scored(docs: DataFrame, model: np.ndarray, weight_col: str = "_weight", key_col: str = "_key") -> DataFrame:
    """``docs`` with the log importance and the key (that plus Gumbel noise), null without tokens."""
    buckets = len(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            weight = np.full(batch.num_rows, np.nan)
            for lo, hi, data, offsets in text_chunks(batch.column("text")):
                gram, row = _grams(data, offsets, buckets)
                total = np.bincount(row, model[gram], minlength=hi - lo)
                weight[lo:hi] = np.where(np.bincount(row, minlength=hi - lo) > 0, total, np.nan)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(weight, from_pandas=True)], [*batch.schema.names, weight_col])

    uniform = (F.pmod(F.xxhash64(F.lit("gumbel"), "doc_id"), F.lit((1 << 52) - 1)) + 0.5) / float(1 << 52)
    return docs.mapInArrow(run, f"{_ddl(docs)}, `{weight_col}` double").withColumn(key_col, F.col(weight_col) - F.log(-F.log(uniform)))


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{name}` {kind}" for name, kind in df.dtypes)


def kth_largest(keys: DataFrame, column: str, k: int, bins: int = 4096) -> float:
    """The k-th largest non-null value of ``column``, exactly, by refining a histogram.

    Each step counts the values between ``low`` and ``high`` in equal bins and
    narrows both to the smallest and largest value of the bin with rank k.
    """
    low, high = keys.agg(F.min(column), F.max(column)).first()
    while low != high:
        place = F.floor((F.col(column) - F.lit(low)) / F.lit((high - low) / bins))
        inside = keys.where(F.col(column).between(F.lit(low), F.lit(high)))
        found = inside.groupBy(F.when(F.col(column) == F.lit(high), F.lit(bins)).otherwise(F.least(place, F.lit(bins - 1))).alias("bin")).agg(
            F.count("*").alias("n"), F.min(column).alias("low"), F.max(column).alias("high")
        ).collect()
        for row in sorted(found, key=lambda r: -r["bin"]):
            if row["n"] >= k:
                low, high = row["low"], row["high"]
                break
            k -= row["n"]
    return low


def cutoff(docs: DataFrame, labels: DataFrame, keep_share: float | None = None) -> tuple[np.ndarray, float | None, DataFrame]:
    """The model, the key from which on documents are selected, and ``doc_id, log_weight, key`` of all documents."""
    docs = docs.select("doc_id", "text")
    model = fit(docs, labels.where("quality = 1"))
    keys = stored(scored(docs, model).select("doc_id", F.col("_weight").alias("log_weight"), F.col("_key").alias("key")), "weights")
    total = keys.where("key is not null").count()
    if keep_share is None:
        known = labels.where("quality is not null").agg(F.avg((F.col("quality") == 1).cast("double"))).first()[0]
        keep_share = known or 1.0
    k = min(total, math.ceil(total * keep_share))
    return model, kth_largest(keys, "key", k) if k else None, keys


def importance_sample(docs: DataFrame, labels: DataFrame, keep_share: float | None = None) -> DataFrame:
    """``doc_id, log_weight, key, selected``: k documents sampled by importance.

    k is ``keep_share`` of the documents with tokens; by default the share of
    good ones among the labels.
    """
    _, least, keys = cutoff(docs, labels, keep_share)
    chosen = F.coalesce(F.col("key") >= F.lit(least), F.lit(False)) if least is not None else F.lit(False)
    return keys.withColumn("selected", chosen)
