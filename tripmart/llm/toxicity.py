"""Toxicity categories predicted by a chain of linear classifiers.

The label table says which documents are toxic.  Three categories are predicted,
one after another, each by a logistic regression over the same text features
plus the probabilities of the categories before it:

* ``toxic``: the label itself;
* ``severe``: toxic, with at least ``SEVERE_TERMS`` distinct indicative features;
* ``dense``: toxic, with one indicative word or more in ``DENSE_WORDS``.

The probabilities a later model is trained on come from out-of-fold
predictions: the labelled documents are dealt into folds by hashed id, and each
fold is predicted by a model of the others, so no model sees a probability
that was fitted to the very row.

Features are hashes of lower-cased words and of their first four and five
bytes, which stand for word families.  Those that are indicative are chosen
from the labelled documents by the z-score of their log odds.

Training uses at most ``MAX_LABELLED`` labelled documents, those with the
smallest hashed ids, whose ids are broadcast; the chosen features are at most
``MAX_FEATURES``.  Every document is scored over its whole text.

Defined results: a null or empty text has no features and gets the chain's base
probabilities; without labels, or with one class only, probabilities are 0 or
the class's share; conflicting labels of one document count as toxic, and of
documents that repeat a labelled id the smallest text is trained on; repeated
documents are scored each for itself; an empty table gives an empty result;
further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.textarrays import LOWER, WORD_BYTES, Hasher, mix, runs, text_chunks

MAX_LABELLED = 20_000
MAX_FEATURES = 4096
MIN_SUPPORT = 3
MIN_Z = 3.5
FOLDS = 5
SEVERE_TERMS = 4
DENSE_WORDS = 50
CATEGORIES = ("toxic", "severe", "dense")
PREFIXES = (4, 5)


def _features(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(hash, text index) per word, then per word prefix of each length."""
    starts, ends, rows = runs(data, offsets, WORD_BYTES)
    hasher = Hasher(LOWER[data])
    yield hasher.spans(starts, ends), rows
    for length in PREFIXES:
        long = ends - starts > length
        yield mix(hasher.spans(starts[long], starts[long] + length) + np.uint64(length)), rows[long]


def _presence(column: pa.Array, chosen: np.ndarray | None) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """Per chunk (first row, end row, feature, text index, words per text), a feature once per text.

    With ``chosen`` (sorted hashes) features are indices into it and others are left out.
    """
    for lo, hi, data, offsets in text_chunks(column):
        found, where, words = [], [], np.zeros(hi - lo, np.int64)
        for k, (hashes, rows) in enumerate(_features(data, offsets)):
            if k == 0:
                words = np.bincount(rows, minlength=hi - lo)
            if chosen is not None:
                at = np.searchsorted(chosen, hashes)
                at[at == len(chosen)] = 0
                known = chosen[at] == hashes if len(chosen) else np.zeros(len(hashes), bool)
                hashes, rows = at[known].astype(np.uint64), rows[known]
            found.append(hashes)
            where.append(rows)
        feature, row = np.concatenate(found), np.concatenate(where)
        order = np.lexsort((feature, row))
        feature, row = feature[order], row[order]
        fresh = np.ones(len(feature), bool)
        fresh[1:] = (feature[1:] != feature[:-1]) | (row[1:] != row[:-1])
        yield lo, hi, feature[fresh], row[fresh], words


class Linear:
    """A sparse logistic regression: feature weights, weights of earlier probabilities, bias."""

    def __init__(self, n_features: int, n_earlier: int) -> None:
        self.w, self.e, self.b = np.zeros(n_features), np.zeros(n_earlier), 0.0

    def logits(self, feature: np.ndarray, row: np.ndarray, earlier: np.ndarray) -> np.ndarray:
        return np.bincount(row, self.w[feature], minlength=len(earlier)) + earlier @ self.e + self.b

    def predict(self, feature: np.ndarray, row: np.ndarray, earlier: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(feature, row, earlier), -30, 30)))

    def fit(self, feature: np.ndarray, row: np.ndarray, earlier: np.ndarray, y: np.ndarray, used: np.ndarray, steps: int = 400, decay: float = 1e-3) -> Linear:
        """Gradient steps with per-weight step sizes (Adagrad) on the rows that ``used`` marks."""
        n = max(1, int(used.sum()))
        share = (y[used].sum() + 0.5) / (n + 1)
        self.b = float(np.log(share / (1 - share)))
        inside = used[row]
        feature, row = feature[inside], row[inside]
        past = [np.full(len(self.w), 1e-8), np.full(len(self.e), 1e-8), 1e-8]
        for _ in range(steps):
            error = (self.predict(feature, row, earlier) - y) * used / n
            gradients = [np.bincount(feature, error[row], minlength=len(self.w)) + decay * self.w / n, earlier.T @ error + decay * self.e / n, float(error.sum())]
            for k, g in enumerate(gradients):
                past[k] = past[k] + g * g
            self.w -= 0.5 * gradients[0] / np.sqrt(past[0])
            self.e -= 0.5 * gradients[1] / np.sqrt(past[1])
            self.b -= 0.1 * gradients[2] / np.sqrt(past[2])
        return self


class Chain:
    """The fitted models in order, with the features they read."""

    def __init__(self, chosen: np.ndarray, models: list[Linear], thresholds: list[float]) -> None:
        self.chosen, self.models, self.thresholds = chosen, models, thresholds

    def predict(self, feature: np.ndarray, row: np.ndarray, n_rows: int) -> np.ndarray:
        out = np.zeros((n_rows, 0))
        for model in self.models:
            out = np.column_stack([out, model.predict(feature, row, out)])
        return out


def best_threshold(p: np.ndarray, y: np.ndarray) -> float:
    """The cut between two neighbouring predictions with the best F1; 0.5 where nothing can be told apart."""
    order = np.argsort(-p, kind="stable")
    hits = np.cumsum(y[order])
    f1 = 2 * hits / (np.arange(1, len(p) + 1) + max(1, y.sum()))
    last = np.append(p[order][1:] < p[order][:-1], True)  # a cut never parts equal predictions
    if not y.any() or y.all():
        return 0.5
    best = int(np.argmax(np.where(last, f1, -1)))
    below = p[order][best + 1] if best + 1 < len(p) else 0.0
    return float((p[order][best] + below) / 2)


def _labelled(docs: DataFrame, labels: DataFrame, max_labelled: int) -> DataFrame:
    """``doc_id, text, y`` of the bounded sample of labelled documents."""
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("y"))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)
    found = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    return found.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("y").alias("y"))


def choose_features(labelled: DataFrame, max_features: int = MAX_FEATURES) -> np.ndarray:
    """Sorted hashes of the features that speak for toxicity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = np.asarray(batch.column(1)).astype(bool)
            found, toxic = [np.zeros(0, np.uint64)], [np.zeros(0, bool)]
            for lo, _, feature, row, _ in _presence(batch.column(0), None):
                found.append(feature)
                toxic.append(y[lo + row])
            names, inverse = np.unique(np.concatenate(found), return_inverse=True)
            positive = np.bincount(inverse, np.concatenate(toxic), minlength=len(names)).astype(np.int64)
            every = np.bincount(inverse, minlength=len(names))
            yield pa.RecordBatch.from_arrays([pa.array(names.view(np.int64)), pa.array(positive), pa.array(every)], ["feature", "positive", "n"])

    counts = labelled.select("text", "y").mapInArrow(run, "feature long, positive long, n long").groupBy("feature").agg(
        F.sum("positive").alias("p"), F.sum("n").alias("n")
    )
    sizes = labelled.agg(F.count("*").alias("n"), F.sum(F.col("y").cast("long")).alias("p")).first()
    n, p = sizes["n"], sizes["p"] or 0
    if not p or p == n:
        return np.zeros(0, np.uint64)
    odds = F.log((F.col("p") + 0.5) / (p - F.col("p") + 0.5)) - F.log((F.col("n") - F.col("p") + 0.5) / (n - p - F.col("n") + F.col("p") + 0.5))
    spread = F.sqrt(1 / (F.col("p") + 0.5) + 1 / (F.col("n") - F.col("p") + 0.5))
    best = counts.where(F.col("p") >= MIN_SUPPORT).withColumn("z", odds / spread).where(F.col("z") >= MIN_Z)
    rows = best.orderBy(F.desc("z"), "feature").limit(max_features).select("feature").collect()
    return np.unique(np.array([r["feature"] for r in rows], np.int64).view(np.uint64))


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, max_features: int = MAX_FEATURES) -> Chain:
    """Train the chain on the labelled documents."""
    labelled = _labelled(docs, labels, max_labelled)
    chosen = choose_features(labelled, max_features)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, feature, row, words in _presence(batch.column(1), chosen):
                cut = np.searchsorted(row, np.arange(hi - lo + 1))
                lists = pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(feature.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), batch.column(2).slice(lo, hi - lo), lists, pa.array(words)], ["doc_id", "y", "features", "words"])

    rows = labelled.select("doc_id", "text", F.col("y").cast("int")).mapInArrow(
        run, f"doc_id {dict(labelled.dtypes)['doc_id']}, y int, features array<int>, words long"
    ).toArrow()  # at most max_labelled rows of chosen features
    order = np.argsort(np.asarray(rows["doc_id"]), kind="stable")  # the same training whatever the order of arrival
    lists = [rows["features"][int(k)].as_py() for k in order]
    y = np.asarray(rows["y"], np.int64)[order]
    words = np.asarray(rows["words"])[order]
    count = np.array([len(x) for x in lists], np.int64)
    feature = np.array([f for x in lists for f in x], np.int64)
    row = np.repeat(np.arange(len(lists)), count)
    targets = [y > 0, (y > 0) & (count >= SEVERE_TERMS), (y > 0) & (count * DENSE_WORDS >= np.maximum(words, 1) * (1 + len(PREFIXES)))]
    fold = np.arange(len(y)) % FOLDS
    earlier = np.zeros((len(y), 0))
    models, thresholds = [], []
    for target in targets:
        out_of_fold = np.zeros(len(y))
        for k in range(FOLDS):
            model = Linear(len(chosen), earlier.shape[1]).fit(feature, row, earlier, target, fold != k)
            out_of_fold[fold == k] = model.predict(feature, row, earlier)[fold == k]
        models.append(Linear(len(chosen), earlier.shape[1]).fit(feature, row, earlier, target, np.ones(len(y), bool)))
        thresholds.append(best_threshold(out_of_fold, target))
        earlier = np.column_stack([earlier, out_of_fold])
    return Chain(chosen, models, thresholds)


def predict(docs: DataFrame, chain: Chain) -> DataFrame:
    """``doc_id, p_toxic, p_severe, p_dense, toxic, severe, dense`` of every document.

    A category holds from the threshold on that had the best F1 out of fold.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, feature, row, _ in _presence(batch.column(1), chain.chosen):
                p = chain.predict(feature.astype(np.int64), row, hi - lo)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), *(pa.array(np.ascontiguousarray(c)) for c in p.T)], ["doc_id", *(f"p_{c}" for c in CATEGORIES)])

    schema = f"doc_id {dict(docs.dtypes)['doc_id']}, " + ", ".join(f"p_{c} double" for c in CATEGORIES)
    scored = docs.select("doc_id", "text").mapInArrow(run, schema)
    return scored.select("*", *((F.col(f"p_{c}") >= t).alias(c) for c, t in zip(CATEGORIES, chain.thresholds, strict=True)))


def toxicity_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return predict(docs, fit(docs, labels))
