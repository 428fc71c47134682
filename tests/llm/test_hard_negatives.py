import math
import random

import numpy as np
import pyarrow as pa
import pytest
from tripmart.llm import hard_negatives


def by_pairs(rows, asks, positives=5, negatives=3):
    usable = sorted({(i, label, tuple(math.floor(256 * x) for x in v)) for i, v, label in rows
                     if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)})
    out = []
    for a, label, v in usable:
        if not asks(a):
            continue
        scored = [(sum(x * y for x, y in zip(v, w, strict=True)), i, other) for i, other, w in usable if i != a and len(v) == len(w)]
        best = sorted((-s, i) for s, i, other in scored if other == label)[:positives]
        for s, p in best:
            band = sorted((-n, i) for n, i, other in scored if other != label and -50 * s <= 100 * n <= -95 * s)
            out += [(a, p, k + 1, i, -s, -n) for k, (n, i) in enumerate(band[:negatives])]
    return sorted(out)


def table(spark, rows):
    frame = spark.createDataFrame([(*r, 7, 7, "x") for r in rows], "vec_id long, embedding array<double>, label int, key long, width long, asks string")
    return hard_negatives.labelled_vectors(frame)


def mined(vectors, condition="true", **options):
    out = hard_negatives.hard_negatives(vectors, vectors.where(condition), **options)
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, out.collect()))


def clustered(rng, n, width=8, labels=4, first=0):
    centres = [[rng.gauss(0, 1) for _ in range(width)] for _ in range(labels)]
    out = []
    for k in range(n):
        label = rng.randrange(labels) if rng.random() < 0.7 else 0  # one label holds many rows
        size = math.exp(rng.gauss(0, 0.7))
        out.append((first + k, [size * (c + rng.gauss(0, 0.8)) for c in centres[label]], label))
    return out


@pytest.mark.parametrize("group_rows, block_rows", [(8192, 2048), (13, 5)])
def test_equals_all_pairs(spark, group_rows, block_rows):
    rng = random.Random(1)
    rows = clustered(rng, 150)
    rows += [(1000 + k, rows[3][1], k % 3) for k in range(25)]  # equal vectors under several labels: ties
    rows += [(2000, None, 1), (2001, [1.0] * 8, None), (2002, [math.nan] * 8, 1), (2003, [None] + [1.0] * 7, 1), (None, [1.0] * 8, 1), (2004, [math.inf] * 8, 2)]
    rows += [rows[0], (0, rows[5][1], 3)]  # a repeated row, a repeated id
    rows += [(3000, [0.0] * 8, 0), (3001, [0.0] * 8, 0), (3002, [0.0] * 8, 1), (3003, [1.0, 2.0], 0), (3004, [2.0, 1.0], 0), (3005, [1.0, 1.0], 1), (3006, [], 0)]
    got = mined(table(spark, rows), "vec_id % 3 = 0", group_rows=group_rows, block_rows=block_rows)
    assert got == by_pairs(rows, lambda i: i % 3 == 0)
    assert len(got) > 200


def test_scores_beyond_exact_floats(spark):
    rows = [(k, [2.0**20 + k, 2.0**19 - 40 * k * k, 1.0], k % 2) for k in range(14)]
    assert mined(table(spark, rows)) == by_pairs(rows, lambda i: True)


def test_negative_and_zero_scores(spark):
    rows = [(0, [1.0, 0.0], 0), (1, [-1.0, 0.0], 0), (2, [-0.7, 0.1], 1), (3, [0.0, 1.0], 0), (4, [0.0, 2.0], 1)]
    assert mined(table(spark, rows)) == by_pairs(rows, lambda i: True)


def test_pruning_keeps_what_reaches_the_threshold_and_saves_products():
    rng = np.random.default_rng(4)
    rows = np.floor(256 * rng.normal(size=(6000, 32)) * np.exp(rng.normal(0, 0.5, size=(6000, 1))))
    index = hard_negatives.LengthBuckets(np.arange(6000), np.zeros(6000, int), rows, np.abs(rows).max())
    for a in range(0, 6000, 500):
        scores = rows @ rows[a]
        least = np.partition(scores, -20)[-20]
        index.products = 0
        reached = {int(index.ids[p]) for places, _ in index.reaching(rows[a], lambda: least) for p in places}
        assert set(np.flatnonzero(scores >= least)) <= reached
        assert index.products < 2000  # a third of the rows


def a_cell(asks, rows, **more):
    """One task's table: the rows' (ids, labels, vectors) and the anchors', which keep further columns."""
    ids, labels, vectors = (np.concatenate(column) for column in zip(asks, rows, strict=True))
    own, other = len(asks[0]), len(rows[0])
    columns = {name: pa.array(values + [None] * other, pa.list_(pa.struct([("positive_id", pa.int64()), ("score", pa.int64())]))) for name, values in more.items()}
    return pa.table({"vec_id": ids, "label": labels, "key": ids, "v": pa.array(list(vectors), pa.list_(pa.float64())), "asks": [True] * own + [False] * other, **columns})


def test_anchors_go_through_a_bucket_together(monkeypatch):
    rng = np.random.default_rng(5)
    vectors = np.floor(256 * rng.normal(size=(3000, 16)))
    ids, labels = np.arange(3000), np.arange(3000) % 3
    calls = []
    step = hard_negatives.LengthBuckets._feasible
    monkeypatch.setattr(hard_negatives.LengthBuckets, "_feasible", lambda self, *args: calls.append(1) or step(self, *args))
    asks = (ids[:600], labels[:600], vectors[:600])
    found = hard_negatives._find_positives(a_cell(*[tuple(column[labels[:len(column)] == 0] for column in side) for side in (asks, (ids, labels, vectors))]), 5)
    scores = vectors @ vectors.T
    positives = {}
    for a in range(0, 600, 3):
        same = [i for i in range(0, 3000, 3) if i != a]
        positives[a] = sorted((-scores[a, i], i) for i in same)[:5]
    assert sorted((r["anchor_id"], -r["score"], r["positive_id"]) for r in found.to_pylist()) == sorted((a, s, i) for a, best in positives.items() for s, i in best)

    first = tuple(column[labels[:600] == 0] for column in asks)
    given = [[{"positive_id": i, "score": int(-s)} for s, i in positives[a]] for a in first[0]]
    mined = hard_negatives._find_negatives(a_cell(first, (ids, labels, vectors), positives=given), 3, 50, 95)
    expected = []
    for a, best in positives.items():
        for n, (s, p) in enumerate(best):
            band = sorted((-scores[a, i], i) for i in range(3000) if i % 3 and -50 * s <= 100 * scores[a, i] <= -95 * s)
            expected += [(a, a, n, p, -s, i, -t) for t, i in band[:3]]
    assert sorted(tuple(r.values()) for r in mined.to_pylist()) == sorted(expected)
    # 200 anchors of one label: some buckets of 1,000 and of 3,000 rows, not 200 times as many steps
    assert 0 < len(calls) < 100


@pytest.mark.parametrize("narrow", [1, hard_negatives.NARROW, 10**6])  # every range read row by row, or none
@pytest.mark.parametrize("spread", [0.02, 1.0])
def test_narrow_and_wide_ranges_lose_no_row(monkeypatch, spread, narrow):
    monkeypatch.setattr(hard_negatives, "NARROW", narrow)
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(40, 12))
    size = np.exp(rng.normal(0, 0.4, size=(4000, 1)))
    rows = np.floor(256 * size * (centres[rng.integers(0, 40, 4000)] + spread * rng.normal(size=(4000, 12))))
    queries = rows[:100]
    index = hard_negatives.LengthBuckets(np.arange(4000), np.zeros(4000, int), rows, np.abs(queries).max())
    scores = queries @ rows.T
    least = np.partition(scores, -15, axis=1)[:, -15]
    least[:3] = [-np.inf, 0, np.inf]
    got = [pair for lines, places, found in index.all_reaching(queries, lambda: least) for pair in zip(lines, index.ids[places], found, strict=True)]
    assert sorted(got) == [(a, i, scores[a, i]) for a, i in zip(*np.nonzero(scores >= least[:, None]), strict=True)]
    assert index.products < 8000 + 98 * 4000 / 10


def test_empty_tables(spark):
    vectors = table(spark, [(1, [1.0], 1), (2, [1.0], 1)])
    assert mined(vectors, "false") == []
    assert mined(vectors) == []
    empty = table(spark, [])
    assert mined(empty) == []
