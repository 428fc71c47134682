import math
import random

import numpy as np
import pytest
from tripmart.llm import topk


def by_pairs(rows, k, asks):
    usable = sorted({(i, tuple(math.floor(256 * x) for x in v)) for i, v in rows
                     if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)})
    out = []
    for q, a in usable:
        if asks(q):
            scored = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in usable if i != q and len(a) == len(b))
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def vectors(spark, rows):
    return topk.quantised(spark.createDataFrame([(*r, 7) for r in rows], "vec_id long, embedding array<double>, key long"))


def rows_of(out):
    return sorted((r.query_id, r.rank, r.vec_id, r.score) for r in out.collect())


@pytest.mark.parametrize("group_rows, block_rows", [(8192, 2048), (7, 3)])
def test_equals_all_pairs(spark, group_rows, block_rows):
    rng = random.Random(1)
    rows = [(k, [rng.choice([rng.gauss(0, 1), 0.0, 0.25]) for _ in range(6)]) for k in range(60)]
    rows += [(100 + k, [1.0, 0.5, -0.25, 0.0, 0.0, 0.0]) for k in range(20)]  # many equal vectors: ties
    rows += [(200, None), (201, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (202, [math.nan] * 6), (203, [math.inf] + [0.0] * 5), (None, [1.0] * 6)]
    rows += [(0, rows[0][1]), (300, [2.0, 1.0]), (301, [1.0, -1.0]), (302, []), (303, [])]
    v = vectors(spark, rows)
    asks = lambda i: i % 3 == 0
    out = topk.exact_top_k(v, v.where("vec_id % 3 = 0"), k=4, group_rows=group_rows, block_rows=block_rows)
    assert rows_of(out) == by_pairs(rows, 4, asks)


def test_scores_beyond_exact_floats(spark):
    rows = [(k, [2.0**20 + k, 2.0**19 - k, 1.0]) for k in range(8)]
    v = vectors(spark, rows)
    assert rows_of(topk.exact_top_k(v, v, k=3)) == by_pairs(rows, 3, lambda i: True)


def test_empty_tables(spark):
    v = vectors(spark, [(1, [1.0])])
    assert topk.exact_top_k(v, v.limit(0)).collect() == []
    assert topk.exact_top_k(v.limit(0), v.limit(0)).collect() == []
    assert topk.exact_top_k(v, v).collect() == []


def cells(rng, n, width, spread):
    """Vectors whose lengths and whose slices' lengths differ by powers of ``spread``."""
    scale = spread ** rng.normal(size=(n, 4)).repeat(width // 4, axis=1)
    return np.floor(256 * rng.normal(size=(n, width)) * scale)


@pytest.mark.parametrize("spread, share", [(1.0, 1.1), (3.0, 0.6)])
def test_the_phases_take_fewer_products_than_all_pairs(spread, share):
    """Where slices differ in length, thresholds rule out the tails of the lists; elsewhere the head is all there is to add."""
    rng = np.random.default_rng(5)
    rows, ids = cells(rng, 6000, 32, spread), np.arange(6000)
    asks = ids[::30]
    queries = rows[asks]
    line, at, scores, first = topk.gathered(asks, queries, ids, rows, 5, head=64)
    exact = queries @ rows.T
    assert (scores == exact[line, at]).all() and (asks[line] != ids[at]).all()
    cutoffs = [int(np.sort(scores[line == k])[-5]) for k in range(len(asks))]
    line, at, scores, second = topk.sufficient(asks, queries, ids, rows, cutoffs, 5)
    exact[np.arange(len(asks)), asks] = -np.inf
    for k in range(len(asks)):
        best = np.lexsort((ids, -exact[k]))[:5]
        assert at[line == k].tolist() == best.tolist() and scores[line == k].tolist() == exact[k, best].tolist()
    assert first + second < share * queries.shape[0] * rows.size


def test_a_cell_without_cutoffs_gives_all_it_has():
    rows = np.array([[1.0, 2.0], [0.0, 0.0], [-3.0, 1.0]])
    line, at, scores, _ = topk.sufficient(np.array([7]), np.array([[1.0, -1.0]]), np.array([1, 2, 7]), rows, [None], 5)
    assert (line.tolist(), at.tolist(), scores.tolist()) == ([0, 0], [1, 0], [0.0, -1.0])
