import math
import random

import numpy as np
from pyspark.sql import functions as F
from tests.llm.helpers import frame, mixed_rows, prose, words_of
from tripmart.llm import jaccard, linking

WORD = "[^\x20\x09-\x0D]+"


def shingle_set(text):
    words = words_of(text, WORD)
    return frozenset(tuple(words[k:k + 4]) for k in range(max(1, len(words) - 3))) if words else frozenset()


def by_pairs(rows):
    sets = [shingle_set(t) for _, t in rows]
    up = list(range(len(rows)))

    def find(x):
        return x if up[x] == x else find(up[x])

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 85 * len(a | sets[j]):
                up[find(i)] = find(j)
    least = {}
    for k, (doc_id, _) in enumerate(rows):
        least[find(k)] = min([x for x in (least.get(find(k)), doc_id) if x is not None], default=None)
    return [(doc_id, len(sets[k]), least[find(k)]) for k, (doc_id, _) in enumerate(rows)]


def case(n=150, seed=4):
    rng = random.Random(seed)
    rows = mixed_rows()
    bases = [prose(rng, rng.choice([4, 6, 8, 10, 14, 17, 20, 30, 80]), 30) for _ in range(25)]
    for k in range(n):
        words = rng.choice(bases).split()
        for _ in range(rng.randrange(3)):
            at = rng.randrange(len(words))
            words[at:at + rng.randrange(2)] = [rng.choice(["x", "y", "W1"])] * rng.randrange(2)
            words = words or ["x"]
        rows.append((1000 + k, " ".join(words)))
    return rows


def test_components_equal_all_pairs(spark):
    rows = case()
    out = jaccard.jaccard_components(frame(spark, rows))
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in out.collect()]
    assert sorted(got, key=str) == sorted(by_pairs(rows), key=str)


def test_every_boundary_finds_the_same(spark, monkeypatch):
    rows = case(60, seed=5)
    expected = sorted(by_pairs(rows), key=str)
    for boundary in (0, 7, 20):
        monkeypatch.setattr(jaccard, "choose_boundary", lambda *a, b=boundary: b)
        got = [(r.doc_id, r.n_shingles, r.component_id) for r in jaccard.jaccard_components(frame(spark, rows)).collect()]
        assert sorted(got, key=str) == expected


def test_large_components_are_compared_in_blocks(spark):
    rng = random.Random(6)
    base = prose(rng, 60).split()
    rows = []
    for k in range(120):  # one group of near copies, pairwise similar or not
        words = list(base)
        for _ in range(rng.randrange(4)):
            words[rng.randrange(len(words))] = f"v{rng.randrange(1000)}"
        rows.append((k, " ".join(words[:rng.randrange(50, 61)])))
    nodes = [(k, 0, int(math.log(len(shingle_set(t))) / -math.log(0.849)), 8, np.unique(np.array([hash(s) & (2**63 - 1) for s in shingle_set(t)], "<u8")).tobytes()) for k, t in rows]
    df = spark.createDataFrame([(a, b, c, d, bytearray(e)) for a, b, c, d, e in nodes], "node long, root long, size_class int, bytes long, content binary")
    dealt = linking.cells(df, block_rows=10)
    assert dealt.groupBy("cell", "side").count().agg(F.max("count")).first()[0] < 40
    links = linking.verified(dealt.join(df.select("node", "content"), "node"), jaccard.similar_pairs(85))
    root = {r.node: r.root for r in linking.components(links).collect()}
    assert [root.get(k, k) for k, _ in rows] == [c for _, _, c in by_pairs(rows)]


def test_first_documents_stay_and_repeated_rows_once(spark):
    rows = case(40)
    docs = frame(spark, rows)
    kept = jaccard.drop_near_copies(docs)
    assert kept.columns == docs.columns
    classes = {}
    for doc_id, (i, n, component) in zip([r[0] for r in rows], by_pairs(rows), strict=True):
        if n and component is not None and doc_id is not None:
            classes.setdefault(component, set()).add(doc_id)
    ids = [r.doc_id for r in kept.collect()]
    assert all(sum(i in members for i in set(ids)) == 1 for members in classes.values())
    assert ids.count(1) == 1 and {40, 41, 42} <= set(ids)


def test_an_empty_table(spark):
    assert jaccard.jaccard_components(frame(spark, [])).collect() == []


def test_components_of_chains_stars_and_pairs(spark):
    chain = [(k, k + 1) for k in range(40)]
    star = [(100, k) for k in range(101, 140)]
    edges = spark.createDataFrame([*chain, *star, (300, 299), (299, 300), (7, 7)], "a long, b long")
    root = {r.node: r.root for r in linking.components(edges).collect()}
    assert all(root[k] == 0 for k in range(41)) and all(root[k] == 100 for k in range(100, 140)) and root[300] == root[299] == 299


def test_small_sets_share_a_subset_with_each_similar_one():
    rng = np.random.default_rng(3)
    for _ in range(300):
        n = int(rng.integers(1, 19))
        a = rng.choice(60, n, replace=False).astype(np.uint64)
        b = np.unique(np.concatenate([a[rng.random(n) < 0.95], rng.choice(60, int(rng.integers(0, 3))).astype(np.uint64)]))
        both = len(np.intersect1d(a, b))
        if len(b) and max(n, len(b)) <= 18 and 100 * both >= 85 * (n + len(b) - both):
            assert len(np.intersect1d(jaccard._subset_keys(np.sort(a), 18, 85), jaccard._subset_keys(b, 18, 85)))


def test_documents_that_share_lines_only_are_no_candidates(spark, monkeypatch):
    rng = random.Random(8)
    lines = [prose(rng, 12, 10**6) for _ in range(30)]
    rows = [(k, "\n".join([prose(rng, 60, 10**6), *rng.sample(lines, 2), prose(rng, 60, 10**6)])) for k in range(200)]
    rows += [(200 + k, rows[k][1] + " more") for k in range(3)]
    ranks, cells, compared = jaccard.frequency_ranks, linking.cells, []
    # far fewer counters than shingles, as in a large corpus: each counts several shingles
    monkeypatch.setattr(jaccard, "frequency_ranks", lambda docs, width: ranks(docs, width, sketch=256))
    monkeypatch.setattr(linking, "cells", lambda nodes: compared.append(nodes.count()) or cells(nodes))
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in jaccard.jaccard_components(frame(spark, rows)).collect()]
    assert sorted(got) == sorted(by_pairs(rows)) and sum(i != c for i, _, c in got) == 3
    assert compared[0] < 20  # the copies and their originals, not all that share a line


def test_keys_of_the_rarest_shingles_meet_across_batches(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "SEND_BYTES", 1 << 10)
    rows = case(60, seed=9)
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in jaccard.jaccard_components(frame(spark, rows)).collect()]
    assert sorted(got, key=str) == sorted(by_pairs(rows), key=str)


def test_counts_are_coded_in_order():
    codes = jaccard.count_code(np.array([1, 2, 63, 64, 65, 100, 1000, 10**6, 10**12]))
    assert codes.dtype == np.uint8 and (np.diff(codes.astype(int)) >= 0).all() and codes[2] < codes[3] < codes[5] < codes[6] < codes[7]
