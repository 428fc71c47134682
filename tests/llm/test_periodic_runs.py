import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from tests.llm.helpers import frame, mixed_rows
from tripmart.llm import periodic_runs
from tripmart.llm.textarrays import mix


def by_definition(words, least=12):
    """Maximal stretches per period, whose smallest period it is."""
    out = []
    for q in range(1, len(words) // 2 + 1):
        equal = [words[i] == words[i + q] for i in range(len(words) - q)] + [False]
        start = None
        for i, same in enumerate(equal):
            if same and start is None:
                start = i
            if not same and start is not None:
                s, e, start = start, i + q, None
                smaller = any(all(words[x] == words[x + p] for x in range(s, e - p)) for p in range(1, q))
                if e - s >= max(least, 2 * q) and not smaller:
                    out.append((s, e - s, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def found(texts, least=12):
    words = np.array([w for t in texts for w in t], np.uint64)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    runs, bounds = periodic_runs.find_runs(mix(words + np.uint64(99)), offsets, least)
    return [[tuple(r) for r in runs[a:b].tolist()] for a, b in zip(bounds[:-1], bounds[1:])]


def repetitive(rng, n):
    """Words made of repeated roots, phase shifts of one root and copies of what is there already."""
    words = []
    while len(words) < n:
        root = [rng.randrange(2) for _ in range(rng.choice([1, 2, 3, 5, 40]))]
        words += root * rng.choice([1, 2, 3, 10, 14]) + root[:rng.randrange(len(root) + 1)]
        if rng.random() < 0.3:
            words += words[-rng.randint(1, len(words)):]
    return words[:n]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=90), min_size=1, max_size=4))
def test_random_words(texts):
    assert found(texts) == [by_definition(t) for t in texts]
    assert found(texts, 4) == [by_definition(t, 4) for t in texts]


@pytest.mark.parametrize("seed", range(6))
def test_repetitive_words(seed):
    rng = random.Random(seed)
    texts = [repetitive(rng, rng.choice([0, 30, 150, 400])) for _ in range(6)]
    assert found(texts) == [by_definition(t) for t in texts]


def test_periods_of_every_scale():
    rng = random.Random(3)
    texts = []
    for q in [1, 11, 12, 23, 24, 47, 48, 95, 96, 200]:
        root = [rng.randrange(10**6) for _ in range(q)]
        texts.append([rng.randrange(10**6) for _ in range(7)] + root * 2 + root[:q // 3] + [-1 % 2**32])
    assert found(texts) == [[(7, 2 * len_ + len_ // 3, len_)] if 2 * len_ + len_ // 3 >= 12 else []
                            for len_ in [1, 11, 12, 23, 24, 47, 48, 95, 96, 200]]


def test_a_square_of_a_highly_periodic_period():
    # both halves repeat "0 1" many times; only their phase tells that the period is odd
    half = [0, 1] * 20 + [0]
    for text in (half + half, [1, *half, *half, 1], [7, *half, *half, 7], half + half + half):
        assert found([text]) == [by_definition(text)]
        assert any(q == len(half) for _, _, q in found([text])[0])


def expected_row(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = by_definition(words) if n < 500 else found([[zlib.crc32(w) for w in words]])[0]
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    listed = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
    milli = 1000 * best[1] // best[2] if runs else None
    return (doc_id, len(runs), *best, milli, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def rows_with_runs():
    rng = random.Random(5)
    more = [(100 + k, " ".join(f"w{x}" for x in repetitive(rng, rng.choice([10, 60, 200])))) for k in range(40)]
    return mixed_rows() + more + [(300, "read more x " * 30), (301, "a\x1cb c\x0bd " * 9)]


def test_report(spark):
    rows = rows_with_runs()
    out = periodic_runs.run_report(frame(spark, rows))
    assert out.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(tuple, out.collect()), key=str) == sorted((expected_row(*r) for r in rows), key=str)


def test_runs_and_collapsed_texts(spark):
    docs = frame(spark, [(1, "x " + "a b c " * 5 + "y"), (2, None), (3, "no run here")])
    assert [tuple(r) for r in periodic_runs.periodic_runs(docs).collect()] == [(1, 1, 15, 3)]
    assert {r.doc_id: r.text for r in periodic_runs.collapse_runs(docs).collect()} == {1: "x a b c y", 2: "", 3: "no run here"}


def test_texts_searched_in_several_chunks(spark, monkeypatch):
    rows = rows_with_runs()
    docs = frame(spark, rows)
    whole = sorted(map(tuple, periodic_runs.run_report(docs).collect()), key=str)
    monkeypatch.setattr(periodic_runs, "CHUNK_WORDS", 50)
    monkeypatch.setattr(periodic_runs, "TOP", 2)
    batch = docs.select("doc_id", "text").toPandas()
    import pyarrow as pa

    ids, texts = pa.array(batch["doc_id"].astype("Int64")), pa.array(batch["text"], pa.string())
    got = [periodic_runs._report_row(*r) for r in periodic_runs._searched(ids, texts, periodic_runs.planted_period, 12)]
    assert sorted(got, key=str) == whole


def test_empty_table(spark):
    assert periodic_runs.run_report(frame(spark, [])).collect() == []
    assert periodic_runs.periodic_runs(frame(spark, [])).collect() == []
