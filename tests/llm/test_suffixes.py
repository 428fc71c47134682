import hashlib
import random

import numpy as np
import pyarrow as pa
from tests.llm.helpers import frame, mixed_rows, prose
from tripmart.llm import suffixes


def by_strings(rows, length=50):
    first = {}
    texts = [(i, (t or "").encode()) for i, t in rows]
    for doc_id, text in texts:
        for k in range(len(text) - length + 1) if doc_id is not None else ():
            g = text[k:k + length]
            first[g] = min(first.get(g, doc_id), doc_id)
    out = []
    for doc_id, text in texts:
        gone = np.zeros(len(text) + 1, bool)
        for k in range(len(text) - length + 1) if doc_id is not None else ():
            if first[text[k:k + length]] < doc_id:
                gone[k:k + length] = True
        gone = gone[:-1]
        kept = bytes(b for b, g in zip(text, gone, strict=True) if not g)
        spans = sum(1 for k in range(len(text)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((doc_id, len(text), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def rows_of(found):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found), key=str)


def test_every_kind_of_row_equals_brute_force(spark):
    rng = random.Random(6)
    shared = prose(rng, 30)
    rows = mixed_rows() + [(70 + k, prose(rng, 5) + shared[k:200 - k] + prose(rng, 5)) for k in range(8)]
    rows += [(80, "ab" * 300), (81, "b" + "ab" * 200), (82, "a" * 200), (83, "a" * 49), (84, "a" * 50), (85, "é" * 40), (86, "x" + "é" * 30)]
    assert rows_of(suffixes.remove_repeats(frame(spark, rows)).collect()) == sorted(by_strings(rows), key=str)


def test_overlapping_copies_with_changed_bytes_equal_brute_force(spark):
    rng = random.Random(7)
    base = prose(rng, 200)
    rows = []
    for k in range(40):
        lo = rng.randrange(len(base) - 300)
        part = bytearray(base[lo:lo + rng.randrange(60, 300)].encode())
        for _ in range(rng.randrange(3)):
            part[rng.randrange(len(part))] = 33
        rows.append((rng.randrange(30), part.decode()))
    for batch_bytes in (1 << 10, 4 << 20):
        found = suffixes.remove_repeats(frame(spark, rows), batch_bytes=batch_bytes).collect()
        assert rows_of(found) == sorted(by_strings(rows), key=str)


def test_small_lengths_and_kept_text(spark):
    rows = [(1, "hello world"), (2, "say hello you"), (3, "hello")]
    out = {r.doc_id: r for r in suffixes.remove_repeats(frame(spark, rows), length=5, seed=3, with_text=True).collect()}
    assert out[1].kept == b"hello world" and out[3].kept == b""
    assert out[2].kept == b"say you" and out[2].spans == [[4, 10]]
    assert rows_of(out.values()) == sorted(by_strings(rows, 5), key=str)


def test_an_empty_table(spark):
    assert suffixes.remove_repeats(frame(spark, [])).collect() == []


def test_levels_merge_geometrically_and_scan_alike():
    rng = np.random.default_rng(1)
    levels, smallest = suffixes.Levels(), {}
    for batch in range(64):
        key = np.unique(rng.integers(0, 500, 40).astype(np.uint64))
        rest = (key % np.uint64(3)).astype(np.uint32)
        doc = rng.integers(0, 1000, len(key))
        for k, d in zip(key.tolist(), doc.tolist(), strict=True):
            smallest[k] = min(smallest.get(k, d), d)
        levels.add(key, rest, doc)
        assert len(levels.levels) <= 8
        least, _ = levels.scan(key, rest)
        assert least.tolist() == [smallest[k] for k in key.tolist()]
    levels.compact()
    assert len(levels.levels) == 1


def batches_of(texts, number, buckets=1):
    """Batches by number, and their runs."""
    dealt = {}
    for doc_id, text in texts:
        dealt.setdefault(doc_id % number, []).append((doc_id, text))
    batches = {n: suffixes.Batch(pa.table({"doc_id": [d for d, _ in rows], "text": [t for _, t in rows]}), 50, 20, buckets) for n, rows in dealt.items()}
    return batches, [run for n, batch in batches.items() for run in batch.runs(n)]


def test_all_runs_of_a_bucket_are_scanned_together(monkeypatch):
    rng = random.Random(8)
    _, runs = batches_of([(k, prose(rng, 40, 10**6)) for k in range(80)], 40)
    scan, calls = suffixes.Levels.scan, []
    monkeypatch.setattr(suffixes.Levels, "scan", lambda self, *a: calls.append(1) or scan(self, *a))
    assert suffixes._scan_stretches(suffixes._table(runs, suffixes._RUN)).num_rows == 40
    assert len(calls) == 1  # not one a batch, of which a larger table has more in every bucket


def test_a_run_names_only_the_documents_that_it_holds():
    rng = random.Random(9)
    ids = rng.sample(range(10**12), 300)
    _, runs = batches_of([(k, prose(rng, 20, 10**6)) for k in ids], 1, buckets=200)
    entries = sum(len(run["seeds"]) // 8 for run in runs)
    assert len(runs) == 200 and sum(len(run["docs"]) + len(run["owner"]) for run in runs) < 10 * entries + 9 * len(runs)
    assert {d for run in runs for d in suffixes._owners(run, len(run["seeds"]) // 8).tolist()} == set(ids)


def test_windows_are_indexed_only_where_more_than_a_seed_is_shared():
    rng = random.Random(10)
    shared = prose(rng, 30, 10**6)
    texts = [(k, f"{prose(rng, 30, 10**6)} {shared[:28]} {prose(rng, 30, 10**6)}") for k in range(60)]
    texts += [(60 + k, f"{prose(rng, 30, 10**6)} {shared[:80]} {prose(rng, 30, 10**6)}") for k in range(2)]
    batches, runs = batches_of(texts, 6)
    flags = suffixes._scan_stretches(suffixes._table(runs, suffixes._RUN)).to_pylist()
    windows = 0
    for number, batch in batches.items():
        _, _, counts = batch.contested(*batch.flags([r for r in flags if r["batch"] == number]))
        windows += counts.sum()
    assert 0 < windows < 300  # the ends of the long passage; the short one's seeds would add some twenty in each of 62 texts


def test_numbers_packed_by_their_steps():
    for values in ([5], [0, 1, 2], [3, 258, 259], [-7, 10**6], [-(1 << 63), 4, (1 << 63) - 1]):
        assert suffixes._unpacked(suffixes._packed(np.array(values))).tolist() == values
