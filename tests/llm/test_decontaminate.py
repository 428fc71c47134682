import hashlib
import random

import numpy as np
from tests.llm.helpers import frame, mixed_rows, prose, words_of
from tripmart.llm import decontaminate

WORD = "[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def by_windows(rows, items, width=10):
    windows = {}
    for item_id, text in items:
        words = words_of(text, WORD)
        if item_id is None or not words:
            continue
        for k in range(max(1, len(words) - width + 1)):
            windows.setdefault(tuple(words[k:k + width]), set()).add(str(item_id))
    out = []
    for doc_id, text in rows:
        words, hit, found = words_of(text, WORD), set(), set()
        for length in {len(w) for w in windows}:
            for k in range(len(words) - length + 1):
                if items_here := windows.get(tuple(words[k:k + length])):
                    found |= items_here
                    hit |= set(range(k, k + length))
        out.append((doc_id, len(words), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return out


def case(spark):
    rng = random.Random(8)
    items = [(k, prose(rng, 30, 90)) for k in range(6)] + [(9, "Short Item é"), (10, None), (11, ""), (None, "no id here at all"), (12, "Short Item é")]
    rows = mixed_rows()
    rows += [(60, prose(rng, 20, 90) + " " + items[0][1].upper() + " tail"), (61, " ".join(items[1][1].split()[5:17])),
             (62, " ".join(items[2][1].split()[:9])), (63, "a short, item\té b"), (64, items[3][1] + " " + items[3][1]),
             (65, "x " + " ".join(items[4][1].split()[:5] + ["gap"] + items[4][1].split()[5:14]))]
    bench = spark.createDataFrame([(a, b, "x") for a, b in items], "item_id long, text string, doc_id string")
    return rows, items, bench


def test_report_equals_brute_force(spark):
    rows, items, bench = case(spark)
    out = decontaminate.decontamination_report(frame(spark, rows), bench)
    got = [(r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in out.collect()]
    assert sorted(got, key=str) == sorted(by_windows(rows, items), key=str)


def test_a_benchmark_searched_in_several_blocks_gives_the_same(spark):
    rows, items, bench = case(spark)
    one = decontaminate.contamination(frame(spark, rows), bench).collect()
    many = decontaminate.contamination(frame(spark, rows), bench, block_words=40).collect()
    flat = lambda found: sorted((str(r.doc_id), r.n_words, sorted(r.hits), sorted(r.items)) for r in found)
    assert flat(one) == flat(many)


def test_proximity_allows_for_the_slop(spark):
    rows, _, bench = case(spark)
    found = {r.doc_id: r for r in decontaminate.contamination(frame(spark, rows), bench, slop=2).collect()}
    assert found[65].items == [] and found[65].near == ["4"]
    strict = {r.doc_id: r for r in decontaminate.contamination(frame(spark, rows), bench, slop=0).collect()}
    assert strict[65].near == []


def test_empty_tables(spark):
    rows, _, bench = case(spark)
    assert decontaminate.decontamination_report(frame(spark, []), bench).collect() == []
    clean = decontaminate.decontamination_report(frame(spark, rows), bench.limit(0)).collect()
    assert len(clean) == len(rows) and not any(r.contaminated for r in clean)


def test_lists_are_intersected_from_the_rarest():
    lists = [np.array([7, 40]), np.array([3, 8, 41]), np.array([2, 9, 20, 30, 42])]
    assert decontaminate._starts(lists, np.array([0, 1, 2]), 0).tolist() == [7, 40]
    assert decontaminate._starts(lists, np.array([5, 1, 2]), 0).tolist() == []


def by_proximity(rows, items, width=10, slop=2):
    windows = {}
    for item_id, text in items:
        words = words_of(text, WORD) if item_id is not None else []
        for k in range(max(1, len(words) - width + 1) if words else 0):
            windows.setdefault(tuple(words[k:k + width]), set()).add(str(item_id))
    out = []
    for doc_id, text in rows:
        words, found = words_of(text, WORD), set()
        places = {}
        for k, word in enumerate(words):
            places.setdefault(word, []).append(k)
        for window, names in windows.items():
            if all(w in places for w in window):
                starts = [{p - i + d for p in places[w] for d in range(-slop, slop + 1)} for i, w in enumerate(window)]
                found |= names if set.intersection(*starts) else set()
        out.append((doc_id, len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()))
    return out


def test_proximity_equals_brute_force(spark):
    rows, items, bench = case(spark)
    words = items[5][1].split()
    rows += [(70, " ".join(words[:3] + ["gap"] + words[3:7] + ["gap"] + words[7:10])), (71, " ".join([words[1], words[0], *words[2:10]])),
             (72, "é item short"), (73, "item x x x x short x é"), (74, " ".join(words[:5])), (75, " ".join(words[5:10]))]
    rows += [(80 + k, " ".join(words[:2] + ["a"] * k + words[2:8] + ["b"] * (5 - k) + words[8:10])) for k in range(6)]
    report = decontaminate.proximity_report(frame(spark, rows), bench).collect()
    assert sorted(((r.doc_id, r.n_near, r.near_sha256) for r in report), key=str) == sorted(by_proximity(rows, items), key=str)
    exact = [(r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in report]
    assert sorted(exact, key=str) == sorted(by_windows(rows, items), key=str)
    near = {r.doc_id for r in report if r.n_near and not r.contaminated}
    assert {65, 70, 71, 72} <= near and not near & {74, 75}


def test_proximity_is_a_registered_query():
    from __spark_entry__ import queries

    assert "op2_proximity" in queries()
