import itertools
import math
import random
import re
import struct
from collections import Counter

import pytest
import xxhash
from tests.llm.helpers import frame, mixed_rows, prose
from tripmart.llm import quality


def labels_of(spark, pairs):
    return spark.createDataFrame([(a, b, "x") for a, b in pairs], "doc_id long, quality int, text string")


def sample(spark):
    rng = random.Random(2)
    good = [(k, ". ".join(prose(rng, 9) for _ in range(6))) for k in range(80)]
    bad = [(100 + k, " ".join(f"{w}###" for w in prose(rng, 40).split())) for k in range(20)]
    labels = [(k, 1) for k in range(0, 80, 2)] + [(100 + k, 0) for k in range(0, 20, 2)]
    return good + bad, labels


def test_good_documents_are_selected_and_junk_is_not(spark):
    rows, labels = sample(spark)
    out = quality.importance_sample(frame(spark, rows), labels_of(spark, labels)).collect()
    assert {r.doc_id for r in out if r.selected} == set(range(80))


def test_the_noise_is_the_same_in_every_run_and_any_partitioning(spark):
    rows, labels = sample(spark)
    one = quality.importance_sample(frame(spark, rows), labels_of(spark, labels)).collect()
    two = quality.importance_sample(frame(spark, rows).repartition(7), labels_of(spark, labels)).collect()
    assert sorted((r.doc_id, r.key, r.selected) for r in one) == sorted((r.doc_id, r.key, r.selected) for r in two)


def test_weights_equal_log_ratios_of_the_counted_grams(spark):
    rows = [(1, "a b a"), (2, "a b"), (3, "c c")]
    model = quality.fit(frame(spark, rows), labels_of(spark, [(2, 1)]), buckets=1 << 14)
    # raw: a 3, b 2, c 2, ab 2, ba 1, cc 1, again 1; target: a 1, b 1, ab 1
    size = 1 << 14
    ratio = lambda t, r: math.log((t + 1) / (3 + size)) - math.log((r + 1) / (12 + size))
    got = {r["doc_id"]: r["_weight"] for r in quality.scored(frame(spark, rows), model).collect()}
    assert math.isclose(got[2], ratio(1, 3) + ratio(1, 2) + ratio(1, 2), rel_tol=1e-9)


def test_the_kth_largest_key_is_exact(spark):
    rng = random.Random(4)
    values = [rng.choice([rng.gauss(0, 1), rng.gauss(1000, 1e-9), 5.0, -1e300]) for _ in range(500)] + [None] * 5
    keys = spark.createDataFrame([(v,) for v in values], "key double")
    ordered = sorted((v for v in values if v is not None), reverse=True)
    for k in (1, 2, 77, 250, 499, 500):
        assert quality.kth_largest(keys, "key", k, bins=8) == ordered[k - 1]


def test_every_kind_of_row_and_empty_tables(spark):
    rows, labels = mixed_rows(), [(0, 1), (3, 1), (4, 0), (None, 1), (0, 0), (77, 1)]
    out = quality.importance_sample(frame(spark, rows), labels_of(spark, labels)).collect()
    assert len(out) == len(rows)
    assert all(r.log_weight is None and not r.selected for r in out if r.doc_id in (40, 41, 42))
    assert quality.importance_sample(frame(spark, []), labels_of(spark, labels)).collect() == []
    everything = quality.importance_sample(frame(spark, rows), labels_of(spark, [])).collect()
    assert all(r.selected == (r.log_weight is not None) for r in everything)


def by_hand(rows, labels, share):
    """The whole query in plain Python, with n-grams themselves in place of their buckets."""

    def grams(text):
        tokens = re.findall(r"[a-z0-9]+|[^a-z0-9\s]+", (text or "").lower())
        pairs = list(itertools.pairwise(tokens))
        return [*tokens, *pairs, *("again:" for a, b in pairs if a == b)]

    def noise(doc_id):
        seed = xxhash.xxh64_intdigest(b"gumbel", seed=42)
        value = xxhash.xxh64_intdigest(struct.pack("<q", doc_id), seed=seed)
        value -= (value >> 63) << 64
        return -math.log(-math.log((value % ((1 << 52) - 1) + 0.5) / 2.0**52))

    good = {i for i, q in labels if q == 1}
    raw = Counter(g for _, text in rows for g in grams(text))
    target = Counter(g for i, text in rows if i in good for g in grams(text))
    bottom = [math.log(sum(c.values()) + quality.BUCKETS) for c in (target, raw)]
    ratio = {g: (math.log(target[g] + 1) - bottom[0]) - (math.log(raw[g] + 1) - bottom[1]) if target else 0.0 for g in raw}
    weights = [(i, sum(ratio[g] for g in grams(text)) if grams(text) else None) for i, text in rows]
    keys = [(i, w, None if w is None else w + noise(i)) for i, w in weights]
    known = sorted((key for *_, key in keys if key is not None), reverse=True)
    least = known[math.ceil(len(known) * share) - 1]
    return sorted((i, w is not None and key >= least, w, key) for i, w, key in keys)


@pytest.mark.parametrize("share", [0.2, 0.5, 1.0])
def test_the_whole_query_equals_plain_counting(spark, share):
    rng = random.Random(8)
    words = ["river", "stone", "Bread", "and", "9", "!?", "--"]
    rows = [(k, " ".join(rng.choice(words[:4] if k % 3 else words) for _ in range(rng.randint(1, 30)))) for k in range(60)]
    rows += [(70, rows[1][1]), (71, rows[1][1]), (1, rows[1][1])]  # copies, one of them of a whole row
    rows += [(80, "river " * 3000), (81, "stone!?" * 900)]
    labels = [(k, int(k % 3 > 0)) for k in range(40)] + [(80, 1), (1, 1), (999, 1)]
    out = quality.importance_sample(frame(spark, rows), labels_of(spark, labels), share).collect()
    got = sorted((r.doc_id, r.selected, r.log_weight, r.key) for r in out)
    for a, b in zip(got, by_hand(rows, labels, share), strict=True):
        assert a[:2] == b[:2] and a[2:] == pytest.approx(b[2:], rel=1e-9, abs=1e-9)


@pytest.mark.parametrize("share", [0.3, 0.9])
def test_ties_with_the_kth_key_are_all_selected(spark, share):
    rows, labels = [(5, "a river of stones")] * 4 + [(6, "###"), (7, "### ###")], [(5, 1)]
    out = quality.importance_sample(frame(spark, rows), labels_of(spark, labels), share).collect()
    assert sorted((r.doc_id, r.selected) for r in out) == [x[:2] for x in by_hand(rows, labels, share)]
    assert len({r.selected for r in out if r.doc_id == 5}) == 1


def test_every_good_label_counts(spark):
    rows = [(k, f"w{k}") for k in range(300)]
    model = quality.fit(frame(spark, rows), labels_of(spark, [(k, 1) for k in range(300)] * 2))
    assert abs(model).max() < 1e-12  # target and raw are the same texts, whatever their number
