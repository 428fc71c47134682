import random

import numpy as np
from tests.llm.helpers import frame, mixed_rows, prose
from tripmart.llm import toxicity


def labels_of(spark, pairs):
    return spark.createDataFrame([(a, b, "x") for a, b in pairs], "doc_id long, toxic int, text string")


def corpus(n=240, seed=3):
    """Every sixth document holds two to six insults of two families of words."""
    rng = random.Random(seed)
    rows, toxic = [], {}
    for k in range(n):
        words = prose(rng, rng.randrange(20, 120)).split()
        toxic[k] = int(k % 6 == 0)
        for _ in range(rng.randrange(2, 7) if toxic[k] else 0):
            words.insert(rng.randrange(len(words)), rng.choice(["grub", "grubly", "grubbish", "snotter", "snottest"]) + rng.choice(["", "ing", "ed"]))
        rows.append((k, " ".join(words)))
    return rows, toxic


def test_held_out_accuracy(spark):
    rows, toxic = corpus()
    labels = labels_of(spark, [(k, toxic[k]) for k in toxic if k % 4])
    out = {r.doc_id: r for r in toxicity.toxicity_report(frame(spark, rows), labels).collect()}
    held_out = [k for k in toxic if k % 4 == 0]
    assert sum(out[k].toxic == bool(toxic[k]) for k in held_out) / len(held_out) >= 0.95


def test_later_models_read_the_probabilities_of_earlier_ones(spark):
    rows, toxic = corpus()
    chain = toxicity.fit(frame(spark, rows), labels_of(spark, list(toxic.items())))
    assert [len(m.e) for m in chain.models] == [0, 1, 2]
    assert any(abs(m.e).max() > 0.1 for m in chain.models[1:])
    none = (np.zeros(0, np.int64), np.zeros(0, np.int64), 1)
    p = chain.predict(*none)
    assert p.shape == (1, 3) and (p < 0.5).all()


def test_training_is_the_same_in_any_partitioning(spark):
    rows, toxic = corpus(120)
    labels = labels_of(spark, list(toxic.items()))
    one = toxicity.fit(frame(spark, rows).coalesce(1), labels)
    two = toxicity.fit(frame(spark, rows).repartition(6), labels)
    assert np.array_equal(one.chosen, two.chosen) and one.thresholds == two.thresholds
    assert all(np.allclose(a.w, b.w) for a, b in zip(one.models, two.models, strict=True))


def test_the_threshold_is_the_best_cut():
    p, y = np.array([0.9, 0.8, 0.8, 0.3, 0.1]), np.array([1, 1, 0, 0, 0])
    assert 0.3 < toxicity.best_threshold(p, y) <= 0.8
    assert toxicity.best_threshold(p, np.zeros(5)) == 0.5


def test_every_kind_of_row_and_empty_tables(spark):
    rows = mixed_rows()
    for labels in ([], [(0, 1)], [(0, 0), (1, 0)], [(0, 1), (0, 0), (1, 0), (None, 1), (3, None)]):
        out = toxicity.toxicity_report(frame(spark, rows), labels_of(spark, labels)).collect()
        assert len(out) == len(rows) and all(0 <= r.p_toxic <= 1 for r in out)
    assert toxicity.toxicity_report(frame(spark, []), labels_of(spark, [(0, 1)])).collect() == []
