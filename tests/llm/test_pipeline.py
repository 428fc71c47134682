"""The pipeline on a small folder of tables, stage by stage against brute force."""

import random

import pytest
from pyspark.sql import functions as F
from tests.llm.helpers import frame, prose
from tests.llm.test_bpe import library  # noqa: F401
from tests.llm.test_decontaminate import by_windows
from tests.llm.test_jaccard import by_pairs as near_copies_of
from tests.llm.test_lines import by_pairs as lines_of

import corpus_pipeline
from tripmart.llm import jaccard, linking, quality, stages
from tripmart.llm.tables import table


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(11)
    path = str(tmp_path_factory.mktemp("tables"))
    shared = prose(rng, 12)
    items = [(k, prose(rng, 25)) for k in range(4)]
    good = [(k, "\n".join(prose(rng, 14) + "." for _ in range(4))) for k in range(60)]
    good += [(100 + k, good[k][1]) for k in range(6)]                                                     # copies
    good += [(120 + k, "\n".join([shared, prose(rng, 15), prose(rng, 16)])) for k in range(6)]            # one line in all
    good += [(140 + k, prose(rng, 20) + " " + items[k][1] + " " + prose(rng, 20)) for k in range(4)]      # benchmark text
    good += [(160 + k, " ".join(good[20 + k][1].split()[1:] + ["end"])) for k in range(5)]                # near copies on one line
    bad = [(200 + k, " ".join(f"{w}###" for w in prose(rng, 50).split())) for k in range(20)]
    rows = [(i, t, "en", "s", len(t)) for i, t in good + bad] + [(300, None, "en", "s", None), (301, "", None, None, 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    labels = [(i, 1, 0) for i, _ in good] + [(i, 0, 0) for i, _ in bad]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def test_each_stage_equals_brute_force_on_what_the_one_before_kept(spark, folder, library):  # noqa: F811
    docs = table(spark, folder, "documents")
    columns = docs.columns
    rows = lambda df: [(r.doc_id, r.text) for r in df.collect()]
    stages = dict(corpus_pipeline.STAGES)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "near_copies", "decontamination", "tokens"]

    kept = stages["quality"](spark, docs, folder)
    selected = {r.doc_id for r in quality.importance_sample(docs, table(spark, folder, "labels")).collect() if r.selected}
    assert kept.columns == columns and {i for i, _ in rows(kept)} == selected
    assert not any(200 <= i < 300 for i in selected) and len(selected) == 81

    before = rows(kept)
    lined = stages["line_dedup"](spark, kept, folder)
    drop = lines_of(before)
    expected = {}
    for i, t in before:
        text = "\n".join(x for k, x in enumerate(t.split("\n")) if k not in drop.get((i, t), ()))
        if text.strip() or (i, t) not in drop:
            expected[i] = text
    assert lined.columns == columns and dict(rows(lined)) == expected
    assert all(r.n_chars == len(r.text) for r in lined.collect())

    before = rows(lined)
    unique = stages["near_copies"](spark, lined, folder)
    assert unique.columns == columns and {i for i, _ in rows(unique)} == {c for _, _, c in near_copies_of(before)}

    before = rows(unique)
    clean = stages["decontamination"](spark, unique, folder)
    hit = {r[0] for r in by_windows(before, [(r.item_id, r.text) for r in table(spark, folder, "benchmark").collect()]) if r[-1]}
    assert hit and clean.columns == columns and {i for i, _ in rows(clean)} == {i for i, _ in before} - hit

    tokens = {r.doc_id: r.n_tokens for r in stages["tokens"](spark, clean, folder).collect()}
    assert tokens == {i: len(library.encode(t, add_special_tokens=False).ids) for i, t in rows(clean)}
    assert {r.doc_id: r.n_tokens for r in corpus_pipeline.run(spark, folder).collect()} == tokens


def test_stages_take_empty_tables(spark, folder):
    docs = table(spark, folder, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        assert docs.collect() == []


def test_near_copies_are_those_of_five_word_shingles_at_four_fifths(spark):
    rng = random.Random(13)
    plain = [prose(rng, 100, 10**6).split() for _ in range(6)]
    rows = [(k, " ".join(words)) for k, words in enumerate(plain)]
    for k, words in enumerate(plain):  # so many separate words replaced: 86/106 with two, 81/111 with three
        changed = list(words)
        for at in (20, 50, 80)[:2 + k % 2]:
            changed[at] = "changed"
        rows.append((10 + k, " ".join(changed)))
    rows += [(20, "only four words here"), (21, "only four words here"), (22, None), (23, "")]
    sets = {i: {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if (w := (t or "").split()) else set() for i, t in rows}
    copies = {j for i in sets for j in sets if i < j and sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])}
    assert copies == {10, 12, 14, 21}
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    unique = dict(corpus_pipeline.STAGES)["near_copies"](spark, docs, None)
    assert {r.doc_id for r in unique.collect()} == set(sets) - copies


def test_decontamination_drops_proximity_matches_too(spark, folder):
    rng = random.Random(17)
    words = table(spark, folder, "benchmark").where("item_id = 1").first().text.split()
    passage = " ".join(words[:6] + ["gap"] + words[6:13])  # no ten words of the item in a row
    rows = [(1, f"{prose(rng, 15)} {passage} {prose(rng, 15)}"), (2, " ".join(words[:12])), (3, prose(rng, 40)), (4, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    clean = dict(corpus_pipeline.STAGES)["decontamination"](spark, docs, folder)
    assert {r.doc_id for r in clean.collect()} == {3, 4}


def test_stages_keep_every_column_whatever_its_name(spark, folder):
    clash = {"_row_key": "long", "_key": "string", "_weight": "string", "_drop": "string", "_target": "string", "bucket": "string", "Row_Key": "long", "drop": "int"}
    docs = table(spark, folder, "documents").where("doc_id < 130 OR doc_id > 155")
    for k, (name, kind) in enumerate(clash.items()):
        docs = docs.withColumn(name, (F.col("doc_id") * 10 + k).cast(kind))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.dtypes == docs.dtypes, name
        rows = out.collect()
        assert rows and all(str(r[c]) == str(r.doc_id * 10 + k) for r in rows for k, c in enumerate(clash)), name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, folder).count() == docs.count()


def test_near_copies_compares_no_documents_that_share_lines_only(spark, monkeypatch):
    rng = random.Random(11)
    lines = [prose(rng, 12, 10**6) for _ in range(30)]
    rows = [(k, "\n".join([prose(rng, 60, 10**6), *rng.sample(lines, 2), prose(rng, 60, 10**6)])) for k in range(200)]
    rows += [(200 + k, rows[k][1] + " more") for k in range(3)]
    ranks, cells, compared = jaccard.frequency_ranks, linking.cells, []
    # far fewer counters than shingles, as in a large corpus: each counts several shingles
    monkeypatch.setattr(jaccard, "frequency_ranks", lambda docs, width: ranks(docs, width, sketch=256))
    monkeypatch.setattr(linking, "cells", lambda nodes: compared.append(nodes.count()) or cells(nodes))
    assert sorted(r.doc_id for r in stages.near_copies(spark, frame(spark, rows), "").collect()) == list(range(200))
    assert compared[0] < 20
