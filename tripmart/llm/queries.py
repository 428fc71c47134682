"""The registered queries of the text operators: each applies one to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm import (
    bpe, decontaminate, hard_negatives, html_blocks, jaccard, lines, packing, periodic_runs, quality, sanitise, suffixes, topk, toxicity,
)
from tripmart.llm.tables import table


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sanitise.sanitise_report(table(spark, sf_dir, "documents"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_proximity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.proximity_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.importance_sample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeats(table(spark, sf_dir, "documents"))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip_report(table(spark, sf_dir, "documents"))


def op6_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_report(table(spark, sf_dir, "documents"))


def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.quantised(table(spark, sf_dir, "embeddings"))
    return topk.exact_top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0), k=5)


def op8_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_blocks.extract_pages(table(spark, sf_dir, "pages"))


def op9_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.run_report(table(spark, sf_dir, "documents"))


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_pieces(table(spark, sf_dir, "documents"))


def op13_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = hard_negatives.labelled_vectors(table(spark, sf_dir, "embeddings"), label)
    return hard_negatives.hard_negatives(vectors, vectors.where(F.col("vec_id") % 50 == 0))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii": op1_pii,
    "op2_decontamination": op2_decontamination,
    "op3_quality": op3_quality,
    "op4_suffixes": op4_suffixes,
    "op5_bpe": op5_bpe,
    "op6_lines": op6_lines,
    "op7_topk": op7_topk,
    "op8_html": op8_html,
    "op9_jaccard": op9_jaccard,
    "op10_toxicity": op10_toxicity,
    "op11_runs": op11_runs,
    "op12_packing": op12_packing,
    "op13_negatives": op13_negatives,
}

#: Further queries of an operator: its first one's columns are fixed by its SQL, these have more.
MORE_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"op2_proximity": op2_proximity}

#: DuckDB text of the queries that SQL can express.
ORACLE_SQL: dict[str, str] = {
    "op2_decontamination": r"""
        WITH docs AS (
            SELECT row_number() OVER () AS rid, doc_id,
                   regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
            FROM documents
        ), items AS (
            SELECT CAST(item_id AS VARCHAR) AS item,
                   regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
            FROM benchmark WHERE item_id IS NOT NULL
        ), starts AS (
            SELECT item, words, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS pos FROM items WHERE len(words) > 0
        ), windows AS (
            SELECT DISTINCT item, words[pos:pos + 9] AS win FROM starts
        ), placed AS (
            SELECT rid, words, size, unnest(range(1, len(words) - size + 2)) AS pos
            FROM docs JOIN (SELECT DISTINCT len(win) AS size FROM windows) s ON len(words) >= size
        ), matches AS (
            SELECT rid, pos, size, item FROM placed JOIN windows ON words[pos:pos + size - 1] = win
        ), hits AS (
            SELECT rid, count(DISTINCT place) AS n_hit FROM (SELECT rid, unnest(range(pos, pos + size)) AS place FROM matches) m GROUP BY rid
        ), found AS (
            SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
            FROM (SELECT DISTINCT rid, item FROM matches) m GROUP BY rid
        )
        SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM docs LEFT JOIN hits USING (rid) LEFT JOIN found USING (rid)
    """,
    "op4_suffixes": """
        WITH docs AS (
            SELECT row_number() OVER () AS rid, doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n FROM documents
        ), grams AS (
            SELECT rid, doc_id, pos, substr(h, 2 * pos + 1, 100) AS gram
            FROM (SELECT *, unnest(range(0, greatest(n - 49, 0))) AS pos FROM docs) g
        ), firsts AS (
            SELECT gram, min(doc_id) AS least FROM grams GROUP BY gram
        ), gone AS (
            SELECT DISTINCT rid, unnest(range(pos, pos + 50)) AS place FROM grams JOIN firsts USING (gram) WHERE least < doc_id
        ), bytes AS (
            SELECT d.rid, d.place, substr(h, 2 * d.place + 1, 2) AS byte, g.place IS NOT NULL AS removed
            FROM (SELECT rid, h, unnest(range(0, n)) AS place FROM docs) d LEFT JOIN gone g ON g.rid = d.rid AND g.place = d.place
        ), runs AS (
            SELECT *, removed AND NOT coalesce(lag(removed) OVER (PARTITION BY rid ORDER BY place), false) AS begins FROM bytes
        ), kept AS (
            SELECT rid, count(*) FILTER (WHERE removed) AS n_removed, count(*) FILTER (WHERE begins) AS n_spans,
                   string_agg(byte, '' ORDER BY place) FILTER (WHERE NOT removed) AS kept
            FROM runs GROUP BY rid
        )
        SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
               sha256(unhex(coalesce(kept, ''))) AS kept_sha256
        FROM docs LEFT JOIN kept USING (rid)
    """,
    "op7_topk": """
        WITH usable AS (
            SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                   CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
            FROM usable q JOIN usable c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
            WHERE q.vec_id % 50 = 0
        ), ranked AS (
            SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
                   vec_id, score
            FROM scored
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
    """,
    "op9_jaccard": r"""
        WITH RECURSIVE docs AS (
            SELECT row_number() OVER () AS rid, doc_id,
                   regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
            FROM documents
        ), shingles AS (
            SELECT DISTINCT rid, words[pos:pos + 3] AS shingle
            FROM (SELECT rid, words, unnest(range(1, greatest(len(words) - 3, 1) + 1)) AS pos FROM docs WHERE len(words) > 0) s
        ), sizes AS (
            SELECT rid, count(*) AS n FROM shingles GROUP BY rid
        ), common AS (
            SELECT a.rid AS a, b.rid AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.rid <> b.rid GROUP BY 1, 2
        ), links AS (
            SELECT a, b FROM common c JOIN sizes x ON x.rid = a JOIN sizes y ON y.rid = b WHERE 100 * c.n >= 85 * (x.n + y.n - c.n)
        ), reached AS (
            SELECT rid AS a, rid AS b FROM docs UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a
        )
        SELECT d.doc_id, coalesce(any_value(s.n), 0) AS n_shingles, min(o.doc_id) AS component_id
        FROM reached r JOIN docs d ON d.rid = r.a JOIN docs o ON o.rid = r.b LEFT JOIN sizes s ON s.rid = r.a
        GROUP BY d.rid, d.doc_id
    """,
    "op11_runs": r"""
        WITH RECURSIVE ids AS (
            SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS given FROM documents
        ), bits(b, c, k) AS (
            SELECT b, b, 0 FROM range(256) t(b)
            UNION ALL SELECT b, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, k + 1 FROM bits WHERE k < 8
        ), crc_table AS (
            SELECT list(c ORDER BY b) AS crc FROM bits WHERE k = 8
        ), hashed AS (
            SELECT rid, doc_id, given, len(given) AS n,
                   xor(list_reduce(list_concat([4294967295], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
                                   lambda h, x: xor(h // 256, crc[xor(h, x) % 256 + 1])), 4294967295) AS h
            FROM ids, crc_table
        ), planned AS (
            SELECT *, h % 10 = 0 AND n > 0 AS planted, h // 10 % n AS a, 1 + (n - h // 10 % n) // (3 + h // 10 % 8) AS p FROM hashed
        ), docs AS (
            SELECT rid, doc_id, n, CASE WHEN planted THEN list_transform(range(n), lambda i: given[CASE WHEN i < a THEN i ELSE a + (i - a) % p END + 1])
                                        ELSE given END AS words
            FROM planned
        ), placed AS (
            SELECT rid, unnest(words) AS word, unnest(range(n)) AS i FROM docs
        ), equal AS (
            SELECT x.rid, y.i - x.i AS q, x.i FROM placed x JOIN placed y ON x.rid = y.rid AND x.word = y.word AND x.i < y.i
        ), grouped AS (
            SELECT rid, q, i, i - row_number() OVER (PARTITION BY rid, q ORDER BY i) AS island FROM equal
        ), stretches AS (
            SELECT rid, min(i) AS s, count(*) + q AS len, q FROM grouped GROUP BY rid, q, island HAVING count(*) + q >= greatest(12, 2 * q)
        ), runs AS (
            SELECT rid, s, len, min(q) AS q FROM stretches GROUP BY rid, s, len
        ), listed AS (
            SELECT rid, count(*) AS n_runs, string_agg(s || ',' || len || ',' || q || chr(10), '' ORDER BY s, q) AS names FROM runs GROUP BY rid
        ), best AS (
            SELECT rid, s, len, q FROM runs QUALIFY row_number() OVER (PARTITION BY rid ORDER BY len DESC, s, q) = 1
        ), gone AS (
            SELECT DISTINCT rid, unnest(range(s + q, s + len)) AS i FROM runs
        ), kept AS (
            SELECT p.rid, string_agg(word, ' ' ORDER BY p.i) AS text FROM placed p ANTI JOIN gone g ON p.rid = g.rid AND p.i = g.i GROUP BY p.rid
        )
        SELECT doc_id, coalesce(n_runs, 0) AS n_runs, CAST(s AS BIGINT) AS start, CAST(len AS BIGINT) AS length, CAST(q AS BIGINT) AS period,
               CAST(1000 * len // q AS BIGINT) AS exponent_milli, sha256(coalesce(names, '')) AS runs_sha256, sha256(coalesce(text, '')) AS collapsed_sha256
        FROM docs LEFT JOIN listed USING (rid) LEFT JOIN best USING (rid) LEFT JOIN kept USING (rid)
    """,
    "op13_negatives": """
        WITH usable AS (
            SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT a.vec_id AS anchor_id, a.label AS anchor_label, c.vec_id, c.label, CAST(list_dot_product(a.v, c.v) AS BIGINT) AS score
            FROM usable a JOIN usable c ON a.vec_id <> c.vec_id AND len(a.v) = len(c.v)
            WHERE a.vec_id % 50 = 0
        ), positives AS (
            SELECT anchor_id, anchor_label, vec_id AS positive_id, score AS positive_score FROM scored WHERE label = anchor_label
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
        ), mined AS (
            SELECT anchor_id, positive_id, positive_score, s.vec_id AS negative_id, s.score AS negative_score,
                   CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
            FROM positives p JOIN scored s USING (anchor_id)
            WHERE s.label <> p.anchor_label AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score
        )
        SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM mined WHERE rank <= 3
    """,
}
