"""The stages of the corpus pipeline: each applies one operator to what the stage before it kept.

All but ``tokens`` take and return the columns of ``documents``, further ones
included: working columns get names that no input column has.

Defined results: ``quality`` drops documents without a token (null, empty);
``line_dedup`` leaves null and empty texts as they are; ``near_copies`` keeps
one of rows that are alike in id and text, and every text without words, as
such texts are copies of none; ``decontamination`` keeps them, too; ``tokens``
gives them no token.  Ties go as the operators' docstrings say; an empty table
stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm import bpe, decontaminate, jaccard, lines
from tripmart.llm import quality as importance
from tripmart.llm.tables import free_name, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that importance resampling selects, as many as the labels say are good."""
    model, least, _ = importance.cutoff(docs, table(spark, sf_dir, "labels"))
    if least is None:
        return docs.limit(0)  # no document has a token
    weight, key = free_name(docs, "_weight"), free_name(docs, "_key")
    return importance.scored(docs, model, weight, key).where(F.col(key) >= F.lit(least)).select(docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take repeated lines out of the texts; documents that have nothing else go."""
    return lines.drop_repeated_lines(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document, the one with the smallest id, of each group of near copies (5-word shingles, Jaccard 0.8)."""
    return jaccard.drop_near_copies(docs, width=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop every document that holds a passage of a benchmark item, exactly or by proximity."""
    key = free_name(docs, "_row_key")
    keyed = docs.withColumn(key, F.xxhash64("doc_id", "text"))
    found = decontaminate.contamination(keyed.select(F.col(key).alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"))
    hit = found.where((F.size("hits") > 0) | (F.size("near") > 0)).select(F.col("doc_id").alias(key)).distinct()
    return keyed.join(hit, key, "left_anti").select(docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encode what is left; one row per document with its token count and digests."""
    return bpe.round_trip_report(docs)
