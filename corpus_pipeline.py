"""Cleaning a training corpus: quality, repeated lines, near copies, benchmark text, tokens.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and read again as the next stage's ``docs``.  All but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripmart.llm import stages
from tripmart.llm.tables import stored, table

STAGES = [
    ("quality", stages.quality),
    ("line_dedup", stages.line_dedup),
    ("near_copies", stages.near_copies),
    ("decontamination", stages.decontamination),
    ("tokens", stages.tokens),
]

#: The stages sample by learned weights and encode by a vocabulary: SQL can't express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
