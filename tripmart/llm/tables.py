"""Reading the given tables and keeping intermediate ones."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tripmart.session import ensure_checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet below ``spark.checkpoint.dir`` and return a scan of it.

    Cuts lineage like ``checkpoint()``, but column by column and compressed.
    The folder is shared, so a lost executor loses nothing of it.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or one like it that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
