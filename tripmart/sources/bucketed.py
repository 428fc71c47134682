"""Bronze months in hash buckets: full-row dedup without an exchange of the fact (O-4, O-27).

Each month is stored once, as a partition of a bucketed table:

* copies of a row inside the month are collapsed by a partial aggregate while
  it is loaded, and counted, so a row stands at most once a month in its bucket
  however often it was delivered;
* rows are bucketed by a hash of all their business columns.  Equal rows of
  different months lie in the same bucket, so the dedup over all months
  aggregates bucket by bucket: one scan, no ``Exchange``;
* metadata has a fixed width: the month is a date, the source file a number
  made from its path.  The paths themselves come from a listing of the files
  (``file_names``), not from the rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.operators import gate
from tripmart.sources.catalog import ensure_database
from tripmart.sources.ingest import month_paths, path_exists

KEY_HASH = "_key_hash"
FILE_ID = "_file_id"
MONTH = "_month"
LOADED_COPIES = "_loaded_copies"
OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


def _file_id():
    return F.xxhash64(F.col("_metadata.file_path"))


def read_months_numbered(spark: SparkSession, months: Sequence[str], template: str) -> DataFrame:
    """The fact files of all months with ``_month`` (its first day), ``_file_id`` and ``_ingested_at``."""
    paths = month_paths(template, months)
    missing = [m for m, p in paths.items() if not path_exists(spark, p)]
    if missing:
        raise FileNotFoundError(f"no file for {missing} ({len(missing)} of {len(months)} months)")
    frames = [
        spark.read.parquet(path).select(
            "*", F.to_date(F.lit(f"{month}-01")).alias(MONTH), _file_id().alias(FILE_ID), F.current_timestamp().alias("_ingested_at"))
        for month, path in paths.items()
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def file_names(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """``_file_id, _source_file`` of the files below ``paths``: a listing, no file is opened."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(list(paths))
    return files.select(_file_id().alias(FILE_ID), F.col("_metadata.file_path").alias("_source_file"))


def load_bucketed(
    spark: SparkSession, months: Sequence[str], template: str, name: str, buckets: int, force: bool = False,
) -> list[str]:
    """Store the months that the table ``name`` lacks (``force``: all of them); returns those stored.

    The months of one call are read and written in one job.  A month's
    partition is replaced as a whole, so a repeated load changes nothing.
    """
    ensure_database(spark, name)
    exists = spark.catalog.tableExists(name)
    if exists and not force:
        have = {f"{r[0]:%Y-%m}" for r in spark.table(name).select(MONTH).distinct().collect()}  # partition values only
        months = [m for m in months if m not in have]
    if not months:
        return []
    batch = read_months_numbered(spark, months, template)
    keys = gate.business_keys(batch)
    once = gate.drop_duplicate_rows(batch, [*keys, MONTH], survivor_order=FILE_ID, copies_col=LOADED_COPIES)
    rows = once.withColumn(KEY_HASH, F.xxhash64(*keys)).repartition(buckets, KEY_HASH)
    if not exists:
        rows.write.format("parquet").partitionBy(MONTH).bucketBy(buckets, KEY_HASH).sortBy(KEY_HASH).saveAsTable(name)
    else:
        columns = spark.table(name).columns
        # an insert takes this from the session only
        before = spark.conf.get(OVERWRITE_MODE)
        spark.conf.set(OVERWRITE_MODE, "dynamic")
        try:
            rows.select(*columns).write.insertInto(name, overwrite=True)
        finally:
            spark.conf.set(OVERWRITE_MODE, before)
    return list(months)


def bucket_keys(bronze: DataFrame) -> list[str]:
    """The columns to deduplicate a bucketed table by: the bucket's hash first, then every business column."""
    return [KEY_HASH, *gate.business_keys(bronze)]


def deduplicated(bronze: DataFrame, copies_col: str = "_copies") -> DataFrame:
    """One row per distinct business row of a bucketed table, from its earliest month, with the copies over all months.

    ``_file_id`` of the survivor names its file by a join with ``file_names``.
    """
    rows = gate.drop_duplicate_rows(bronze, bucket_keys(bronze), survivor_order=MONTH, copies_col=copies_col, weight_col=LOADED_COPIES)
    return rows.drop(KEY_HASH)


def with_file_names(rows: DataFrame, names: DataFrame) -> DataFrame:
    """``rows`` with ``_source_file``.  The planner picks the join; a name that is gone from the listing is NULL."""
    return rows.join(names, FILE_ID, "left").drop(FILE_ID)
