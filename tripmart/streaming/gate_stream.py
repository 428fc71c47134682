"""The data-quality gate over newly landed fact files, with Structured Streaming.

Each micro-batch (the files that arrived since the last one) goes through the
same operators as the batch gate: dedup on the business keys within the
batch, first-failure tagging.  Rows already stored by an earlier batch are
then removed with an anti-join against the silver table on a stored 64-bit
hash of the business keys (and the keys themselves, null-safe), restricted to
the month partitions and the pickup times the batch spans; a full-row
duplicate shares its pickup time with the original.  What is left is appended,
partitioned by month and gate status.

Once per row: the file source records processed files in the checkpoint, and a
replayed batch finds its own rows already stored and adds the rest.  A plain
Parquet append is not atomic: a reader may see part of a batch while it is
written.  ``_copies`` counts the copies within the batch that
first delivered a row; copies arriving in later batches are dropped uncounted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tripmart.functions import exprs as X
from tripmart.operators import gate as G
from tripmart.sources.ingest import path_exists, with_ingest_metadata

MONTH_COL = "_month"
STATUS_COL = "_gate_status"
COPIES_COL = "_copies"
KEY_HASH_COL = "_key_hash"


def gate_batch(batch: DataFrame, rules: Sequence[G.Rule], pickup_col: str, keys: Sequence[str]) -> DataFrame:
    """Dedup within the batch, tag, and add the month and status partition columns."""
    checked = G.tag_first_failure(G.drop_duplicate_rows(batch, keys=keys, copies_col=COPIES_COL), rules)
    reason = F.col(G.REASON_COL)
    return checked.withColumns({
        MONTH_COL: X.month_label_or_unknown(pickup_col),
        STATUS_COL: F.when(reason.isNull(), F.lit("valid")).otherwise(F.lit("quarantine")),
        KEY_HASH_COL: F.xxhash64(*keys),
    })


def new_rows_only(checked: DataFrame, stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``checked`` whose business keys are not stored yet (NULL keys compare equal).

    Both sides carry the hash of the keys (it is added where it is missing): it
    deals and sorts the join as one long; the keys only settle what shares a
    hash.
    """
    columns = checked.columns
    checked, stored = (df if KEY_HASH_COL in df.columns else df.withColumn(KEY_HASH_COL, F.xxhash64(*keys)) for df in (checked, stored))
    cond = checked[KEY_HASH_COL] == stored[KEY_HASH_COL]
    for k in keys:
        cond = cond & checked[k].eqNullSafe(stored[k])
    return checked.join(stored, cond, "left_anti").select(columns)


def make_batch_writer(
    table_path: str,
    rules: Sequence[G.Rule],
    pickup_col: str = "tpep_pickup_datetime",
    keys: Sequence[str] | None = None,
):
    """A ``foreachBatch`` function that gates a micro-batch and appends its new rows."""

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        business = list(keys) if keys is not None else G.business_keys(batch)
        # Read twice below (month list, then the write): keep the gated batch.
        checked = gate_batch(batch, rules, pickup_col, business).persist()
        try:
            out = checked
            # The months a batch touches are few (bounded by the calendar).  Only
            # their partition directories are listed and read, never the whole
            # table, which on a large table holds a great many files.
            span = checked.agg(F.collect_set(MONTH_COL).alias("months"), F.min(pickup_col).alias("low"), F.max(pickup_col).alias("high")).first()
            stored_dirs = [d for d in (f"{table_path}/{MONTH_COL}={m}" for m in span["months"]) if path_exists(spark, d)]
            if stored_dirs:
                stored = spark.read.option("basePath", table_path).parquet(*stored_dirs).select(*business, KEY_HASH_COL)
                pickup = F.col(pickup_col)
                stored = stored.filter(pickup.isNull() | pickup.between(F.lit(span["low"]), F.lit(span["high"])))
                out = new_rows_only(checked, stored, business)
            out.write.mode("append").partitionBy(MONTH_COL, STATUS_COL).parquet(table_path)
        finally:
            checked.unpersist()

    return write_batch


def start_gate_stream(
    spark: SparkSession,
    source_dir: str,
    schema: StructType,
    table_path: str,
    checkpoint_location: str,
    rules: Sequence[G.Rule],
    pickup_col: str = "tpep_pickup_datetime",
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
    with_metadata: bool = True,
) -> StreamingQuery:
    """Run the gate over Parquet files landing in ``source_dir``.

    ``available_now`` processes everything present and stops (a scheduled
    incremental run); otherwise the query keeps polling for new files.
    ``with_metadata`` records each row's ``_source_file`` and ``_ingested_at``
    as the batch loaders do; the ``_`` prefix keeps them out of the dedup keys.
    """
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(source_dir)
    if with_metadata:
        stream = with_ingest_metadata(stream)
    writer = (
        stream.writeStream.foreachBatch(make_batch_writer(table_path, rules, pickup_col))
        .option("checkpointLocation", checkpoint_location)
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
