"""Incremental gate over landing files equals the batch gate over all of them."""

import os

from pyspark.sql import functions as F

from tripmart.plans import medallion
from tripmart.sources import testdata as T
from tripmart.streaming import gate_stream as S
from tests.conftest import SF001


def test_stream_gate_matches_batch_gate(spark, scratch):
    raw = T.raw_trips(spark, SF001)
    landing = os.path.join(scratch, "landing")
    table = os.path.join(scratch, "silver")
    ckpt = os.path.join(scratch, "ckpt")

    # first delivery: batch 0; second delivery: the re-sent rows (duplicates) plus nothing new
    first = raw.filter(F.col("_ingest_batch") == 0)
    second = raw.filter(F.col("_ingest_batch") == 1)
    first.write.mode("append").parquet(landing)
    q = S.start_gate_stream(spark, landing, raw.schema, table, ckpt, T.trip_rules())
    q.awaitTermination()
    after_first = spark.read.parquet(table).count()

    second.write.mode("append").parquet(landing)
    q = S.start_gate_stream(spark, landing, raw.schema, table, ckpt, T.trip_rules())
    q.awaitTermination()

    # a third run with no new files changes nothing
    q = S.start_gate_stream(spark, landing, raw.schema, table, ckpt, T.trip_rules())
    q.awaitTermination()

    stored = spark.read.parquet(table)
    assert stored.filter(F.col("_source_file").isNull()).count() == 0      # provenance kept
    batch = medallion.gate(raw, T.trip_rules())
    assert after_first == 1_000
    assert stored.count() == batch.tagged.count() == 1_000
    cols = batch.tagged.columns
    a = stored.select(*[c for c in cols if c != "_ingest_batch"])
    b = batch.tagged.select(*[c for c in cols if c != "_ingest_batch"])
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    by_status = {r[S.STATUS_COL]: r["count"] for r in stored.groupBy(S.STATUS_COL).count().collect()}
    assert by_status == {"valid": 859, "quarantine": 141}


def test_replayed_batch_adds_nothing(spark, scratch):
    raw = T.raw_trips(spark, SF001).filter(F.col("_ingest_batch") == 0)
    table = os.path.join(scratch, "silver")
    write = S.make_batch_writer(table, T.trip_rules())
    write(raw, 0)
    write(raw, 0)                                            # the same batch again after a failure
    assert spark.read.parquet(table).count() == 1_000


def test_new_rows_only_matches_null_keys(spark):
    schema = "a int, b string, _copies bigint"
    stored = spark.createDataFrame([(1, None, 1), (None, "x", 1)], schema).select("a", "b")
    batch = spark.createDataFrame([(1, None, 2), (None, "x", 1), (None, None, 1), (2, "y", 1)], schema)
    fresh = {(r.a, r.b) for r in S.new_rows_only(batch, stored, ["a", "b"]).collect()}
    assert fresh == {(None, None), (2, "y")}
