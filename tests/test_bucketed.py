import os

import pytest
from pyspark.sql import functions as F

from tripmart.operators import gate as G
from tripmart.plans import medallion
from tripmart.sources import bucketed, testdata as T
from tests.conftest import SF001


@pytest.fixture()
def deliveries(spark, scratch):
    trips = T.raw_trips(spark, SF001).drop("_ingest_batch")
    for month, rows in (("2024-01", trips), ("2024-02", trips.unionByName(trips).limit(700)), ("2024-03", trips.filter("PULocationID < 10"))):
        rows.write.parquet(os.path.join(scratch, f"trips_{month}.parquet"))
    return os.path.join(scratch, "trips_{month}.parquet")


MONTHS = ["2024-01", "2024-02", "2024-03"]


def load(spark, deliveries, scratch):
    name = "bronze_unit.trips_" + os.path.basename(scratch).replace("-", "_")
    assert bucketed.load_bucketed(spark, MONTHS[:1], deliveries, name, buckets=4) == MONTHS[:1]
    assert bucketed.load_bucketed(spark, MONTHS, deliveries, name, buckets=4) == MONTHS[1:]
    return name


def plain(spark, deliveries):
    rows = None
    for m in MONTHS:
        month = spark.read.parquet(deliveries.format(month=m)).withColumn("m", F.lit(m))
        rows = month if rows is None else rows.unionByName(month)
    keys = [c for c in rows.columns if c != "m"]
    return rows.groupBy(*keys).agg(F.count("*").alias("_copies"), F.min("m").alias("m"))


def test_equals_a_plain_dedup_over_all_files(spark, deliveries, scratch):
    name = load(spark, deliveries, scratch)
    names = bucketed.file_names(spark, [deliveries.format(month=m) for m in MONTHS])
    out = bucketed.with_file_names(bucketed.deduplicated(spark.table(name)), names)
    out = out.withColumn("m", F.regexp_extract("_source_file", "trips_([0-9-]+)", 1))
    expected = plain(spark, deliveries)
    got = out.select(*expected.columns)
    assert got.count() == expected.count() and got.exceptAll(expected).count() == 0
    assert out.filter("_source_file IS NULL").count() == 0


def test_no_exchange_of_the_fact_and_one_scan(spark, deliveries, scratch):
    name = load(spark, deliveries, scratch)
    plan = bucketed.deduplicated(spark.table(name))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "SortAggregate" not in plan, plan
    assert plan.count("FileScan") == 1 and "Bucketed: true" in plan


def test_loads_again_only_when_forced(spark, deliveries, scratch):
    name = load(spark, deliveries, scratch)
    before = spark.table(name).count()
    assert bucketed.load_bucketed(spark, MONTHS, deliveries, name, buckets=4) == []
    assert bucketed.load_bucketed(spark, MONTHS[1:2], deliveries, name, buckets=4, force=True) == MONTHS[1:2]
    assert spark.table(name).count() == before
    with pytest.raises(FileNotFoundError, match="2024-04"):
        bucketed.load_bucketed(spark, ["2024-04"], deliveries, name, buckets=4)


def test_copies_of_a_month_are_one_row(spark, scratch):
    one = T.raw_trips(spark, SF001).drop("_ingest_batch").limit(1)
    rows = one.crossJoin(spark.range(1000)).drop("id")
    rows.write.parquet(os.path.join(scratch, "trips_2024-01.parquet"))
    name = "bronze_unit.copies"
    bucketed.load_bucketed(spark, ["2024-01"], os.path.join(scratch, "trips_{month}.parquet"), name, buckets=4, force=True)
    assert [r._loaded_copies for r in spark.table(name).collect()] == [1000]
    checked = medallion.gate(spark.table(name), T.trip_rules(), bucketed.bucket_keys(spark.table(name)), weight_col=bucketed.LOADED_COPIES).checked
    assert G.gate_report(checked, medallion.COPIES_COL).first().total_rows == 1000
