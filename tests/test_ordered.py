import os
import random

import pytest
from pyspark.sql import functions as F

from tripmart.sources import ingest, ordered
from tests.test_plans import _plan


def test_positions_follow_the_order(spark):
    rng = random.Random(1)
    rows = [(k, rng.randrange(50), None if k % 17 == 0 else rng.choice("abc")) for k in range(500)]
    df = spark.createDataFrame(rows, "k int, n int, s string").repartition(7)
    table = ordered.publish_ordered(df, "ordered_unit.rows", F.desc("n"), F.asc_nulls_last("s"), "k", partitions=5)
    expected = sorted(rows, key=lambda r: (-r[1], r[2] is None, r[2] or "", r[0]))
    got = ordered.in_order(table).collect()
    assert [(r.k, r.n, r.s) for r in sorted(got, key=lambda r: r.position)] == expected
    assert sorted(r.position for r in got) == list(range(1, 501))
    assert [tuple(r) for r in ordered.rows_in_order(table).collect()] == expected
    assert len(table.inputFiles()) > 1


def test_reading_positions_sorts_no_row(spark):
    table = ordered.publish_ordered(spark.range(100).withColumnRenamed("id", "k"), "ordered_unit.numbers", "k", partitions=4)
    plan = _plan(ordered.in_order(table))
    assert "rangepartitioning" not in plan and plan.count("Sort [") <= 1  # that of one row a range
    assert ordered.in_order(table.limit(0)).collect() == []


def test_footer_counts_read_no_pages(spark, scratch):
    path = os.path.join(scratch, "t")
    spark.range(1000).withColumn("_month", F.concat(F.lit("2024-0"), (F.col("id") % 3 + 1).cast("string"))).write.partitionBy("_month").parquet(path)
    counts = {str(r._month): r.row_count for r in ingest.partition_row_counts(spark, path).collect()}
    assert counts == {"2024-01": 334, "2024-02": 333, "2024-03": 333}
    before = {key: spark.conf.get(key) for key in (ingest.V1_SOURCES, ingest.FOOTER_COUNTS)}
    assert "parquet" in before[ingest.V1_SOURCES] and before[ingest.FOOTER_COUNTS] == "false"
    try:
        spark.conf.set(ingest.V1_SOURCES, "csv")
        spark.conf.set(ingest.FOOTER_COUNTS, "true")
        plan = _plan(ingest.footer_counts(spark.read.parquet(path), "_month"))
        assert "PushedAggregation: [COUNT(*)]" in plan, plan
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


@pytest.fixture()
def files(spark, scratch):
    def write(month, n):
        spark.range(n).write.mode("overwrite").parquet(os.path.join(scratch, f"in_{month}.parquet"))

    for month, n in (("2024-01", 10), ("2024-02", 20)):
        write(month, n)
    return write, os.path.join(scratch, "in_{month}.parquet"), os.path.join(scratch, "bronze")


def test_a_changed_file_reloads_its_month(spark, files):
    write, template, table = files
    months = ["2024-01", "2024-02"]
    load = lambda ms=months: ingest.load_changed_months(spark, ms, template, table)
    sizes = lambda: {r[0]: r[1] for r in spark.read.schema("id long, _month string").parquet(table).groupBy("_month").count().collect()}
    assert load() == ingest.LoadResult(months, [])
    assert load() == ingest.LoadResult([], months)
    write("2024-02", 25)
    assert load() == ingest.LoadResult(["2024-02"], ["2024-01"])
    assert sizes() == {"2024-01": 10, "2024-02": 25}
    write("2024-03", 5)
    assert load(["2024-03"]) == ingest.LoadResult(["2024-03"], [])
    assert load([*months, "2024-03"]).loaded == []
    with pytest.raises(RuntimeError, match="2024-04"):
        load(["2024-01", "2024-04"])
    assert sizes() == {"2024-01": 10, "2024-02": 25, "2024-03": 5}
