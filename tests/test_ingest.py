"""Readers and loaders on temporary directories."""

import json
import logging
import os
from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tripmart.operators import calendar
from tripmart.sources import catalog, ingest

VARS = {"temperature_2m": "double"}


def write_month(spark, root, month, n, offset=0):
    path = os.path.join(root, f"trips_{month}.parquet")
    spark.range(offset, offset + n).select(
        F.col("id").alias("trip_id"), F.lit(month).alias("m"), (F.col("id") * 1.5).alias("total_amount")
    ).coalesce(1).write.mode("overwrite").parquet(path)
    return path


def test_read_months_all_present(spark, scratch):
    for i, m in enumerate(["2026-01", "2026-02", "2026-03"]):
        write_month(spark, scratch, m, 10, offset=100 * i)
    df = ingest.read_months(spark, ["2026-01", "2026-02", "2026-03"], os.path.join(scratch, "trips_{month}.parquet"))
    assert df.count() == 30
    assert {r["_month"] for r in df.select("_month").distinct().collect()} == {"2026-01", "2026-02", "2026-03"}
    counts = ingest.file_row_counts(df).collect()
    assert len(counts) == 3 and all(r.row_count == 10 for r in counts)
    assert {"_source_file", "_ingested_at"} <= set(df.columns)


def test_read_months_names_every_missing_month(spark, scratch):
    write_month(spark, scratch, "2026-02", 5)
    template = os.path.join(scratch, "trips_{month}.parquet")
    with pytest.raises(FileNotFoundError, match=r"2026-01.*2026-03"):
        ingest.read_months(spark, ["2026-01", "2026-02", "2026-03"], template)
    df = ingest.read_months(spark, ["2026-01", "2026-02", "2026-03"], template, on_missing="skip")
    assert df.count() == 5


def test_load_months_is_idempotent_and_force_replaces(spark, scratch):
    src = os.path.join(scratch, "src")
    table = os.path.join(scratch, "bronze")
    template = os.path.join(src, "trips_{month}.parquet")
    write_month(spark, src, "2026-01", 10)
    write_month(spark, src, "2026-02", 20)
    first = ingest.load_months(spark, ["2026-01", "2026-02"], template, table)
    assert first.loaded == ["2026-01", "2026-02"] and first.skipped == []
    second = ingest.load_months(spark, ["2026-01", "2026-02"], template, table)
    assert second.loaded == [] and second.skipped == ["2026-01", "2026-02"]
    assert spark.read.parquet(table).count() == 30

    write_month(spark, src, "2026-01", 4)                      # the source file changes
    forced = ingest.load_months(spark, ["2026-01"], template, table, force=True)
    assert forced.loaded == ["2026-01"]
    per_month = {r["_month"]: r["count"] for r in spark.read.parquet(table).groupBy("_month").count().collect()}
    assert per_month == {"2026-01": 4, "2026-02": 20}       # only the forced month was replaced


def test_load_months_loads_present_then_reports_missing(spark, scratch):
    src = os.path.join(scratch, "src")
    table = os.path.join(scratch, "bronze")
    write_month(spark, src, "2026-02", 3)
    with pytest.raises(RuntimeError, match=r"\['2026-01', '2026-03'\]"):
        ingest.load_months(spark, ["2026-01", "2026-02", "2026-03"], os.path.join(src, "trips_{month}.parquet"), table)
    assert spark.read.parquet(table).count() == 3


def document(times, **arrays):
    return json.dumps({"hourly": {"time": times, **arrays}})


def hours_from(start, n):
    return [(start + timedelta(hours=i)).strftime("%Y-%m-%dT%H:%M") for i in range(n)]


def documents(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "k int, payload string")


def test_a_leap_month_of_hours_is_complete(spark):
    docs = documents(spark, document(hours_from(datetime(2028, 2, 1), 29 * 24), temperature_2m=[-0.5] * 29 * 24))
    rows = ingest.hourly_payload_to_rows(docs, "payload", VARS)
    assert rows.columns == ["weather_hour_local", "temperature_2m"]
    assert rows.count() == 696
    start, end = calendar.month_bounds(["2028-02"])
    assert (start, end) == ("2028-02-01", "2028-02-29")
    assert calendar.month_bounds(["2027-11", "2027-12"]) == ("2027-11-01", "2027-12-31")
    assert calendar.check_hourly_completeness(rows, start, end) is True
    assert calendar.missing_hours(rows, start, end).count() == 0


def test_an_incomplete_series_warns(spark, caplog):
    docs = documents(spark, document(hours_from(datetime(2027, 6, 30, 20), 3), temperature_2m=[21.5, 20.0, 19.25]))
    rows = ingest.hourly_payload_to_rows(docs, "payload", VARS)
    with caplog.at_level(logging.WARNING):
        assert calendar.check_hourly_completeness(rows, "2027-06-01", "2027-06-30") is False
    assert any("3 of 720 hours" in r.getMessage() for r in caplog.records)
    assert calendar.missing_hours(rows, "2027-06-01", "2027-06-30").count() == 717


TWO = hours_from(datetime(2027, 3, 5, 7), 2)


def test_a_missing_variable_is_null_in_every_hour(spark):
    docs = documents(spark, document(TWO, temperature_2m=[4.0, None]), document(TWO, rain=[1, 2]))
    rows = ingest.hourly_payload_to_rows(docs, "payload", {"temperature_2m": "double", "rain": "bigint"})
    got = sorted((r.weather_hour_local.hour, r.temperature_2m, r.rain) for r in rows.collect() if r.rain is None)
    assert got == [(7, 4.0, None), (8, None, None)]
    assert sorted((r.temperature_2m, r.rain) for r in rows.collect() if r.rain is not None) == [(None, 1), (None, 2)]


@pytest.mark.parametrize("text, fault", [
    ("{}", "no object of hourly arrays"),
    ("[1", "no object of hourly arrays"),
    (None, "no object of hourly arrays"),
    (json.dumps({"hourly": {"temperature_2m": [1.0]}}), "no time array"),
    (document(["yesterday"], temperature_2m=[1.0]), "a time that is none"),
    (document(TWO, temperature_2m=[1.0]), "differ in length"),
    (document(TWO, temperature_2m=[1.0, 2.0, 3.0]), "differ in length"),
    (document(TWO, temperature_2m=[1.0, "warm"]), "of another type"),
    (document(TWO, temperature_2m=7), "is no array"),
])
def test_a_document_that_cant_be_read_fails_or_is_routed(spark, text, fault):
    good = document(TWO, temperature_2m=[1.0, 2.0])
    docs = documents(spark, good, text)
    with pytest.raises(Exception, match=fault):
        ingest.hourly_payload_to_rows(docs, "payload", VARS).collect()
    assert ingest.hourly_payload_to_rows(docs, "payload", VARS, mode="quarantine").count() == 2
    bad = ingest.bad_payloads(docs, "payload", VARS).collect()
    assert [r.k for r in bad] == [1] and fault in bad[0]["_fault"]


def test_nanosecond_hourly_file(spark, scratch):
    path = os.path.join(scratch, "weather_hourly.parquet")
    pdf = pd.DataFrame({
        "weather_hour_local": pd.to_datetime(["2026-01-01T00:00", "2026-01-01T01:00"]),
        "temperature_2m": [1.0, 2.0],
    })
    pdf.to_parquet(path, index=False)
    df = ingest.read_hourly(spark, path, nanos=True)
    assert dict(df.dtypes)["weather_hour_local"] == "timestamp"
    assert [r.weather_hour_local for r in df.orderBy("weather_hour_local").collect()] == [
        datetime(2026, 1, 1, 0, 0), datetime(2026, 1, 1, 1, 0)
    ]


def test_reading_nanoseconds_leaves_the_session_as_it_was(spark, scratch):
    path = os.path.join(scratch, "h.parquet")
    pd.DataFrame({"weather_hour_local": pd.to_datetime(["2026-01-01T00:00"])}).to_parquet(path, index=False)
    before = spark.conf.get(ingest.NANOS_AS_LONG)
    ingest.read_hourly(spark, path, nanos=True)
    assert spark.conf.get(ingest.NANOS_AS_LONG) == before == "false"


def test_zone_csv(spark, scratch):
    path = os.path.join(scratch, "zones.csv")
    with open(path, "w") as f:
        f.write("LocationID,Borough,Zone,service_zone\n1,North,Airport,Airports\n264,Unknown,N/A,N/A\n265,N/A,Outside,\n")
    df = ingest.read_zone_csv(spark, path)
    rows = {r.LocationID: r for r in df.collect()}
    assert dict(df.dtypes)["LocationID"] == "int"
    assert rows[264].Zone == "N/A" and rows[265].service_zone is None


def test_publish_table_and_view(spark):
    df = spark.range(5).withColumn("g", F.col("id") % 2)
    t = catalog.publish_table(df, "gold_unit.numbers", partition_by=["g"])
    assert t.count() == 5
    v = catalog.publish_view(spark, "gold_unit.odd", "SELECT * FROM gold_unit.numbers WHERE g = 1")
    assert v.count() == 2
    catalog.publish_table(df.filter("id < 2"), "gold_unit.numbers")    # replaces all of it
    assert catalog.read_table(spark, "gold_unit.numbers").count() == 2
    other = spark.newSession()
    assert other.table("gold_unit.odd").count() == 1                    # follows, and any session reads it
    assert catalog.drop_old_versions(spark, "gold_unit.numbers", keep=1) == 1
    assert spark.table("gold_unit.numbers").count() == 2


def test_a_failed_publish_keeps_the_old_data(spark):
    catalog.publish_table(spark.range(3), "gold_unit.kept")
    broken = spark.range(3).select(F.raise_error(F.lit("stop")).cast("long").alias("id"))
    with pytest.raises(Exception, match="stop"):
        catalog.publish_table(broken, "gold_unit.kept")
    assert spark.table("gold_unit.kept").count() == 3


def test_clean_up_keeps_what_the_name_reads(spark):
    name = "gold_unit.cleaned"
    catalog.publish_table(spark.range(3), name)
    catalog.publish_table(spark.range(4), name)
    folder, fs = catalog._folder(spark, catalog._versions_folder(spark, name))
    for number in range(2):  # what a driver that died in a write leaves: newer, incomplete
        fs.mkdirs(spark._jvm.org.apache.hadoop.fs.Path(folder, f"{number:032x}"))
    broken = spark.range(3).select(F.raise_error(F.lit("stop")).cast("long").alias("id"))
    with pytest.raises(Exception, match="stop"):
        catalog.publish_table(broken, name)
    assert len(fs.listStatus(folder)) == 4                              # the failed write removed its own
    assert catalog.drop_old_versions(spark, name, keep=2) == 2
    assert spark.table(name).count() == 4
    assert catalog.drop_old_versions(spark, name, keep=1) == 1
    assert spark.table(name).count() == 4
    catalog.publish_table(spark.range(0), name)                         # an empty version is live, too
    assert catalog.drop_old_versions(spark, name, keep=1) == 1
    assert spark.table(name).count() == 0
    assert catalog.drop_old_versions(spark, "gold_unit.never") == 0


def test_path_exists(spark, scratch):
    assert ingest.path_exists(spark, scratch)
    assert not ingest.path_exists(spark, os.path.join(scratch, "nope"))
