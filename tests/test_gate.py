"""Gate semantics on hand-made edge rows."""

import math
from datetime import datetime

from pyspark.sql import functions as F

from tripmart.operators import gate as G
from tripmart.plans import medallion

SCHEMA = (
    "id int, tpep_pickup_datetime timestamp, tpep_dropoff_datetime timestamp, "
    "trip_distance double, total_amount double, passenger_count int, _batch int"
)
T0 = datetime(2026, 3, 1, 10, 0, 0)
T1 = datetime(2026, 3, 1, 10, 30, 0)


def rules(mode="end_inclusive_literal", end="2026-05-31"):
    return G.trip_rules("2026-01-01", end, range_mode=mode)


def reasons(spark, rows, **kw):
    df = spark.createDataFrame(rows, SCHEMA)
    tagged = G.tag_first_failure(df, rules(**kw))
    return {r["id"]: r[G.REASON_COL] for r in tagged.collect()}


def test_null_timestamps_and_order(spark):
    got = reasons(spark, [
        (1, None, T1, 1.0, 5.0, 1, 0),
        (2, T0, None, 1.0, 5.0, 1, 0),
        (3, T0, T0, 1.0, 5.0, 1, 0),           # drop-off equal to pickup passes
        (4, T1, T0, 1.0, 5.0, 1, 0),
    ])
    assert got == {1: "null_timestamp", 2: "null_timestamp", 3: None, 4: "dropoff_before_pickup"}


def test_first_failing_rule_wins(spark):
    # fails ordering, distance and amount: the first of them is reported
    got = reasons(spark, [(1, T1, T0, 0.0, -1.0, 1, 0), (2, T0, T1, 0.0, -1.0, 1, 0)])
    assert got == {1: "dropoff_before_pickup", 2: "non_positive_distance"}


def test_literal_end_bound_rejects_last_day_after_midnight(spark):
    rows = [
        (1, datetime(2026, 5, 31, 0, 0, 0), datetime(2026, 5, 31, 0, 10), 1.0, 5.0, 1, 0),
        (2, datetime(2026, 5, 31, 0, 0, 1), datetime(2026, 5, 31, 0, 10), 1.0, 5.0, 1, 0),
        (3, datetime(2025, 12, 31, 23, 59, 59), datetime(2026, 1, 1, 0, 10), 1.0, 5.0, 1, 0),
    ]
    assert reasons(spark, rows) == {1: None, 2: "pickup_outside_range", 3: "pickup_outside_range"}
    exclusive = reasons(spark, rows, mode="end_exclusive", end="2026-06-01")
    assert exclusive == {1: None, 2: None, 3: "pickup_outside_range"}


def test_null_and_nan_metrics_pass(spark):
    got = reasons(spark, [
        (1, T0, T1, None, 5.0, 1, 0),
        (2, T0, T1, math.nan, 5.0, 1, 0),
        (3, T0, T1, 0.0, 5.0, 1, 0),
        (4, T0, T1, 1.0, 0.0, 1, 0),            # total 0 is valid
        (5, T0, T1, 1.0, None, 1, 0),
        (6, T0, T1, 1.0, -0.01, 1, 0),
    ])
    assert got == {1: None, 2: None, 3: "non_positive_distance", 4: None, 5: None, 6: "negative_total_amount"}


def test_dedup_ignores_underscore_columns_and_keeps_min_survivor(spark):
    schema = "a int, b string, _batch int, _src string"
    df = spark.createDataFrame(
        [(1, "x", 2, "f2"), (1, "x", 0, "f0"), (1, "x", 1, "f1"), (2, "y", 5, "g"), (None, None, 3, "n"), (None, None, 1, "m")],
        schema,
    )
    assert G.business_keys(df) == ["a", "b"]
    out = G.drop_duplicate_rows(df, copies_col="_copies")
    assert out.columns == ["a", "b", "_batch", "_src", "_copies"]
    rows = {(r["a"], r["b"]): (r["_batch"], r["_src"], r["_copies"]) for r in out.collect()}
    # the survivor is the copy with the smallest first metadata column, taken whole
    assert rows == {(1, "x"): (0, "f0", 3), (2, "y"): (5, "g", 1), (None, None): (1, "m", 2)}


def test_dedup_plans_as_hash_aggregate(spark):
    df = spark.createDataFrame([(1, 2.0, 0)], "a int, v double, _batch int")
    plan = G.drop_duplicate_rows(df)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_gate_report_breakdown_and_split(spark):
    rows = [
        (1, T0, T1, 1.0, 5.0, None, 0),
        (1, T0, T1, 1.0, 5.0, None, 1),         # duplicate of the first row except _batch
        (2, T0, T1, 0.0, 5.0, 1, 0),
        (3, None, T1, 1.0, 5.0, 2, 0),
        (4, T0, T1, 1.0, -2.0, 3, 0),
        (5, T0, T1, 2.0, 9.0, 4, 0),
    ]
    raw = spark.createDataFrame(rows, SCHEMA)
    result = medallion.gate(raw, rules())
    report = G.gate_report(result.checked, medallion.COPIES_COL).first().asDict()
    assert report == {
        "total_rows": 6, "duplicate_rows": 1, "deduped_rows": 5,
        "valid_rows": 2, "valid_pct": 40.0, "quarantined_rows": 3, "quarantined_pct": 60.0,
        "null_passenger_count_rows": 1,
    }
    assert G.REASON_COL not in result.valid.columns
    assert result.valid.count() == 2 and result.quarantine.count() == 3
    breakdown = [tuple(r) for r in G.quarantine_breakdown(result.quarantine).collect()]
    assert sorted(breakdown) == [("negative_total_amount", 1), ("non_positive_distance", 1), ("null_timestamp", 1)]
    summary = G.duplicate_summary(result.checked, medallion.COPIES_COL).first()
    assert (summary.total_rows, summary.deduped_rows, summary.duplicate_rows) == (6, 5, 1)


def test_drop_null_hour(spark):
    df = spark.createDataFrame([(T0, 1.0), (None, 2.0)], "weather_hour_local timestamp, temperature_2m double")
    assert G.drop_null(df, "weather_hour_local").count() == 1


def test_rule_helpers_three_valued(spark):
    df = spark.createDataFrame([(None, 1)], "a int, b int")
    row = df.select(
        G.rule_not_null("a", "b").alias("nn"),
        G.rule_ordered("a", "b").alias("ord"),
        G.rule_positive("a").alias("pos"),
        F.coalesce(G.first_failure([("x", G.rule_positive("a"))]), F.lit("valid")).alias("tag"),
    ).first()
    assert row.nn is True and row.ord is None and row.pos is None and row.tag == "valid"


def test_string_metadata_keeps_hash_aggregate(spark):
    schema = "a int, v double, _batch int, _src string, _month string"
    rows = [(i % 50, float(i % 7), i % 3, f"file-{i % 4}", "2026-01") for i in range(600)]
    rows += [(1, 1.0, 9, None, None)]
    df = spark.createDataFrame(rows, schema).repartition(6)
    out = G.drop_duplicate_rows(df, copies_col="_copies")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan
    groups = {}
    for a, v, batch, src, month in rows:
        groups.setdefault((a, v), []).append((batch, src, month))
    got = {(r.a, r.v): (r._batch, r._src, r._month, r._copies) for r in out.collect()}
    assert set(got) == set(groups)
    for key, (batch, src, month, copies) in got.items():
        copies_of_key = groups[key]
        assert copies == len(copies_of_key)
        assert batch == min(b for b, _, _ in copies_of_key)
        # the metadata comes whole from one copy with the smallest _batch
        assert (batch, src, month) in copies_of_key


def test_hot_duplicate_group_collapses(spark):
    """A third of all rows are copies of one row; dedup keeps it once and counts its copies."""
    hot = [(7, 7.0, i % 5) for i in range(3000)]
    cold = [(i, float(i), 0) for i in range(6000)]
    df = spark.createDataFrame(hot + cold, "a int, v double, _batch int").repartition(12)
    out = G.drop_duplicate_rows(df, copies_col="_copies")
    rows = {(r.a, r.v): (r._batch, r._copies) for r in out.collect()}
    assert rows[(7, 7.0)] == (0, 3001) and len(rows) == 6000


def test_survivor_is_independent_of_partitioning(spark):
    """Copies share the ingest timestamp; the survivor's file must not depend on row order."""
    ts = datetime(2026, 1, 1, 12, 0, 0)
    rows = [(k, float(k % 3), ts, f"file-{f}") for k in range(40) for f in range(5)]
    schema = "a int, v double, _ingested_at timestamp, _source_file string"
    picks = []
    for parts, seed in [(1, 1), (7, 2), (13, 3)]:
        df = spark.createDataFrame(rows, schema).orderBy(F.rand(seed)).repartition(parts)
        out = G.drop_duplicate_rows(df)
        picks.append(sorted((r.a, r._source_file) for r in out.collect()))
    assert picks[0] == picks[1] == picks[2]
    assert len(picks[0]) == 40


def test_string_survivor_order_is_honoured(spark):
    df = spark.createDataFrame(
        [(1, 5, "f-b"), (1, 1, "f-c"), (1, 9, "f-a"), (2, 3, "g")], "a int, _batch int, _src string"
    )
    out = {r.a: (r._batch, r._src) for r in G.drop_duplicate_rows(df, survivor_order="_src").collect()}
    assert out == {1: (9, "f-a"), 2: (3, "g")}


def test_string_metadata_survives_in_any_row_order(spark):
    rows = [(1, "fB", 5), (1, "fA", 5), (1, "fC", 7), (2, "fD", None), (2, "fE", None), (3, "fF", None), (3, "fG", 9)]
    found = set()
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "k int, _source_file string, _batch int").repartition(3, "_source_file")
        found.add(tuple(sorted(tuple(r) for r in G.drop_duplicate_rows(df, copies_col="_copies").collect())))
    assert len(found) == 1
    by_key = {r[0]: r for r in next(iter(found))}
    assert by_key[1][2] == 5 and by_key[1][1] in ("fA", "fB")
    assert by_key[2][1] in ("fD", "fE") and by_key[2][2] is None      # a NULL order keeps its metadata
    assert by_key[3][1:3] == ("fG", 9)                                # and comes last


def test_dedup_takes_one_plan_for_any_number_of_files(spark):
    df = spark.range(2000).select((F.col("id") % 7).alias("k"), F.concat(F.lit("file"), "id").alias("_source_file"))
    out = G.drop_duplicate_rows(df)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan
    assert out.count() == 7 and out.select("_source_file").distinct().count() == 7
