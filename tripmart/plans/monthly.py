"""Marts from stored monthly partials: a changed month is recomputed alone (O-43..O-51).

Three stores below one folder, each partitioned by the month of the pickup:

* ``trips_checked``: the gated trips of the month;
* ``cells``: their hourly rollup (counts and exact sums of every mart);
* ``hours``: per weather group the trips and the set of hours with a trip, as
  bitmaps of hour numbers, which merge by OR whatever months they come from.

``publish_months`` takes the months that changed, reads only their rows of
bronze (a range on the pickup time, pushed to the scan), replaces their
partitions and merges the marts from the partials of all months.  The cells are
exact sums, so the digits are those of one pass over everything.

Everything is derived from bronze and a month is replaced as a whole: after a
crash the same call repairs it.  Copies of a trip share its pickup time, so the
dedup never crosses months.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.functions import exprs as X
from tripmart.functions.exact import rounded_ratio
from tripmart.operators import gate as G, observed, staging
from tripmart.operators.marts import with_conditions
from tripmart.plans import medallion, rollup
from tripmart.sources.catalog import publish_tables

PART_COL = "_part"


class Months:
    """Parts of the time line: calendar months; trips without a pickup time are a part of their own."""

    unknown = X.UNKNOWN_MONTH

    def label(self, ts: str) -> Column:
        return X.month_label_or_unknown(ts)

    def bounds(self, label: str) -> tuple[date, date]:
        """First day of the part and of the next one."""
        year, month = map(int, label.split("-"))
        return date(year, month, 1), date(year + month // 12, month % 12 + 1, 1)


class HalfMonths(Months):
    """The 1st to the 15th, and the rest of a month."""

    def label(self, ts: str) -> Column:
        half = F.when(F.dayofmonth(ts) < 16, "-a").otherwise("-b")
        return F.coalesce(F.concat(X.month_label_or_unknown(ts), F.when(F.col(ts).isNotNull(), half)), F.lit(self.unknown))

    def bounds(self, label: str) -> tuple[date, date]:
        first, following = Months.bounds(self, label[:7])
        middle = first.replace(day=16)
        return (first, middle) if label.endswith("a") else (middle, following)


def in_parts(ts: str, parts: Sequence[str], calendar: Months) -> Column:
    """Whether ``ts`` lies in one of the parts, as ranges that a Parquet scan can skip row groups by."""
    tests = []
    for part in parts:
        if part == calendar.unknown:
            tests.append(F.col(ts).isNull())
        else:
            start, end = calendar.bounds(part)
            tests.append((F.col(ts) >= F.lit(start)) & (F.col(ts) < F.lit(end)))
    return reduce(lambda a, b: a | b, tests)


def touched_parts(rows: DataFrame, pickup_col: str = "tpep_pickup_datetime", calendar: Months | None = None) -> list[str]:
    """The parts that new bronze rows fall into: the ones to publish.  At most one label a part is collected."""
    return sorted(r[0] for r in rows.select((calendar or Months()).label(pickup_col)).distinct().collect())


def _replace(df: DataFrame, path: str, parts: Sequence[str]) -> None:
    """Make ``df`` the whole content of these partitions; one that has no row any more goes."""
    watched, counts = observed.watch(df, {part: F.count_if(F.col(PART_COL) == part) for part in parts})
    watched.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PART_COL).parquet(path)
    spark = df.sparkSession
    for part in (part for part, n in counts.get().items() if not n):
        folder = spark._jvm.org.apache.hadoop.fs.Path(path, f"{PART_COL}={part}")
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A store with its labels as text, whatever they look like."""
    return spark.read.schema(schema).parquet(path)


def _schema(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


# ---------------------------------------------------------------- mergeable distinct hours (O-51)

WEATHER_GROUP = ("day_type", "is_precipitation", "temp_bucket")


def hour_sets(enriched_cells: DataFrame, *by: str) -> DataFrame:
    """Per weather group (and ``by``) and bucket of hour numbers: trips, and a bitmap of the hours that have one."""
    number = F.expr("CAST(floor(unix_seconds(CAST(pickup_hour AS timestamp)) / 3600) AS bigint)")
    return (
        with_conditions(enriched_cells).withColumn("hour_number", number)
        .groupBy(*by, *WEATHER_GROUP, F.bitmap_bucket_number("hour_number").alias("bucket"))
        .agg(F.sum("n").cast("bigint").alias("trips"), F.bitmap_construct_agg(F.bitmap_bit_position("hour_number")).alias("hours"))
    )


def weather_impact_of_sets(sets: DataFrame) -> DataFrame:
    """``weather_impact`` from hour sets of any parts: an hour that stands in several counts once."""
    merged = sets.groupBy(*WEATHER_GROUP, "bucket").agg(F.sum("trips").alias("trips"), F.bitmap_count(F.bitmap_or_agg("hours")).alias("n_hours"))
    # trips without an hour have no bucket and no bit
    hours = F.sum(F.when(F.col("bucket").isNotNull(), F.col("n_hours")).otherwise(0))
    return (
        merged.groupBy(*WEATHER_GROUP).agg(F.sum("trips").cast("bigint").alias("total_trips"), hours.cast("bigint").alias("distinct_hours"))
        .withColumn("avg_trips_per_hour", rounded_ratio(F.col("total_trips"), F.col("distinct_hours"), 1))
        .orderBy(*WEATHER_GROUP)
    )


# ---------------------------------------------------------------- publishing

@dataclass(frozen=True)
class MonthlyStores:
    """Readers of the three stores, of all months."""

    checked: DataFrame
    cells: DataFrame
    hours: DataFrame


def refresh_months(
    bronze: DataFrame, stg_weather: DataFrame, stg_zones: DataFrame, rules: Sequence[G.Rule], parts: Sequence[str], store: str,
    pickup_col: str = "tpep_pickup_datetime", calendar: Months | None = None,
) -> MonthlyStores:
    """Replace the partitions of ``parts`` in all three stores from their rows of ``bronze``."""
    spark, calendar = bronze.sparkSession, calendar or Months()
    gated = medallion.gate(bronze.filter(in_parts(pickup_col, parts, calendar)), rules).checked
    checked = gated.withColumn(PART_COL, calendar.label(pickup_col))
    _replace(checked, f"{store}/trips_checked", parts)
    mine = lambda df: df.filter(F.col(PART_COL).isin(list(parts)))

    kept = _read(spark, f"{store}/trips_checked", _schema(checked))
    cells = rollup.hourly_rollup(staging.stage_trips(mine(kept), G.REASON_COL), G.REASON_COL).withColumn(PART_COL, calendar.label("pickup_hour"))
    _replace(cells, f"{store}/cells", parts)
    all_cells = _read(spark, f"{store}/cells", _schema(cells))

    valid = mine(all_cells).filter(F.col(G.REASON_COL).isNull())
    sets = hour_sets(rollup.enrich_rollup(valid, stg_weather, stg_zones), PART_COL)
    _replace(sets, f"{store}/hours", parts)
    return MonthlyStores(kept, all_cells, _read(spark, f"{store}/hours", _schema(sets)))


def merged_marts(stores: MonthlyStores, stg_weather: DataFrame, stg_zones: DataFrame) -> dict[str, DataFrame]:
    """The eight marts, from partials only."""
    valid = stores.cells.filter(F.col(G.REASON_COL).isNull()).drop(G.REASON_COL, PART_COL)
    joined = rollup.enrich_rollup(valid, stg_weather, stg_zones)
    marts = {name: fn(joined) for name, fn in rollup.ROLLUP_MARTS.items() if name != "weather_impact"}
    return {**marts, "weather_impact": weather_impact_of_sets(stores.hours), "dq_quarantine_trend": rollup.quarantine_trend(stores.cells)}


def publish_months(
    bronze: DataFrame, raw_hourly: DataFrame, raw_zones: DataFrame, rules: Sequence[G.Rule], parts: Sequence[str], store: str,
    gold_db: str = "gold", pickup_col: str = "tpep_pickup_datetime", calendar: Months | None = None,
) -> dict[str, DataFrame]:
    """Recompute the months ``parts`` and publish the marts of all months; returns readers of the marts.

    ``store`` lies on a file system that all executors share.
    """
    stg_weather, stg_zones = staging.stage_weather(raw_hourly), staging.stage_zones(raw_zones)
    stores = refresh_months(bronze, stg_weather, stg_zones, rules, parts, store, pickup_col, calendar)
    marts = merged_marts(stores, stg_weather, stg_zones)
    published = publish_tables({f"{gold_db}.{name}": df for name, df in marts.items()})
    return {name: published[f"{gold_db}.{name}"] for name in marts}
