"""Bronze inputs: monthly fact files, the hourly payload, the hourly file and the location CSV.

Downloading stays outside Spark; these functions start where the files sit on
a (shared) file system.  Path checks go through Spark's own data-source path
resolution, so they work for any Hadoop-compatible file system.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.session import ensure_checkpoint_dir

log = logging.getLogger(__name__)

MONTH_COL = "_month"
HOUR_COL = "weather_hour_local"
NANOS_AS_LONG = "spark.sql.legacy.parquet.nanosAsLong"
PAYLOAD_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm"
ZONE_CSV_SCHEMA = "LocationID INT, Borough STRING, Zone STRING, service_zone STRING"


def path_exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` (file, directory or glob) resolves to something."""
    try:
        spark.read.format("binaryFile").load(path)
        return True
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc):
            return False
        raise


def month_paths(template: str, months: Sequence[str]) -> dict[str, str]:
    """``{month: template.format(month=month)}`` in the given month order."""
    return {m: template.format(month=m) for m in months}


def with_ingest_metadata(df: DataFrame) -> DataFrame:
    """Add ``_source_file`` and ``_ingested_at``; the ``_`` prefix keeps them out of dedup keys (O-2)."""
    return df.select(
        "*",
        F.col("_metadata.file_path").alias("_source_file"),
        F.current_timestamp().alias("_ingested_at"),
    )


def file_row_counts(df: DataFrame, file_col: str = "_source_file") -> DataFrame:
    """Rows per ingested file (O-3)."""
    return df.groupBy(file_col).agg(F.count(F.lit(1)).alias("row_count")).orderBy(file_col)


V1_SOURCES = "spark.sql.sources.useV1SourceList"
FOOTER_COUNTS = "spark.sql.parquet.aggregatePushdown"


def partition_row_counts(spark: SparkSession, table_path: str, partition_col: str | None = None) -> DataFrame:
    """Rows per partition of a Parquet table from its file footers alone (O-3): no data page is read.

    The count is pushed into the scan by Spark's second Parquet reader, which
    two settings select; they are looked up while the query is planned, so the
    one row a partition is checkpointed and the settings are put back.
    """
    ensure_checkpoint_dir(spark)
    partition_col = partition_col or MONTH_COL
    before = {key: spark.conf.get(key) for key in (V1_SOURCES, FOOTER_COUNTS)}
    try:
        spark.conf.set(V1_SOURCES, ",".join(s for s in before[V1_SOURCES].split(",") if s != "parquet"))
        spark.conf.set(FOOTER_COUNTS, "true")
        return footer_counts(spark.read.parquet(table_path), partition_col).checkpoint(eager=True)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def footer_counts(df: DataFrame, partition_col: str) -> DataFrame:
    return df.groupBy(partition_col).agg(F.count(F.lit(1)).alias("row_count"))


def read_months(
    spark: SparkSession,
    months: Sequence[str],
    template: str,
    on_missing: str = "raise",
) -> DataFrame:
    """Read the fact file of every month into one DataFrame (O-1).

    All months are checked first; every missing one is named in a single
    error (``on_missing='raise'``) or logged and skipped (``'skip'``).  Each
    row carries its ``_month`` and ingest metadata.
    """
    paths = month_paths(template, months)
    missing = [m for m, p in paths.items() if not path_exists(spark, p)]
    if missing and on_missing == "raise":
        raise FileNotFoundError(f"no file for {missing} ({len(missing)} of {len(months)} months)")
    if missing:
        log.error("no file for %s, reading the other months", missing)
    present = {m: p for m, p in paths.items() if m not in missing}
    if not present:
        raise FileNotFoundError(f"no file for any of {missing}")
    frames = [
        with_ingest_metadata(spark.read.parquet(p)).withColumn(MONTH_COL, F.lit(m))
        for m, p in present.items()
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


@dataclass(frozen=True)
class LoadResult:
    loaded: list[str]
    skipped: list[str]


def load_months(
    spark: SparkSession,
    months: Sequence[str],
    template: str,
    table_path: str,
    force: bool = False,
) -> LoadResult:
    """Idempotent bronze load: one month partition per month, existing ones kept (O-4).

    A month whose partition already exists is skipped unless ``force``; the
    others are read and written in one job with dynamic partition overwrite,
    so a forced month replaces only its own partition.  Missing source months
    do not stop the present ones from loading; they are named together in one
    error afterwards.
    """
    paths = month_paths(template, months)
    missing = [m for m, p in paths.items() if not path_exists(spark, p)]
    skipped = [] if force else [
        m for m in months if m not in missing and path_exists(spark, f"{table_path}/{MONTH_COL}={m}")
    ]
    todo = [m for m in months if m not in missing and m not in skipped]
    for m in skipped:
        log.info("%s holds %s, kept as it is", table_path, m)
    if todo:
        frames = [
            with_ingest_metadata(spark.read.parquet(paths[m])).withColumn(MONTH_COL, F.lit(m)) for m in todo
        ]
        batch = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
        (
            batch.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(MONTH_COL)
            .parquet(table_path)
        )
    if missing:
        raise RuntimeError(f"no file for {missing}; the other months are stored")
    return LoadResult(loaded=todo, skipped=skipped)


FILES_SCHEMA = f"path string, length bigint, modified timestamp, {MONTH_COL} string"


def source_files(spark: SparkSession, months: Sequence[str], template: str) -> DataFrame:
    """``path, length, modified, _month`` of every source file of the months that have any: a listing, no file is opened."""
    found = [(m, p) for m, p in month_paths(template, months).items() if path_exists(spark, p)]
    listed = [
        spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(p).select(
            "path", "length", F.col("modificationTime").alias("modified"), F.lit(m).alias(MONTH_COL))
        for m, p in found
    ]
    return reduce(DataFrame.unionByName, listed) if listed else spark.createDataFrame([], FILES_SCHEMA)


def changed_months(files: DataFrame, stored_files: DataFrame) -> list[str]:
    """Months of which a file is new, gone, or another than the one that was loaded."""
    names = ["path", "length", "modified", MONTH_COL]
    months = files.select(MONTH_COL).distinct()
    known = stored_files.select(*names).join(months, MONTH_COL, "left_semi")  # months not asked for stay as they are
    new = files.join(known, names, "left_anti").select(MONTH_COL)
    gone = known.join(files, names, "left_anti").select(MONTH_COL)
    return sorted(r[0] for r in new.unionByName(gone).distinct().collect())


def load_changed_months(spark: SparkSession, months: Sequence[str], template: str, table_path: str) -> LoadResult:
    """``load_months`` that looks at the files, not at the table's folders (O-4).

    Next to the table, ``<table_path>_files`` keeps path, length and time of
    every file that was loaded.  A month with a new, removed or rewritten file
    is loaded again; the others are skipped.  The list of a month is written
    after its rows, so a load that fails in between is repeated.
    """
    known_path = f"{table_path}_files"
    files = source_files(spark, months, template)
    known = spark.read.schema(FILES_SCHEMA).parquet(known_path) if path_exists(spark, known_path) else spark.createDataFrame([], FILES_SCHEMA)
    todo = changed_months(files, known)
    done = load_months(spark, todo, template, table_path, force=True) if todo else LoadResult([], [])
    if todo:
        fresh = files.filter(F.col(MONTH_COL).isin(todo))
        fresh.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(MONTH_COL).parquet(known_path)
    missing = [m for m, p in month_paths(template, months).items() if not path_exists(spark, p)]
    if missing:
        raise RuntimeError(f"no file for {missing}; the other months are stored")
    return LoadResult(loaded=done.loaded, skipped=[m for m in months if m not in todo])


_TYPES = {
    "double": T.DoubleType(),
    "float": T.FloatType(),
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "string": T.StringType(),
    "boolean": T.BooleanType(),
}


def _spark_type(name: str | T.DataType) -> T.DataType:
    return name if isinstance(name, T.DataType) else _TYPES[name]


def _parse(df: DataFrame, json_col: str, variables: Mapping[str, str]) -> DataFrame:
    """``df`` with ``_rows`` (an array of hours) and ``_fault`` (what is wrong with the document, or NULL).

    Each step is a projection that the next one reads several times, which
    Catalyst therefore keeps apart: a document is parsed once, into a variant,
    and every element is cast once.
    """
    names = ["time", *variables]
    parsed = df.withColumn("_doc", F.try_parse_json(F.col(json_col)))
    texts = {n: F.expr(f"try_variant_get(_doc, \"$.hourly['{n}']\", 'array<string>')") for n in names}
    given = {n: F.expr(f"try_variant_get(_doc, \"$.hourly['{n}']\", 'variant')") for n in variables}
    parsed = parsed.withColumns({
        "_is_object": F.expr("try_variant_get(_doc, '$.hourly', 'variant')").isNotNull(),
        **{f"_text_{k}": texts[n] for k, n in enumerate(names)},
        **{f"_given_{k}": given[n].isNotNull() & ~F.is_variant_null(given[n]) for k, n in enumerate(names) if k},
    })
    kinds = [None, *(_spark_type(kind) for kind in variables.values())]
    parsed = parsed.withColumns({f"_cast_{k}": F.transform(f"_text_{k}", _caster(kind)) for k, kind in enumerate(kinds)})

    time, hours = F.col("_text_0"), F.col("_cast_0")
    faults = F.when(~F.col("_is_object"), F.lit("no object of hourly arrays")).when(time.isNull(), F.lit("no time array"))
    faults = faults.when(F.exists(hours, lambda t: t.isNull()), F.lit("a time that is none"))
    values = {}
    for k, name in enumerate(variables, 1):
        text, cast = F.col(f"_text_{k}"), F.col(f"_cast_{k}")
        faults = faults.when(text.isNull() & F.col(f"_given_{k}"), F.lit(f"{name} is no array"))
        faults = faults.when(F.size(text) != F.size(time), F.lit(f"{name} and time differ in length"))
        faults = faults.when(_nulls(cast) > _nulls(text), F.lit(f"{name} holds a value of another type"))
        # a variable that was not delivered is NULL for every hour
        values[name] = F.coalesce(cast, F.transform(time, _caster_to_null(kinds[k])))
    rows = F.arrays_zip(hours.alias(HOUR_COL), *[v.alias(n) for n, v in values.items()])
    return parsed.select(*df.columns, faults.alias("_fault"), rows.alias("_rows"))


def _caster(data_type: T.DataType | None):
    """A cast of an array's texts; to a time without a type."""
    return lambda x: x.try_cast(data_type) if data_type else F.try_to_timestamp(x, F.lit(PAYLOAD_TIME_FORMAT))


def _caster_to_null(data_type: T.DataType):
    return lambda x: F.lit(None).cast(data_type)


def _nulls(array: Column) -> Column:
    return F.size(F.filter(array, lambda x: x.isNull()))


def hourly_payload_to_rows(
    df: DataFrame,
    json_col: str,
    variables: Mapping[str, str],
    mode: str = "fail",
) -> DataFrame:
    """Parallel-array hourly payloads -> one row per hour (O-5, O-6).

    Each document's arrays are zipped element-wise and exploded, ``time``
    becomes ``weather_hour_local`` (a ``timestamp`` parsed from
    ``yyyy-MM-ddTHH:mm``).  A variable that a document lacks is NULL in all its
    hours.  A document without the hourly object or its times, with a time
    that is none, with arrays of different lengths, or with a value of another
    type fails the job (``mode='fail'``) or is left out as a whole
    (``mode='quarantine'``, also spelled ``'drop'``); ``bad_payloads`` returns
    those documents, so every hour is either a row or in one of them.
    """
    parsed = _parse(df, json_col, variables)
    if mode == "fail":
        message = F.concat(F.lit("hourly payload can't be read: "), F.col("_fault"))
        rows = F.when(F.col("_fault").isNotNull(), F.raise_error(message)).otherwise(F.col("_rows"))
    elif mode in ("quarantine", "drop"):
        # no filter: it would be pushed below the parse and repeat it
        rows = F.when(F.col("_fault").isNull(), F.col("_rows"))
    else:
        raise ValueError(f"unknown mode: {mode!r}")
    return parsed.select(F.inline(rows)).toDF(HOUR_COL, *variables)


def bad_payloads(df: DataFrame, json_col: str, variables: Mapping[str, str]) -> DataFrame:
    """Documents that ``hourly_payload_to_rows`` can't read, with the reason in ``_fault`` (the quarantine side of O-6)."""
    parsed = _parse(df, json_col, variables)
    # as above, exploded and not filtered
    return parsed.select(*df.columns, F.explode(F.when(F.col("_fault").isNotNull(), F.array("_fault"))).alias("_fault"))


def read_hourly(spark: SparkSession, path: str, hour_col: str = HOUR_COL, nanos: bool = False) -> DataFrame:
    """Hourly Parquet file; ``nanos=True`` reads nanosecond timestamps (O-7).

    Files written from ``datetime64[ns]`` columns store ``TIMESTAMP(NANOS)``,
    which Spark refuses by default.  With ``nanos=True`` the file is read once
    as epoch nanoseconds (``spark.sql.legacy.parquet.nanosAsLong``), turned
    back into a timestamp at microsecond precision and checkpointed, since
    Spark looks the setting up whenever it plans a scan; the setting itself is
    put back.
    """
    if not nanos:
        return spark.read.parquet(path)
    before = spark.conf.get(NANOS_AS_LONG)
    spark.conf.set(NANOS_AS_LONG, "true")
    try:
        df = spark.read.parquet(path)
        if not isinstance(df.schema[hour_col].dataType, T.LongType):
            return df
        ensure_checkpoint_dir(spark)
        return df.withColumn(hour_col, F.timestamp_micros(F.expr(f"`{hour_col}` div 1000"))).checkpoint(eager=True)
    finally:
        spark.conf.set(NANOS_AS_LONG, before)


def read_zone_csv(spark: SparkSession, path: str) -> DataFrame:
    """Location lookup CSV with header and declared schema (O-8).

    Text such as ``N/A`` stays a string; an empty field becomes NULL.
    """
    return spark.read.csv(path, header=True, schema=ZONE_CSV_SCHEMA)
