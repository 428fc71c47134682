"""Catalog tables and views (O-9..O-12).

A published name is a view over one version of its data: a Parquet folder
written in full below the database's location before the view is pointed at
it.  A write that fails leaves the version before it in place, and readers
that have begun keep theirs.  Databases are named exactly as given
(``bronze``, ``silver``, ``gold``), and views of one never refer to another's.
Old versions stay until ``drop_old_versions`` is called.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

_VERSION = re.compile(r"parquet\.`[^`]*/([0-9a-f]{32})`")


def ensure_database(spark: SparkSession, name: str) -> None:
    """``CREATE DATABASE IF NOT EXISTS`` for a qualified table name's database."""
    if "." in name:
        db = name.rsplit(".", 1)[0]
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")


def _database(name: str) -> str:
    return name.rsplit(".", 1)[0] if "." in name else "default"


def _versions_folder(spark: SparkSession, name: str) -> str:
    """Where the versions of a published name are kept."""
    return f"{spark.catalog.getDatabase(_database(name)).locationUri}/_versions/{name.rsplit('.', 1)[-1]}"


def _folder(spark: SparkSession, path: str):
    """A path and its file system."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def publish_table(df: DataFrame, name: str, partition_by: Sequence[str] | None = None, path: str | None = None) -> DataFrame:
    """Write ``df`` as a new version of ``name``, point the name at it and return a reader of it (O-10, O-12).

    ``path`` keeps the versions there instead of in the database's location.
    """
    spark = df.sparkSession
    ensure_database(spark, name)
    version = f"{path or _versions_folder(spark, name)}/{uuid.uuid4().hex}"
    writer = df.write.format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    try:
        writer.save(version)
    except Exception:
        folder, fs = _folder(spark, version)
        fs.delete(folder, True)  # nothing reads it
        raise
    _point(spark, name, f"SELECT * FROM parquet.`{version}`")
    return spark.table(name)


def _point(spark: SparkSession, name: str, select: str) -> None:
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
        raise ValueError(f"{name} is a table that was not published here; drop or rename it first")
    spark.sql(f"CREATE OR REPLACE VIEW {_quoted(name)} AS {select}")


def _live_version(spark: SparkSession, name: str) -> str | None:
    """The folder that a published name reads now."""
    if not spark.catalog.tableExists(name):
        return None
    found = _VERSION.search(spark.sql(f"SHOW CREATE TABLE {_quoted(name)}").first()[0])
    return found and found.group(1)


def drop_old_versions(spark: SparkSession, name: str, keep: int = 2, path: str | None = None) -> int:
    """Delete versions of a published name; returns how many went.

    The version that the name reads always stays, whatever its age, and so do
    the newest complete others up to ``keep`` in all.  What a failed write left
    (a folder without its success mark) goes first.
    """
    folder, fs = _folder(spark, path or _versions_folder(spark, name))
    if not fs.exists(folder):
        return 0
    live = _live_version(spark, name)
    others = [s.getPath() for s in sorted(fs.listStatus(folder), key=lambda s: -s.getModificationTime()) if s.getPath().getName() != live]
    whole = [p for p in others if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
    kept = {p.getName() for p in whole[:max(1, keep) - (live is not None)]}
    gone = [p for p in others if p.getName() not in kept]
    for version in gone:
        fs.delete(version, True)
    return len(gone)


def publish_tables(
    frames: Mapping[str, DataFrame],
    partition_by: Mapping[str, Sequence[str]] | None = None,
    max_parallel: int = 8,
) -> dict[str, DataFrame]:
    """Publish several independent tables with their write jobs submitted concurrently.

    Small writes (the gold marts) run a handful of tasks each; one after
    another they leave most executors idle, together they share the
    cluster.  Each write still commits on its own.
    """
    if not frames:
        return {}
    for name, df in frames.items():
        ensure_database(df.sparkSession, name)
    parts = partition_by or {}
    with ThreadPoolExecutor(max_workers=max(1, min(max_parallel, len(frames)))) as pool:
        futures = {name: pool.submit(publish_table, df, name, parts.get(name)) for name, df in frames.items()}
        return {name: future.result() for name, future in futures.items()}


def publish_view(spark: SparkSession, name: str, select: str) -> DataFrame:
    """Publish ``select`` over published names as the persistent view ``name`` (O-11).

    Views of any session on the same catalog read it; it follows the names it
    reads when they are published anew.
    """
    ensure_database(spark, name)
    _point(spark, name, select)
    return spark.table(name)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """Catalog table scan (O-9)."""
    return spark.table(name)
