"""Spark session settings shared by the library, the tests and the bench.

All times in the trip data are local wall-clock values, so the session time
zone is pinned to UTC: durations and hour buckets then never shift across a
daylight-saving change.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # checkpoint files of the mart rollup are removed once their DataFrame is gone
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


TARGET_PARTITION_BYTES = 256 * 1024 * 1024
MAX_SHUFFLE_PARTITIONS = 200_000


def scale_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = TARGET_PARTITION_BYTES) -> dict[str, str]:
    """Partition sizing for a job reading ``input_bytes`` on ``total_cores`` executor cores.

    Scan splits and shuffle partitions aim at ``target_partition_bytes``, so a
    task's input fits executor memory and spills rarely.  The initial shuffle
    partition count is sized for the largest shuffle (the full-row dedup,
    about as large as its input) and never below three waves of tasks; AQE
    then coalesces the small shuffles of the marts and splits skewed join
    partitions.  The count is capped at ``MAX_SHUFFLE_PARTITIONS``: shuffle
    blocks grow with maps x reducers, so past the cap partitions grow instead
    (100 TB on 1000 executors x 4 cores: 200,000 partitions of ~512 MiB,
    sorted and spilled by Tungsten where they exceed task memory).
    """
    wanted = -(-input_bytes // target_partition_bytes)
    partitions = min(MAX_SHUFFLE_PARTITIONS, max(3 * total_cores, wanted))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
    }


def get_session(
    master: str | None = None,
    app_name: str = "tripmart",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
    expected_input_bytes: int | None = None,
    total_cores: int | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the library's settings.

    Pass ``expected_input_bytes`` (and ``total_cores``) on a cluster to size
    partitions with ``scale_conf``; ``shuffle_partitions`` and ``extra_conf``
    override it.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if expected_input_bytes:
        conf.update(scale_conf(expected_input_bytes, total_cores or 8))
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint directory, setting one only where none is configured.

    On a cluster the directory comes from ``spark.checkpoint.dir`` (a shared
    file system).  Only a local-mode session without that setting, such as a
    test run, gets a fresh temporary directory.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
    elif sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tripmart-ckpt-"))
    else:
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared file system "
            "before running on a cluster"
        )
    return sc.getCheckpointDir()


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet below the checkpoint directory and return a scan of it.

    Cuts the lineage like ``checkpoint()``, but compressed and by column, so a
    reader takes only what it needs.  A lost executor loses nothing of it.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
