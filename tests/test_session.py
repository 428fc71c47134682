"""Session helpers."""

from tripmart.session import MAX_SHUFFLE_PARTITIONS, TARGET_PARTITION_BYTES, ensure_checkpoint_dir, scale_conf


def test_scale_conf_sizes_and_caps_partitions():
    small = scale_conf(10 * 1024**3, total_cores=64)
    assert int(small["spark.sql.shuffle.partitions"]) == 192            # three waves of tasks
    medium = scale_conf(1024**4, total_cores=64)
    assert int(medium["spark.sql.shuffle.partitions"]) == 1024**4 // TARGET_PARTITION_BYTES
    huge = scale_conf(100 * 1024**4, total_cores=4000)
    assert int(huge["spark.sql.shuffle.partitions"]) == MAX_SHUFFLE_PARTITIONS
    assert huge["spark.sql.files.maxPartitionBytes"] == str(TARGET_PARTITION_BYTES)


def test_checkpoint_dir_is_set(spark):
    assert ensure_checkpoint_dir(spark)
