"""Session settings for local runs and for large inputs."""

from __future__ import annotations

from pyspark.sql import SparkSession

TARGET_PARTITION_BYTES = 128 * 1024 * 1024


def shuffle_partitions(input_bytes: int, cores: int) -> int:
    """Shuffle width that keeps a partition near 128 MB, never below the core count."""
    return max(cores, -(-input_bytes // TARGET_PARTITION_BYTES))


def build_session(
    app_name: str = "pagewright",
    master: str | None = None,
    input_bytes: int = 0,
    cores: int = 0,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create a session with adaptive execution on and the shuffle sized to the input.

    The first exchange is planned wide (``initialPartitionNum``) and adaptive execution
    merges what turns out small. Without ``input_bytes`` and ``cores`` the widths that the
    cluster sets are left alone.
    """
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    }
    width = shuffle_partitions(input_bytes, cores)
    if width:
        conf["spark.sql.shuffle.partitions"] = str(width)
        conf["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = str(width)
    conf |= extra or {}
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
