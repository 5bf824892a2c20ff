"""Spark sessions and the few settings that follow from the size of the input."""

from __future__ import annotations

from pyspark.sql import SparkSession

MB = 1 << 20


def shuffle_settings(input_bytes: int, cores: int, partition_bytes: int = 128 * MB) -> dict[str, str]:
    """Settings for inputs of ``input_bytes``: shuffle partitions that fit an executor's memory.

    The initial number is generous; adaptive execution merges small partitions afterwards and
    splits those that a frequent key makes much larger than the rest.
    """
    partitions = max(2 * cores, -(-input_bytes // partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
    }


def local_session(cores: int, name: str = "tarmac") -> SparkSession:
    """A single-machine session for tests and measurements."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
