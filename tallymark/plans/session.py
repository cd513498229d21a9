"""Recommended session settings. The library itself always works on the session it is given."""

from __future__ import annotations

from pyspark.sql import SparkSession

TARGET_PARTITION_BYTES = 128 * 1024 * 1024


def session_settings(shuffle_bytes: int | None = None, cores: int | None = None) -> dict[str, str]:
    """Settings for jobs of this library.

    Adaptive execution merges small shuffle partitions and splits skewed ones, so the initial number may be generous:
    one partition per ``TARGET_PARTITION_BYTES`` of the largest expected shuffle, at least three per core.
    """
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(TARGET_PARTITION_BYTES),
        # checkpoints of finished jobs leave the shared folder with the DataFrames that own them
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        # no stack trace for every column expression the driver builds
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
        "spark.sql.session.timeZone": "UTC",
    }
    wanted = max(-(-(shuffle_bytes or 0) // TARGET_PARTITION_BYTES), 3 * (cores or 0))
    if wanted:
        settings["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = str(wanted)
    return settings


def build_session(app_name: str = "tallymark", *, hive: bool = False, **sizes: int) -> SparkSession:
    builder = SparkSession.builder.appName(app_name).config(map=session_settings(**sizes))
    return (builder.enableHiveSupport() if hive else builder).getOrCreate()
