"""Spark session settings shared by tests, benchmark and jobs."""

from __future__ import annotations

import math

from pyspark.sql import SparkSession

PARTITION_BYTES = 64 * 1024 * 1024


def shuffle_partitions(shuffle_bytes: int, cores: int) -> int:
    """Initial shuffle partitions for a job that shuffles `shuffle_bytes`.

    Adaptive execution only merges partitions, so the starting number has to
    be large enough for the biggest shuffle: one partition per 64 MB, never
    fewer than the cores.
    """
    return max(cores, math.ceil(shuffle_bytes / PARTITION_BYTES))


def build_session(
    master: str, cores: int, shuffle_bytes: int = 0, app: str = "ticketflow", options: dict[str, str] | None = None
) -> SparkSession:
    """Session with adaptive execution, zone-free calendar logic and no web page.

    A shuffled join whose smaller side turns out to hold at most 64 MB in every
    partition is hashed instead of sorted; the check is made at run time.
    """
    partitions = shuffle_partitions(shuffle_bytes, cores)
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(PARTITION_BYTES))
        .config("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", str(PARTITION_BYTES))
        .config("spark.sql.shuffle.partitions", str(partitions))
    )
    for key, value in (options or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
