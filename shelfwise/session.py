"""Session settings for local runs, tests and the benchmark.

On a cluster the session is created by the platform; the library reads
what it needs from it (``spark.checkpoint.dir``, shuffle partitions) and
sets nothing globally.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(
    cores: int | str = 8, shuffle_partitions: int | None = None, extra: dict[str, str] | None = None
) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("shelfwise")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or 8))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", "8g")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
