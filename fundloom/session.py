"""Session settings shared by jobs, tests and the bench."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def local_session(cores: int | None = None, name: str = "fundloom") -> SparkSession:
    """A local session for tests and the bench; on a cluster the submitter sets master and sizes."""
    n = cores or os.cpu_count() or 4
    builder = SparkSession.builder.master(f"local[{n}]").appName(name)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return (
        builder.config("spark.sql.shuffle.partitions", str(n))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("FUNDLOOM_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings results depend on (time zone, ANSI) to a session someone else built."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shuffle_width(spark: SparkSession) -> int:
    """How many reducers a shuffle has; bucket counts follow it so they grow with the cluster."""
    return max(16, int(spark.conf.get("spark.sql.shuffle.partitions")))
