"""Lineage cuts that survive the loss of an executor."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names; only a local session without one gets a folder of its own."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        named = tempfile.mkdtemp(prefix="fundloom-checkpoint-")
    sc.setCheckpointDir(named)
    return named


def cut_lineage(df: DataFrame) -> DataFrame:
    """The frame, computed once and read back from the checkpoint folder from here on."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
