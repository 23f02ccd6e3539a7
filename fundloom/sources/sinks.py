"""DataFrames to files."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def write_parquet(df: DataFrame, path: str, partition_cols: list[str] | None = None, spread: list[str] = ()) -> None:
    """Overwrite snappy Parquet. Partitioned output is clustered by the partition columns first, so a task does not open
    a file in every partition; the rebalance splits a partition value that holds most rows."""
    if partition_cols:
        df = df.hint("rebalance", *[F.col(c) for c in partition_cols])
        df.write.mode("overwrite").option("compression", "snappy").partitionBy(*partition_cols).parquet(path)
    else:
        df.write.mode("overwrite").option("compression", "snappy").parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def append_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def kpis_long(df: DataFrame) -> DataFrame:
    """A one-row KPI frame as (metric, value) text rows."""
    return df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns]).unpivot([], df.columns, "metric", "value")


def write_kpis(df: DataFrame, path: str) -> None:
    long = kpis_long(df)
    long.write.mode("overwrite").json(f"{path}/json")
    write_csv(long, f"{path}/csv")
