"""JSON topics. The transforms take any streaming frame with a ``value`` column, so they run without a broker."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.scalars import bad_json


def read_topic(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """Raw topic rows; needs the Kafka connector on the class path."""
    return (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
            .option("startingOffsets", "latest").load())


def decode(raw: DataFrame, schema: T.StructType | str, value: str = "value") -> DataFrame:
    """Topic values as columns; values that are not JSON are left out (see ``undecodable``)."""
    text = raw.select(F.col(value).cast("string").alias("v"))
    return text.filter(F.col("v").isNotNull() & ~bad_json("v")).select(F.from_json("v", schema).alias("j")).select("j.*")


def undecodable(raw: DataFrame, value: str = "value") -> DataFrame:
    return raw.select(F.col(value).cast("string").alias("v")).filter(F.col("v").isNull() | bad_json("v"))


def encode(df: DataFrame, key: str | None = None) -> DataFrame:
    cols = [F.to_json(F.struct(*df.columns)).alias("value")]
    return df.select(*([F.col(key).cast("string").alias("key")] if key else []), *cols)


def write_topic(df: DataFrame, servers: str, topic: str, checkpoint: str, key: str | None = None):
    return (encode(df, key).writeStream.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic)
            .option("checkpointLocation", checkpoint).start())
