"""Lead, market and news streams: the batch operators on streaming frames, with watermarks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions import rules as R
from ..functions.scalars import parse_ts, signature
from ..functions.text import article_body
from ..operators.filters import quality_rule

LEAD_SCHEMA = T.StructType([
    T.StructField(name, T.StringType())
    for name in ("lead_id", "First Name", "Last Name", "City", "Occupation", "Lead Source")
] + [
    T.StructField(name, T.DoubleType())
    for name in ("total_visits", "total_time_spent_on_website", "page_views_per_visit", "Conversion_Probability")
] + [T.StructField("timestamp", T.StringType())])

MARKET_SCHEMA = ("Timestamp string, Market string, Status string, `Index` string, Last_Price double, Variation double, "
                 "Pct_Change double, Trade_Date string")


def lead_stream(spark: SparkSession, inbox: str, files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(LEAD_SCHEMA)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.json(inbox)


def csv_stream(spark: SparkSession, inbox: str, schema: T.StructType | str, files_per_trigger: int | None = None) -> DataFrame:
    """CSV inbox with lower-case column names."""
    reader = spark.readStream.schema(schema).option("header", True)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    raw = reader.csv(inbox)
    return raw.toDF(*[c.strip().lower() for c in raw.columns])


def market_stream(spark: SparkSession, inbox: str, out: str, checkpoint: str, schema=MARKET_SCHEMA, **trigger):
    """CSV inbox appended to Parquet; restarts go on after the last committed file."""
    return append_parquet(csv_stream(spark, inbox, schema), out, checkpoint, **trigger)


def quality_stream(df: DataFrame) -> DataFrame:
    return df.filter(quality_rule())


def rejected_stream(df: DataFrame) -> DataFrame:
    return df.filter(~F.coalesce(quality_rule(), F.lit(False)))


def city_metrics(df: DataFrame, window: str = "1 minute", slide: str | None = "30 seconds", watermark: str | None = "10 minutes") -> DataFrame:
    """Mean probability and lead count per city and time window; rows later than the watermark are dropped by Spark and
    counted in its progress report. Without ``slide`` the windows tumble."""
    timed = df.withColumn("ts", parse_ts("timestamp"))
    if watermark:
        timed = timed.withWatermark("ts", watermark)
    span = F.window("ts", window, slide) if slide else F.window("ts", window)
    return timed.groupBy(span.alias("window"), "City").agg(
        F.avg("Conversion_Probability").alias("avg_lead_score"), F.count("lead_id").alias("lead_count"))


def news_signals(df: DataFrame, lexicon: str = "short") -> DataFrame:
    """Articles to scored signals; the word lists look at the whole text."""
    label = R.lexicon_label(article_body("Body_Text", "Title"), lexicon)
    return df.select(
        F.col("Source").alias("source"), F.col("Category").alias("category"), F.col("Title").alias("title"),
        F.col("Published_Date").alias("published_date"), label.alias("sentiment"),
        F.round(R.lexicon_confidence(label), 4).alias("confidence"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("ingested_at"))


def dedupe_stream(df: DataFrame, keys: list[str], ts: str, delay: str = "1 hour") -> DataFrame:
    """First row per key; a key is remembered for ``delay`` of event time, so state stays bounded."""
    return df.withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)


def signed_stream(df: DataFrame, fields: list[str]) -> DataFrame:
    return df.withColumn("signature", signature(fields))


# ---- sinks ---------------------------------------------------------------------------------

def _start(writer, **trigger):
    return (writer.trigger(**trigger) if trigger else writer).start()


def to_memory(df: DataFrame, name: str, mode: str = "complete", **trigger):
    return _start(df.writeStream.outputMode(mode).format("memory").queryName(name), **trigger)


def to_console(df: DataFrame, **trigger):
    return _start(df.writeStream.outputMode("complete").format("console").option("truncate", False), **trigger)


def metrics_sink(df: DataFrame, path: str, checkpoint: str, **trigger):
    """Closed windows appended as JSON files (file sinks need append mode, hence a watermark upstream)."""
    flat = df.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *[c for c in df.columns if c != "window"])
    return _start(flat.writeStream.outputMode("append").format("json").option("path", path).option("checkpointLocation", checkpoint), **trigger)


def append_json(df: DataFrame, path: str, checkpoint: str, **trigger):
    return _start(df.writeStream.outputMode("append").format("json").option("path", path).option("checkpointLocation", checkpoint), **trigger)


def append_parquet(df: DataFrame, path: str, checkpoint: str, **trigger):
    return _start(df.writeStream.outputMode("append").format("parquet").option("path", path).option("checkpointLocation", checkpoint), **trigger)


def latest_signals(df: DataFrame, ts: str, n: int = 20, cap: int | None = None, ties: list[str] = ()) -> DataFrame:
    """The ``n`` newest signals of a sink's table; a buffer's size may be given as ``cap``."""
    return df.orderBy(F.desc(ts), *ties).limit(n if cap is None else min(n, cap))
