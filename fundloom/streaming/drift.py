"""Stateful drift detection: the last 50 scores of every source.

Each micro-batch is put in order by Spark's own sort, every source's state in front of its signals; a task then walks
through its sources as a stream and holds one ring at a time. The state is a table with a version per batch, so a batch
that is run again starts from the same state and writes the same rows.
"""

from __future__ import annotations

from collections import deque

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.timeseries import scored_signals
from ..sources.files import path_exists

OUTPUT = ["source", "samples", "mean_score", "negative_ratio", "drift_detected", "retrain_requested", "last_signal_at"]
STATE = "source string, scores array<double>, seen array<string>, last_request double"
WINDOW, SEEN, MIN_SAMPLES, MEAN_LIMIT, SHARE_LIMIT, COOLDOWN = 50, 200, 12, -0.20, 0.60, 1800.0

DONE = pa.schema([("source", pa.string()), ("scores", pa.list_(pa.float64())), ("seen", pa.list_(pa.string())), ("last_request", pa.float64()), ("samples", pa.int64()),
                  ("mean_score", pa.float64()), ("negative_ratio", pa.float64()), ("drift_detected", pa.bool_()), ("retrain_requested", pa.bool_()), ("last_us", pa.int64())])
DONE_SQL = STATE + ", samples long, mean_score double, negative_ratio double, drift_detected boolean, retrain_requested boolean, last_us long"


def _walk(source):
    """Rows by source, its state before its signals: one row per source with the state after them and what it means."""
    name, ring, scores, request_at, latest, begun = None, None, None, None, None, False

    def closed():
        n = len(scores)
        mean = sum(scores) / n if n else 0.0
        share = sum(s < 0 for s in scores) / n if n else 0.0
        drift = n >= MIN_SAMPLES and (mean <= MEAN_LIMIT or share >= SHARE_LIMIT)
        request = bool(drift and latest is not None and (request_at is None or latest / 1e6 - request_at >= COOLDOWN))
        row = (name, list(scores), list(ring), latest / 1e6 if request else request_at, n, round(mean, 4), round(share, 4), drift, request, latest)
        return pa.RecordBatch.from_arrays([pa.array([v], t.type) for v, t in zip(row, DONE)], schema=DONE)

    for batch in source:
        for src, us, signature, score, old, seen, last_request in zip(*(c.to_pylist() for c in batch.columns)):
            if not begun or src != name:
                if begun:
                    yield closed()
                begun, name, ring, scores, request_at, latest = True, src, deque(maxlen=SEEN), deque(maxlen=WINDOW), None, None
            if old is not None:
                ring.extend(seen)
                scores.extend(old)
                request_at = last_request
                continue
            latest = us if us is not None else latest
            if signature not in ring:
                ring.append(signature)
                scores.append(float(score))
    if begun:
        yield closed()


def advance(signals: DataFrame, state: DataFrame, ts: str = "ts") -> DataFrame:
    """State and status of each source that ``signals`` brings something for.

    Signals of a source go through a ring of 200 signatures in order of time (null times last) and signature, so the
    answer is the same however they fall into batches in that order. One source is one task's sorted stream: Spark's sort
    spills it, and the ring is all that is held.
    """
    new = scored_signals(signals).select("source", F.unix_micros(ts).alias("us"), "signature", "direction")
    empty = [F.lit(None).cast(k).alias(c) for c, k in (("scores", "array<double>"), ("seen", "array<string>"), ("last_request", "double"))]
    here = new.select(F.col("source").alias("_source")).distinct()
    known = state.join(here, F.col("source").eqNullSafe(F.col("_source")), "left_semi").select(
        "source", F.lit(None).cast("long").alias("us"), F.lit(None).cast("string").alias("signature"), F.lit(None).cast("double").alias("direction"), "scores", "seen", "last_request")
    rows = new.select("*", *empty).union(known).repartition("source")
    order = [F.col("source"), F.col("scores").isNull(), F.col("us").asc_nulls_last(), F.col("signature")]
    return rows.sortWithinPartitions(*order).mapInArrow(_walk, DONE_SQL)


def _version(path: str, number: int) -> str:
    return f"{path}/version={number}"


def read_state(spark: SparkSession, path: str, before: int) -> DataFrame:
    """The state that batch ``before`` starts from: that of the batch before it, or none."""
    if before > 0 and path_exists(spark, f"{_version(path, before - 1)}/_SUCCESS"):
        return spark.read.schema(STATE).parquet(_version(path, before - 1))
    return spark.createDataFrame([], STATE)


def merge_batch(signals: DataFrame, number: int, state_path: str, out_path: str, ts: str = "ts") -> None:
    """One batch: the status rows go to their own folder below ``out_path``, the state of all sources to a new version."""
    spark = signals.sparkSession
    state = read_state(spark, state_path, number)
    done = advance(signals, state, ts).withColumn("last_signal_at", F.timestamp_micros("last_us")).persist()
    try:
        done.select(OUTPUT).write.mode("overwrite").parquet(f"{out_path}/batch={number}")
        kept = state.join(done.select(F.col("source").alias("_source")), F.col("source").eqNullSafe(F.col("_source")), "left_anti")
        done.select("source", "scores", "seen", "last_request").union(kept).write.mode("overwrite").parquet(_version(state_path, number))
    finally:
        done.unpersist()


def drift_sink(signals: DataFrame, state_path: str, out_path: str, checkpoint: str, ts: str = "ts", **trigger):
    """Starts a stream that appends the drift status of each source after every batch that brings it signals.

    A retrain request comes at most every 30 minutes. The state of a source is 50 scores and 200 signatures, whatever the
    volume; paths lie in a folder that all executors share. ``read_status`` reads the rows.
    """
    writer = signals.writeStream.foreachBatch(lambda df, number: merge_batch(df, number, state_path, out_path, ts)).option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()


def read_status(spark: SparkSession, out_path: str) -> DataFrame:
    return spark.read.option("basePath", out_path).parquet(f"{out_path}/batch=*").select(OUTPUT)
