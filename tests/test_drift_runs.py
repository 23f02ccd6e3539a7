"""Drift over batches in order is drift over all signals at once, and a batch that is run again changes nothing."""

import datetime as dt
import random
from collections import deque

import pytest
from fundloom.operators.timeseries import scored_signals
from fundloom.streaming import drift
from pyspark.sql import functions as F

SCHEMA = "ts timestamp, title string, source string, sentiment string, market_impact string, confidence double"


def signals(n, seed):
    rng = random.Random(seed)
    start = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    rows = [(start + dt.timedelta(seconds=3 * i), f"t{rng.randrange(300)}", rng.choice(["hot", "hot", "hot", "b", "c", None]), rng.choice(["positive", "negative", "neutral"]),
             rng.choice(["bullish", "bearish", None]), rng.random()) for i in range(n)]
    return rows + [(None, "late", "hot", "negative", None, 1.0)]


def plain(rows):
    """source -> ring and scores, one signal after the other."""
    out = {}
    for r in rows:
        ring, scores = out.setdefault(r.source, (deque(maxlen=drift.SEEN), deque(maxlen=drift.WINDOW)))
        if r.signature not in ring:
            ring.append(r.signature)
            scores.append(r.direction)
    return out


@pytest.mark.parametrize("batches", [1, 4])
def test_batches_in_order_are_one_batch(spark, tmp_path, batches):
    rows = signals(1500, 3)
    state, out = str(tmp_path / "state"), str(tmp_path / "out")
    size = -(-len(rows) // batches)
    for k in range(batches):
        part = spark.createDataFrame(rows[k * size : (k + 1) * size], SCHEMA).repartition(7)
        drift.merge_batch(part, k, state, out)
        if k == 1:
            before = sorted(map(str, spark.read.parquet(f"{state}/version=1").collect()))
            drift.merge_batch(part, k, state, out)
            assert sorted(map(str, spark.read.parquet(f"{state}/version=1").collect())) == before
    scored = scored_signals(spark.createDataFrame(rows, SCHEMA)).orderBy(F.col("ts").asc_nulls_last(), "signature").collect()
    want = plain(scored)
    got = {r.source: r for r in drift.read_state(spark, state, batches).collect()}
    assert set(got) == set(want)
    for source, (ring, scores) in want.items():
        assert got[source].seen == list(ring) and got[source].scores == pytest.approx(list(scores))
    status = {r.source: r for r in spark.read.parquet(f"{out}/batch={batches - 1}").collect()}
    for source, r in status.items():
        assert r.samples == len(want[source][1]) and r.mean_score == pytest.approx(round(sum(want[source][1]) / r.samples, 4))
    assert status["hot"].last_signal_at == max(r[0] for r in rows[:-1] if r[2] == "hot").replace(tzinfo=None)


def test_no_signals(spark, tmp_path):
    drift.merge_batch(spark.createDataFrame([], SCHEMA), 0, str(tmp_path / "s"), str(tmp_path / "o"))
    assert drift.read_state(spark, str(tmp_path / "s"), 1).count() == 0
