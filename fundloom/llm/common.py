"""What the operators of this package share: worker state, saved tables, documents as bytes."""

from __future__ import annotations

import sys
import types
import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..sources.scratch import checkpoint_dir


def worker_state(name: str, make: Callable):
    """An object that a Python worker keeps from task to task. Functions travel by value, so their globals do not last.

    A worker keeps one such object: what operators remember in the stages of a job does not add up.
    """
    home = sys.modules.setdefault("_fundloom_worker", types.ModuleType("_fundloom_worker"))
    if not hasattr(home, name):
        for old in [k for k in vars(home) if not k.startswith("__")]:
            delattr(home, old)
        setattr(home, name, make())
    return getattr(home, name)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one that the session names."""
    return f"{checkpoint_dir(spark).rstrip('/')}/fundloom-{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """The frame written to the shared folder and read back: computed once, and safe from lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_of(col: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores in front as it takes not to clash with a column of the frame."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def batches(source, limit: int = 4 << 20):
    """Record batches cut so that none holds much more than ``limit`` bytes; a single row is never cut."""
    for batch in source:
        n = batch.num_rows
        step = max(1, int(n * limit / max(batch.nbytes, limit)))
        for at in range(0, n, step):
            yield batch.slice(at, step)


def record(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, t.type) for c, t in zip(columns, schema)], schema=schema)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection on unsigned 64-bit integers that spreads every bit over the word."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def spans_take(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices starts[i] .. starts[i] + lengths[i] - 1 of all i in order."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)
