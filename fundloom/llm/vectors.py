"""Embedding tables: which rows count as vectors, and vectors as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F


def is_vector(col: str) -> Column:
    """Neither null nor empty nor zero, and without null or non-finite components."""
    ok = F.forall(col, lambda v: F.coalesce(F.abs(v.cast("double")) < float("inf"), F.lit(False)))
    return F.coalesce(ok & F.exists(col, lambda v: v.cast("double") != 0), F.lit(False))


def taken(df: DataFrame, key: str, col: str) -> Column:
    """Whether a row takes part: it has an id, and a vector of the commonest length among vectors (ties: the shorter).

    Only vectors of one length can be compared.
    """
    sizes = df.filter(is_vector(col) & F.col(key).isNotNull()).groupBy(F.size(col).alias("d")).count().orderBy(F.desc("count"), "d").limit(1)
    return is_vector(col) & F.col(key).isNotNull() & F.coalesce(F.size(col) == sizes.select("d").scalar(), F.lit(False))


def vectors(df: DataFrame, key: str, col: str) -> DataFrame:
    """(id, x), x in doubles, of the rows that take part."""
    return df.filter(taken(df, key, col)).select(F.col(key).cast("long").alias("id"), F.col(col).cast("array<double>").alias("x"))


def matrix(column) -> np.ndarray:
    """A column of equally long arrays as a matrix."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))
