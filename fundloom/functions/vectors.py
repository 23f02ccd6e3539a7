"""Vector arithmetic over array columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .scalars import as_col


def dot(a, b) -> Column:
    pairs = F.zip_with(as_col(a), as_col(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(pairs, F.lit(0.0), lambda acc, x: acc + x)


def norm(a) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a, b) -> Column:
    """0 where either vector has no length."""
    size = norm(a) * norm(b)
    return F.when(size > 0, dot(a, b) / size).otherwise(F.lit(0.0))
