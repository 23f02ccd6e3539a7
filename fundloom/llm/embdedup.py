"""Near-duplicate embeddings by tile products of int8 codes with rigorous error bounds.

Unit vectors are rounded to 8 bits with a scale of their own; the length of what rounding lost is kept with the codes.
A product of codes then bounds the cosine from both sides: |u.v - su sv qu.qv| <= eu + ev + eu ev. Pairs that the bounds
decide are done; only the others are computed again from the full vectors. Equal vectors are one class from the start.
A tile gives, for each of its vectors, how many links it has there and the smallest vector it reaches there: never pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import saved
from .components import components
from .vectors import matrix, taken, vectors

#: Vectors on one side of a tile, and rows of it that are multiplied at a time.
TILE, STRIP = 4096, 512
FOUND = pa.schema([("cls", pa.int64()), ("links", pa.int64()), ("id", pa.int64()), ("root", pa.int64())])


def quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Unit vectors, int8 codes, scales and the lengths of the rounding errors."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    unit = x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]
    scale = np.abs(unit).max(axis=1) / 127
    codes = np.rint(unit / scale[:, None]).astype(np.int8)
    lost = unit - codes * scale[:, None]
    # a little more than computed, for the rounding of doubles themselves
    return unit, codes, scale, np.sqrt(np.einsum("ij,ij->i", lost, lost)) * (1 + 1e-9) + 1e-12


def links(x: np.ndarray, y: np.ndarray, threshold: float) -> np.ndarray:
    """Which rows of x and y have a cosine of at least the threshold, as a boolean matrix."""
    ux, qx, sx, ex = quantised(x)
    uy, qy, sy, ey = quantised(y)
    qx, qy = qx.astype(np.float32), qy.astype(np.float32)
    out = np.zeros((len(x), len(y)), bool)
    for at in range(0, len(x), STRIP):
        part = slice(at, at + STRIP)
        # whole numbers below 2**24: exact in single precision
        near = (qx[part] @ qy.T) * (sx[part, None] * sy[None])
        bound = ex[part, None] + ey[None] + ex[part, None] * ey[None]
        out[part] = near - bound >= threshold
        a, b = np.nonzero((near + bound >= threshold) & ~out[part])
        for k in range(0, len(a), 1 << 16):
            i, j = a[k : k + (1 << 16)] + at, b[k : k + (1 << 16)]
            out[i, j] = np.einsum("ij,ij->i", ux[i], uy[j]) >= threshold
    return out


def _roots(linked: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The smallest of the numbers left and right that each row and each column reaches."""
    far = np.iinfo(np.int64).max
    left, right = left.copy(), right.copy()
    while True:
        before = left.sum(), right.sum()
        for at in range(0, len(left), STRIP):
            part = slice(at, at + STRIP)
            left[part] = np.minimum(left[part], np.where(linked[part], right[None], far).min(axis=1, initial=far))
            right = np.minimum(right, np.where(linked[part], left[part, None], far).min(axis=0, initial=far))
        if before == (left.sum(), right.sum()):
            return left, right


def _tile(threshold: float):
    def run(table: pa.Table) -> pa.Table:
        cls, ids, part, copies = (table.column(c).to_numpy() for c in ("cls", "id", "part", "copies"))
        x, i, j = matrix(table.column("x")), table.column("i")[0].as_py(), table.column("j")[0].as_py()
        a, b = np.flatnonzero(part == i), np.flatnonzero(part == j)
        found = links(x[a], x[b], threshold)
        if i == j:
            np.fill_diagonal(found, False)
        rows, cols = np.flatnonzero(found.any(axis=1)), np.flatnonzero(found.any(axis=0))
        found = found[np.ix_(rows, cols)]
        left, right = _roots(found, ids[a[rows]], ids[b[cols]])
        n = found @ copies[b[cols]]
        out = [(cls[a[rows]], n, ids[a[rows]], left)]
        if i != j:
            out.append((cls[b[cols]], copies[a[rows]] @ found, ids[b[cols]], right))
        return pa.table([pa.array(np.concatenate(v).astype(np.int64)) for v in zip(*out)], schema=FOUND)
    return run


def near_vectors(df: DataFrame, key: str = "vec_id", col: str = "embedding", threshold: float = 0.9) -> DataFrame:
    """``key``, n_links, component_id and kept for each row of ``df``.

    Rows are linked if the cosine of their vectors, in doubles, is at least ``threshold``; n_links counts the other rows a
    row is linked with, component_id is the smallest key that links reach, kept whether that is the row's own. Vectors
    that are null, empty, zero or hold null or non-finite components, and ones of another length than most, link with
    nothing. Rows that repeat a key count as several vectors and share a component; rows without a key have a null one
    and are kept. Other columns are not read.

    Every pair of tiles is multiplied, so the work is the square of the number of distinct vectors, in tasks of bounded
    memory; what leaves a tile is bounded by its rows.
    """
    rows = saved(vectors(df, key, col), "vectors")
    classes = saved(rows.groupBy("x").agg(F.min("id").alias("id"), F.count("*").alias("copies")).withColumn("cls", F.monotonically_increasing_id()), "vector-classes")
    g = max(1, -(-classes.count() // TILE))
    tiled = (
        classes.withColumn("part", F.pmod(F.xxhash64("cls"), F.lit(g)).cast("int")).withColumn("o", F.explode(F.sequence(F.lit(0), F.lit(g - 1))))
        .select("cls", "id", "x", "copies", "part", F.least("part", "o").alias("i"), F.greatest("part", "o").alias("j"))
    )
    found = saved(tiled.groupBy("i", "j").applyInArrow(_tile(threshold), "cls long, links long, id long, root long"), "vector-links")
    members = saved(rows.join(classes, "x").select(rows.id, "cls", classes.id.alias("rep"), "copies"), "vector-members")
    edges = found.select(F.col("id").alias("a"), F.col("root").alias("b")).union(members.select(F.col("id").alias("a"), F.col("rep").alias("b")))
    reached = components(edges).select(F.col("node").alias("id"), "component")
    counted = members.join(found.groupBy("cls").agg(F.sum("links").alias("links")), "cls", "left").select(
        "id", "cls", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"))
    linked = counted.join(reached, "id", "left").select("id", "links", "component")
    none = df.filter(~taken(df, key, col)).select(F.col(key).cast("long").alias("id"), F.lit(0).cast("long").alias("links"))
    return (
        linked.union(none.join(reached, "id", "left").select("id", "links", "component"))
        .select(F.col("id").alias(key), F.col("links").alias("n_links"), F.coalesce("component", "id").alias("component_id"),
                F.coalesce(F.coalesce("component", "id") == F.col("id"), F.lit(True)).alias("kept"))
    )
