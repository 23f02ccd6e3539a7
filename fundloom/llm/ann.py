"""Approximate nearest neighbours by a permutation index.

Every vector is represented by the order in which it sees a fixed set of pivots and posted under its nearest ones: the
inverted file of a pivot holds the vectors that have it among these, and at which place. A query visits the files of its
own nearest pivots only and sums how far the places differ (footrule distance, an absent pivot standing one place after
the last); those it ranks first are scored again with their full vectors.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import record, saved
from .vectors import matrix, vectors

#: Rows of the index and queries that meet in one task, and candidates that a block gives at least, as a multiple of k.
BLOCK, QUERIES, LEAST = 8192, 2048, 12
INDEXED = pa.schema([("id", pa.int64()), ("x", pa.list_(pa.float64())), ("near", pa.binary())])
FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def choose_pivots(sample: np.ndarray, count: int) -> np.ndarray:
    """Unit pivots from a sample: rows in turn, those too like one already chosen last."""
    if not len(sample):
        return sample
    unit = sample / np.linalg.norm(sample, axis=1, keepdims=True)
    chosen, late = [], []
    for k in range(len(unit)):
        if len(chosen) == count:
            break
        (late if chosen and (unit[chosen] @ unit[k]).max() > 0.9 else chosen).append(k)
    return unit[(chosen + late)[:count]]


def lifted(x: np.ndarray, longest: float) -> np.ndarray:
    """Vectors with one more coordinate that makes them equally long, so that the largest inner product is the nearest."""
    x = x / longest
    return np.hstack([x, np.sqrt(np.maximum(0, 1 - np.einsum("ij,ij->i", x, x)))[:, None]])


def nearest_pivots(x: np.ndarray, pivots: np.ndarray, length: int) -> np.ndarray:
    """The ``length`` nearest pivots of each row, nearest first; pivots lie in the lifted space."""
    return np.argsort(-(x @ pivots.T), axis=1, kind="stable")[:, :length].astype("<u2")


def _index(pivots: np.ndarray, longest: float, length: int, queries: bool):
    def run(source):
        for batch in source:
            x = matrix(batch.column(1))
            if len(x):
                up = np.hstack([x, np.zeros((len(x), 1))]) if queries else lifted(x, longest)
                yield record(INDEXED, batch.column(0), batch.column(1).to_pylist(), [p.tobytes() for p in nearest_pivots(up, pivots, length)])
    return run


class Files:
    """The inverted files of a block: for each pivot the rows that have it among their nearest, and at which place."""

    def __init__(self, near: np.ndarray, pivots: int):
        self.rows, self.length = len(near), near.shape[1]
        order = np.argsort(near.ravel(), kind="stable")
        self.row, self.place = order // self.length, (order % self.length).astype(np.int32)
        self.first = np.searchsorted(near.ravel()[order], np.arange(pivots + 1))

    def distances(self, query: np.ndarray) -> np.ndarray:
        """Footrule distance of every row to a query's pivots; rows in none of its files are farthest of all."""
        far = np.full(self.rows, self.length * len(query), np.int32)
        for place, pivot in enumerate(query):
            own = slice(self.first[pivot], self.first[pivot + 1])
            far[self.row[own]] += np.abs(self.place[own] - place) - self.length
        return far


def _search(k: int, share: float, pivots: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table([pa.array([], t.type) for t in FOUND], schema=FOUND)
        qid, vid, q, v = left.column("id").to_numpy(), right.column("id").to_numpy(), matrix(left.column("x")), matrix(right.column("x"))
        near = lambda t: np.frombuffer(b"".join(t.column("near").to_pylist()), "<u2").reshape(t.num_rows, -1).astype(np.int64)
        files, asked = Files(near(right), pivots), near(left)
        wanted, out = min(len(vid), max(LEAST * k + 1, math.ceil(share * len(vid)))), []
        for row in range(len(qid)):
            far = files.distances(asked[row])
            # all that are as near as the last one wanted; rows in none of the files only where there are too few others
            last = np.partition(far, wanted - 1)[wanted - 1]
            some = np.flatnonzero(far <= min(last, files.length * len(asked[row]) - 1))
            some = some if len(some) > k else np.flatnonzero(far <= last)
            some = some[vid[some] != qid[row]]
            score = np.einsum("ij,j->i", v[some], q[row])
            best = np.lexsort((vid[some], -score))[:k]
            out.append((np.full(len(best), qid[row]), vid[some][best], score[best]))
        return pa.table([pa.array(np.concatenate(c)) for c in zip(*out)], schema=FOUND)
    return run


def nearest(df: DataFrame, queries: DataFrame, k: int = 20, pivots: int = 256, length: int = 48, share: float = 0.2, sample: int = 4096,
            key: str = "vec_id", col: str = "embedding") -> DataFrame:
    """query_id, rank, ``key`` and score: the ``k`` rows of ``df`` with the largest inner product found for each query.

    A row is no candidate for a query of the same key. Nearest first, ties to the smaller key. Vectors that are null,
    empty, zero or hold null or non-finite components, or are of another length than most, and rows without a key take no
    part; a repeated row is a candidate each time, a repeated query is asked once. Other columns are not read.

    ``pivots`` come from at most ``sample`` vectors, chosen by hash; every row is indexed, under its ``length`` nearest
    pivots. A query reads the inverted files of as many, and in each block of the index the ``share`` of rows that rank
    first, ties with the last of them included and ``LEAST`` times k at least, is scored in full. Both grow with the data
    alike, so recall does not fall with size.
    """
    rows = vectors(df, key, col)
    asked = vectors(queries, key, col).groupBy("id").agg(F.min("x").alias("x"))
    norm = F.sqrt(F.aggregate("x", F.lit(0.0), lambda s, v: s + v * v))
    n, longest = rows.agg(F.count("*"), F.max(norm)).first()
    some = rows.orderBy(F.xxhash64("id"), "id", "x").limit(sample).toArrow()
    if not n:
        return rows.select(F.col("id").alias("query_id"), F.lit(1).alias("rank"), F.col("id").alias(key), F.lit(0.0).alias("score")).limit(0)
    at = choose_pivots(lifted(matrix(some.column("x")), longest), pivots)
    kinds, length = "id long, x array<double>, near binary", min(length, len(at))
    index, wanted = (saved(r.mapInArrow(_index(at, longest, length, asks), kinds), name) for r, asks, name in ((rows, False, "index"), (asked, True, "queries")))
    blocks, groups = -(-n // BLOCK), max(1, -(-wanted.count() // QUERIES))
    spread = lambda rows, own, n, other, m: rows.withColumn(own, F.pmod(F.xxhash64("id", F.xxhash64("near")), F.lit(n))).withColumn(
        other, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(m - 1).cast("long"))))
    left, right = spread(wanted, "g", groups, "b", blocks), spread(index, "b", blocks, "g", groups)
    found = left.groupBy("g", "b").cogroup(right.groupBy("g", "b")).applyInArrow(_search(k, share, len(at)), "query_id long, vec_id long, score double")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place).filter(F.col("rank") <= k).select("query_id", "rank", F.col("vec_id").alias(key), "score")
