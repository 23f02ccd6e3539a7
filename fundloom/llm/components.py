"""Connected components of a graph given as an edge table, without gathering the graph anywhere."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import record, saved

EDGE = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of an edge list and the smallest node each of them reaches."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    label = np.arange(len(nodes))
    u, v = at[: len(a)], at[len(a):]
    while True:
        low = np.minimum(label[u], label[v])
        new = label.copy()
        np.minimum.at(new, label[u], low)
        np.minimum.at(new, label[v], low)
        np.minimum.at(new, u, low)
        np.minimum.at(new, v, low)
        new = new[new]
        if (new == label).all():
            return nodes, nodes[label]
        label = new


def _forests(source):
    """A block of edges becomes stars around the smallest node of each of its components."""
    for batch in source:
        a, b = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        nodes, low = roots(a, b)
        far = nodes != low
        yield record(EDGE, nodes[far], low[far])


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One round of linking each node's neighbours to the smallest of them: the larger ones, or the others and the node."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges
    # as a table of its own the smaller side is a plain shuffle, so that Spark can split the edges of a hub
    low = saved(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "low")
    near = both.join(low, "a")
    if large:
        return near.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return near.filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select("a", F.col("m").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node that has an edge; component is the smallest node reachable.

    ``edges`` has columns a and b of type long; loops, repeated edges and edges with a null are allowed and ignored.
    Large and small star rounds alternate until the edges are stars; the number of rounds grows with the logarithm of
    the longest path. Each round is saved in the shared folder. Aggregates combine before they shuffle, and the join that
    tells the edges of a node its smallest neighbour is one that Spark splits where a node has very many.
    """
    now = saved(edges.select("a", "b").filter("a != b").mapInArrow(_forests, "a long, b long"), "edges")
    before = None
    while True:
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
        before = mark
        large = _star(now, True).distinct().filter("a != b")
        # small star wants each edge at its larger end
        small = _star(large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), False)
        now = saved(small.filter("a != b").distinct(), "stars")
