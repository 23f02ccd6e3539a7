"""Item co-occurrence and recommendations from distinct (user, item) pairs."""

from __future__ import annotations

from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..sources.scratch import cut_lineage
from .aggregates import popular_items
from .topk import topk


def _blocks(pairs: DataFrame, user_block: int, item_block: int) -> tuple[int, int]:
    size = pairs.agg(F.approx_count_distinct("user").alias("u"), F.approx_count_distinct("item").alias("i")).first()
    return max(1, ceil(size["u"] / user_block)), max(1, ceil(size["i"] / item_block))


def _slot(col: str, n: int):
    return F.pmod(F.xxhash64(col), F.lit(n)).cast("int")


def _every(n: int):
    return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))


def _incidence(user: np.ndarray, n_users: int, item: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    codes, names = pd.factorize(item, sort=True)
    m = np.zeros((n_users, len(names)), dtype=np.float32)
    m[user, codes] = 1
    return m, np.asarray(names, dtype=object)


def cooccurrence(pairs: DataFrame, user_block: int = 4096, item_block: int = 2048, blocks: tuple[int, int] | None = None) -> DataFrame:
    """(item, other, users): how many users hold both, an item with itself included.

    A self-join would square every user's basket. Here users and items are hashed into blocks; one group is the 0/1
    matrix of a user block over two item blocks, of bounded size whatever the skew, and its product is already summed
    over the block's users when it leaves the task.
    """
    if blocks is None:
        # sized and then read: written once rather than derived twice
        pairs = cut_lineage(pairs.select("user", "item"))
        blocks = _blocks(pairs, user_block, item_block)
    nu, ni = blocks
    keyed = pairs.select("user", "item", _slot("user", nu).alias("ub"), _slot("item", ni).alias("ib")).withColumn("other", _every(ni))
    keyed = keyed.select("user", "item", "ub", "ib", F.least("ib", "other").alias("a"), F.greatest("ib", "other").alias("b"))

    def product(pdf: pd.DataFrame) -> pd.DataFrame:
        a, b = pdf["a"].iloc[0], pdf["b"].iloc[0]
        user, _ = pd.factorize(pdf["user"])
        part = lambda block: (lambda m: _incidence(user[m], user.max() + 1, pdf["item"][m]))((pdf["ib"] == block).to_numpy())
        left, lnames = part(a)
        right, rnames = (left, lnames) if a == b else part(b)
        counts = left.T @ right
        i, j = np.nonzero(counts)
        x, y, n = lnames[i], rnames[j], counts[i, j].astype(np.int64)
        if a != b:
            x, y, n = np.concatenate([x, y]), np.concatenate([y, x]), np.concatenate([n, n])
        return pd.DataFrame({"item": x, "other": y, "users": n})

    part = keyed.groupBy("ub", "a", "b").applyInPandas(product, "item string, other string, users long")
    return part.groupBy("item", "other").agg(F.sum("users").alias("users"))


def cooccurrence_scores(pairs: DataFrame, counts: DataFrame | None = None, mine: DataFrame | None = None, k: int | None = None,
                        user_block: int = 4096, item_block: int = 2048) -> DataFrame:
    """(user, item, score) for items the user does not hold: how often they go with the user's own items.

    ``mine`` limits the users scored; ``k`` keeps each user's best. A block of users times a block of the counts is one
    matrix product, so no row per (user, own item, candidate) is ever shuffled. While all items fit one block the task
    sees a user's every score and cuts to ``k`` itself.
    """
    return _saved_scores(cut_lineage(pairs.select("user", "item")), counts, mine, k, user_block, item_block)


def _saved_scores(pairs: DataFrame, counts: DataFrame | None = None, mine: DataFrame | None = None, k: int | None = None,
                  user_block: int = 4096, item_block: int = 2048) -> DataFrame:
    """``cooccurrence_scores`` over pairs that are saved already."""
    blocks = _blocks(pairs, user_block, item_block)
    nu, ni = blocks
    counts = cooccurrence(pairs, blocks=blocks) if counts is None else counts
    rows = (pairs if mine is None else mine).select("user", "item", _slot("user", nu).alias("ub"), _slot("item", ni).alias("a"))
    rows = rows.withColumn("b", _every(ni))
    grid = counts.select(F.col("item").alias("held"), "other", "users", _slot("item", ni).alias("a"), _slot("other", ni).alias("b")).withColumn("ub", _every(nu))
    cut = k if ni == 1 else None

    def score(r: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        if r.empty or c.empty:
            return pd.DataFrame({"user": [], "item": [], "score": []})
        hi, held = pd.factorize(c["held"], sort=True)
        oi, other = pd.factorize(c["other"], sort=True)
        table = np.zeros((len(held), len(other)), dtype=np.float64)
        table[hi, oi] = c["users"]
        at = pd.Index(held).get_indexer(r["item"])
        users, names = pd.factorize(r["user"])
        ok = at >= 0
        m = np.zeros((len(names), len(held)))
        m[users[ok], at[ok]] = 1
        s = m @ table
        # the user's own items are no candidates (own items of other blocks go with the anti-join below)
        own = pd.Index(other).get_indexer(r["item"])
        s[users[own >= 0], own[own >= 0]] = 0
        names, other = np.asarray(names, dtype=object), np.asarray(other, dtype=object)
        if cut is not None and cut < len(other):
            # columns are in item order, so a stable sort settles ties by item
            j = np.argsort(-s, axis=1, kind="stable")[:, :cut]
            i = np.repeat(np.arange(len(names)), j.shape[1])
            j = j.ravel()
            keep = s[i, j] > 0
            i, j = i[keep], j[keep]
        else:
            i, j = np.nonzero(s)
        return pd.DataFrame({"user": names[i], "item": other[j], "score": s[i, j]})

    ks = ["ub", "a", "b"]
    out = rows.groupBy(*ks).cogroup(grid.groupBy(*ks)).applyInPandas(score, "user string, item string, score double")
    if ni > 1:
        out = out.groupBy("user", "item").agg(F.sum("score").alias("score")).join(pairs, ["user", "item"], "left_anti")
    return out


def collab_recommend(pairs: DataFrame, users: DataFrame, k: int = 5) -> DataFrame:
    """Top ``k`` items per user by co-occurrence; users without history get the most popular items."""
    # read for their size, counts, scores, popular items and users with a history: derived once
    pairs = cut_lineage(pairs.select("user", "item"))
    wanted = users.select(F.col("user").cast("string").alias("user")).distinct()
    mine = pairs.join(wanted, "user", "left_semi")
    own = topk(_saved_scores(pairs, mine=mine, k=k), ["user"], [F.desc("score"), F.col("item")], k, rank="rank")
    top = popular_items(pairs, k).agg(F.array_sort(F.collect_list(
        F.struct((-F.col("score")).alias("neg"), F.col("item").alias("item")))).alias("p")).scalar()
    cold = wanted.join(pairs.select("user").distinct(), "user", "left_anti").select("user", top.alias("_p"))
    cold = cold.select("user", F.posexplode("_p").alias("pos", "p"))
    cold = cold.select("user", F.col("p.item").alias("item"), (-F.col("p.neg")).alias("score"), (F.col("pos") + 1).alias("rank"))
    return own.select("user", "item", "score", "rank").unionByName(cold)
