"""Sorts, limits and top-k, and set operations. Every top-k has a total order, so reruns agree."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F


def topk(df: DataFrame, by: list[str], order: list[Column], k: int, rank: str | None = None) -> DataFrame:
    """First ``k`` rows per group; Spark limits each task to ``k`` rows per group before the shuffle."""
    out = df.withColumn("_rn", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col("_rn") <= k)
    return out.withColumnRenamed("_rn", rank) if rank else out.drop("_rn")


def top_leads(df: DataFrame, n: int, prob: str = "conversion_probability", key: str = "lead_id") -> DataFrame:
    return df.orderBy(F.desc_nulls_last(prob), key).limit(n)


def leads_master(df: DataFrame, threshold: float = 0.65, prob: str = "conversion_probability", key="lead_id") -> DataFrame:
    return df.filter(F.col(prob) >= threshold).orderBy(F.desc(prob), key)


EXPLORE_SORTS = {"Returns (1Y)": "r1", "Returns (3Y)": "r3", "Rating": "rating", "AUM": "aum"}


def explore_funds(df: DataFrame, categories=(), risks=(), min_r1: float = 0.0, sort_by: str = "Returns (1Y)") -> DataFrame:
    if categories:
        df = df.filter(F.col("category_group").isin(list(categories)))
    if risks:
        df = df.filter(F.col("risk").isin(list(risks)))
    return df.filter(F.col("r1") >= min_r1).orderBy(F.desc(EXPLORE_SORTS.get(sort_by, "r1")), "scheme_code")


def gainers_losers(df: DataFrame, change: str, key: str, n: int = 3) -> DataFrame:
    """Best ``n`` by change and worst ``n`` (worst first)."""
    up = df.orderBy(F.desc(change), key).limit(n).withColumn("side", F.lit("gainer"))
    down = df.orderBy(F.asc(change), key).limit(n).withColumn("side", F.lit("loser"))
    return up.unionByName(down)


def latest(df: DataFrame, ts: str, key: str | None = None) -> DataFrame:
    """Newest row of the table; ``key`` settles equal times (largest wins)."""
    order = F.struct(ts, key) if key else F.col(ts)
    return df.agg(F.max_by(F.struct(*df.columns), order).alias("r")).select("r.*")


def union_all(*dfs: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def union_distinct(*dfs: DataFrame, keys: list[str] | None = None) -> DataFrame:
    u = union_all(*dfs)
    return u.distinct() if keys is None else u.dropDuplicates(keys)


def except_keys(incoming: DataFrame, seen: DataFrame, keys: list[str]) -> DataFrame:
    return incoming.join(seen.select(*keys), keys, "left_anti").dropDuplicates(keys)
