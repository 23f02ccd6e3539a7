"""Encoders, scalers, imputation by neighbours, splits."""

from __future__ import annotations

from itertools import product
from math import ceil

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import IDF, HashingTF, MinMaxScaler, OneHotEncoder, RegexTokenizer, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.scalars import safe_div
from .aggregates import target_means
from .joins import spread_lookup
from .ordered import exact_quantiles, global_rank
from .topk import topk


def onehot(df: DataFrame, cols: list[str], drop_first: bool = False) -> DataFrame:
    """Index each category alphabetically and one-hot encode it into ``<col>_vec``; unseen values get their own slot."""
    cols = [c for c in cols if c in df.columns]
    index = StringIndexer(inputCols=cols, outputCols=[f"{c}_idx" for c in cols], handleInvalid="keep", stringOrderType="alphabetAsc")
    hot = OneHotEncoder(inputCols=[f"{c}_idx" for c in cols], outputCols=[f"{c}_vec" for c in cols], dropLast=drop_first)
    return Pipeline(stages=[index, hot]).fit(df).transform(df)


def dummies(df: DataFrame, col: str, values: list | None = None, drop_first: bool = False, most: int = 256) -> DataFrame:
    """0/1 columns per category in alphabetical order: columns are part of the schema, so the categories must be known.

    They are ``values``, or those of the column if it has at most ``most``; a column with more raises an error, and
    ``onehot`` gives it a sparse vector instead.
    """
    if values is None:
        found = df.select(col).filter(F.col(col).isNotNull()).distinct().limit(most + 1).collect()
        if len(found) > most:
            raise ValueError(f"{col} has more than {most} values: name them, or use onehot")
        values = sorted(r[0] for r in found)
    values = values[1:] if drop_first else values
    return df.withColumns({f"{col}_{v}": F.coalesce((F.col(col) == v).cast("int"), F.lit(0)) for v in values})


def label_encode(df: DataFrame, col: str, name: str | None = None) -> DataFrame:
    """Category to its alphabetical position from 0; null counts as the text ``nan``."""
    value = F.coalesce(F.col(col).cast("string"), F.lit("nan"))
    codes = global_rank(df.select(value.alias("_c")).distinct(), ["_c"], "_code")
    return spread_lookup(df.withColumn("_c", value), codes, "_c").withColumn(name or f"{col}_encoded", F.col("_code") - 1).drop("_c", "_code")


def target_encode(df: DataFrame, cat: str, label: str, name: str | None = None) -> DataFrame:
    return spread_lookup(df, target_means(df, cat, label), cat).withColumnRenamed("target_mean", name or f"{cat}_target")


def minmax_vector(df: DataFrame, cols: list[str], out: str = "num_features") -> DataFrame:
    """Complete rows only: assembled and scaled to [0, 1] per column."""
    raw = VectorAssembler(inputCols=cols, outputCol="_raw", handleInvalid="skip")
    return Pipeline(stages=[raw, MinMaxScaler(inputCol="_raw", outputCol=out)]).fit(df).transform(df).drop("_raw")


def standard_scale(df: DataFrame, cols: list[str]) -> DataFrame:
    """z-scores with the population deviation; a constant column becomes 0."""
    s = df.agg(F.struct(*[F.struct(F.avg(c).alias("m"), F.stddev_pop(c).alias("d")).alias(c) for c in cols]).alias("s"))
    out = df.withColumn("_s", s.scalar())
    return out.withColumns({f"{c}_z": F.when(F.col(c).isNotNull(), F.coalesce(
        safe_div(F.col(c) - F.col(f"_s.{c}.m"), F.col(f"_s.{c}.d")), F.lit(0.0))) for c in cols}).drop("_s")


def minmax_scale(df: DataFrame, cols: list[str]) -> DataFrame:
    s = df.agg(F.struct(*[F.struct(F.min(c).alias("lo"), F.max(c).alias("hi")).alias(c) for c in cols]).alias("s"))
    out = df.withColumn("_s", s.scalar())
    return out.withColumns({f"{c}_scaled": F.when(F.col(c).isNotNull(), F.coalesce(safe_div(
        F.col(c) - F.col(f"_s.{c}.lo"), F.col(f"_s.{c}.hi") - F.col(f"_s.{c}.lo")), F.lit(0.0))) for c in cols}).drop("_s")


def robust_scale(df: DataFrame, col: str, name: str | None = None) -> DataFrame:
    """(x - median) / (q75 - q25) with interpolated quantiles; a zero spread divides by 1."""
    q = exact_quantiles(df, [col], [0.25, 0.5, 0.75]).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("prob", "value"))), lambda s: s["value"]).alias("q")).scalar()
    spread = F.coalesce(F.nullif(F.col("_q")[2] - F.col("_q")[0], F.lit(0.0)), F.lit(1.0))
    return df.withColumn("_q", q).withColumn(name or f"{col}_scaled", (F.col(col) - F.col("_q")[1]) / spread).drop("_q")


def hashing_tfidf(df: DataFrame, text_col: str, features: int = 1 << 16) -> PipelineModel:
    words = RegexTokenizer(inputCol=text_col, outputCol="words", pattern=r"\s+")
    return Pipeline(stages=[words, HashingTF(inputCol="words", outputCol="tf", numFeatures=features),
                            IDF(inputCol="tf", outputCol="tfidf")]).fit(df)


def positive_entries(col: str) -> Column:
    """How many entries of a vector are above zero; only stored entries are visited, not one slot per feature."""
    return F.udf(lambda v: None if v is None else int((v.values > 0).sum()), T.IntegerType())(col)


def stratified_split(df: DataFrame, label: str, key: str, test: float = 0.2, seed: int = 42) -> DataFrame:
    """``is_test`` marks ceil(test * n) rows of every class, chosen by a hash of the key."""
    take = _by_class(df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.ceil(F.count("*") * test).alias("_take")), label, "_take")
    order = df.withColumn("_h", F.xxhash64(F.col(key), F.lit(seed)))
    ranked = global_rank(order, ["_h", key], "_rank", by=[label])
    ranked = ranked.filter(F.col(label).isNotNull()).withColumn("_takes", take)
    return ranked.withColumn("is_test", F.col("_rank") <= F.col("_takes")[F.col(label)]).drop("_h", "_rank", "_takes")


def _by_class(per: DataFrame, label: str, value: str) -> Column:
    """One value per class as a map in the plan, so that no row moves to the few tasks that a join on the label has."""
    return per.agg(F.map_from_entries(F.collect_list(F.struct(label, value)))).scalar()


def stratified_folds(df: DataFrame, label: str, key: str, folds: int = 5, seed: int = 42) -> DataFrame:
    """Column ``fold``: every class spread evenly over the folds."""
    order = df.withColumn("_h", F.xxhash64(F.col(key), F.lit(seed)))
    ranked = global_rank(order, ["_h", key], "_rank", by=[label])
    return ranked.withColumn("fold", F.pmod(F.col("_rank"), F.lit(folds)).cast("int")).drop("_h", "_rank")


def class_weights(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """n / (classes * n_class) per row."""
    per = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("_n"))
    whole = per.agg(F.struct(F.sum("_n").alias("n"), F.count("*").alias("k")).alias("s")).scalar()
    per = per.withColumn("_w", whole).select(label, (F.col("_w.n") / (F.col("_w.k") * F.col("_n"))).alias(name))
    known = df.filter(F.col(label).isNotNull()).withColumn("_weights", _by_class(per, label, name))
    return known.withColumn(name, F.col("_weights")[F.col(label)]).drop("_weights")


def _patterns(v: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Which columns are present, and the rows for which it is these."""
    kinds, which = np.unique(~np.isnan(v), axis=0, return_inverse=True)
    return [(have, np.flatnonzero(which.ravel() == i)) for i, have in enumerate(kinds)]


def _boxes(v: np.ndarray, most: int) -> list[np.ndarray]:
    """Rows in boxes of at most ``most``, halved along the widest side."""
    todo, done = [np.arange(len(v))], []
    while todo:
        rows = todo.pop()
        if len(rows) <= most:
            done.append(rows)
            continue
        part = v[rows]
        half = len(rows) // 2
        cut = np.argpartition(part[:, np.argmax(part.max(axis=0) - part.min(axis=0))], half)
        todo += [rows[cut[:half]], rows[cut[half:]]]
    return done


def _closest(x: np.ndarray, y: np.ndarray, ida: np.ndarray, idb: np.ndarray, k: int, by: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of x, row of y, distance) of the ``k`` nearest of other ids to each x, equal distances by id; squares count ``by``."""
    far = _boxes(y, 256)
    low, high = (np.array([f(y[rows], axis=0) for rows in far]) for f in (np.min, np.max))
    found = []
    for mine in _boxes(x, 64):
        p, names = x[mine], ida[mine]
        # no pair of the two boxes is nearer; the sums are rounded, so a hair is left
        gap = np.maximum(0, np.maximum(low - p.max(axis=0), p.min(axis=0) - high))
        least = np.sqrt((gap**2).sum(axis=1) * by) * (1 - 1e-9)
        row, to, dist = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
        reach = np.full(len(mine), np.inf)
        for box in np.argsort(least, kind="stable"):
            if least[box] > reach.max():
                break
            rows = far[box]
            # the columns one by one, so that equal rows have equal distances whatever the box
            total = np.zeros((len(mine), len(rows)))
            for c in range(p.shape[1]):
                total += (y[rows, c] - p[:, c : c + 1]) ** 2
            near = np.sqrt(total * by)
            i, j = np.nonzero((near <= reach[:, None]) & (idb[rows] != names[:, None]))
            row, to, dist = np.concatenate([row, i]), np.concatenate([to, rows[j]]), np.concatenate([dist, near[i, j]])
            order = np.lexsort((idb[to], dist, row))
            row, to, dist = row[order], to[order], dist[order]
            place = np.arange(len(row)) - np.searchsorted(row, row)
            keep = place < k
            last = place == k - 1
            reach[row[last]] = dist[last]
            row, to, dist = row[keep], to[keep], dist[keep]
        found.append((mine[row], to, dist))
    return tuple(np.concatenate(c) for c in zip(*found))


def knn_impute(df: DataFrame, key: str, cols: list[str], k: int = 5, block: int = 1 << 17) -> DataFrame:
    """Missing cells become the mean of the ``k`` nearest rows that have the value.

    Distance is Euclidean over the columns both rows have, scaled up for the missing ones; equal distances go to the
    smaller key. A column without any value becomes 0; a cell with no comparable row takes the column mean. Incomplete
    rows meet all donors block by block; each block pair returns only its best ``k`` per cell and set of columns that
    donors have. Within a pair, rows and donors lie in small boxes, and boxes too far to hold one of the best are skipped.
    """
    d = len(cols)
    as_d = [F.col(c).cast("double").alias(c) for c in cols]
    holes = F.exists(F.array(*as_d), lambda v: v.isNull())
    base = df.select(F.col(key).alias("_id"), F.array(*as_d).alias("v"))
    gaps = df.filter(holes).select(F.col(key).alias("_id"), F.array(*as_d).alias("v"))
    sizes = df.agg(F.count("*").alias("n"), F.count_if(holes).alias("g")).first()
    nd, ng = max(1, ceil(sizes["n"] / block)), max(1, ceil(sizes["g"] / block))
    slot = lambda n: F.pmod(F.xxhash64("_id"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = gaps.withColumn("gb", slot(ng)).withColumn("db", every(nd))
    right = base.withColumn("db", slot(nd)).withColumn("gb", every(ng))

    def nearest(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(a) and len(b):
            (ida, x), (idb, y) = ((p["_id"].to_numpy(), np.array(p["v"].tolist(), dtype=np.float64)) for p in (a, b))
            for (need, rows), (has, donors) in product(_patterns(x), _patterns(y)):
                shared, cells = np.flatnonzero(need & has), np.flatnonzero(~need & has)
                if len(shared) and len(cells):
                    at, to, dist = _closest(x[rows][:, shared], y[donors][:, shared], ida[rows], idb[donors], k, d / len(shared))
                    at, to = rows[at], donors[to]
                    out += [pd.DataFrame({"_id": ida[at], "c": np.int32(c), "dist": dist, "donor": idb[to], "val": y[to, c]}) for c in cells]
        if out:
            return pd.concat(out, ignore_index=True)
        return pd.DataFrame({"_id": a["_id"][:0], "c": pd.Series(dtype="int32"), "dist": pd.Series(dtype="float64"),
                             "donor": b["_id"][:0], "val": pd.Series(dtype="float64")})

    kt = df.schema[key].dataType.simpleString()
    found = left.groupBy("gb", "db").cogroup(right.groupBy("gb", "db")).applyInPandas(
        nearest, f"_id {kt}, c int, dist double, donor {kt}, val double")
    best = topk(found, ["_id", "c"], [F.col("dist"), F.col("donor")], k)
    fills = best.groupBy("_id").agg(*[F.avg(F.when(F.col("c") == i, F.col("val"))).alias(f"_f{i}") for i in range(d)])
    means = df.agg(F.struct(*[F.avg(F.col(c).cast("double")).alias(c) for c in cols]).alias("s")).scalar()
    out = df.join(fills.withColumnRenamed("_id", key), key, "left").withColumn("_m", means)
    return out.withColumns({c: F.coalesce(F.col(c).cast("double"), F.col(f"_f{i}"), F.col(f"_m.`{c}`"), F.lit(0.0))
                            for i, c in enumerate(cols)}).drop("_m", *[f"_f{i}" for i in range(d)])
