"""Investor personas by k-means, choice of k, stability, PCA, and density clusters."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA, MinMaxScaler, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from ..sources.scratch import cut_lineage
from . import means
from .filters import complete_cases
from .ordered import global_rank


def persona_pipeline(cols: list[str], k: int, scale: str = "minmax", seed: int = 42) -> Pipeline:
    raw = VectorAssembler(inputCols=cols, outputCol="raw", handleInvalid="skip")
    scaler = (MinMaxScaler(inputCol="raw", outputCol="features") if scale == "minmax"
              else StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=True))
    return Pipeline(stages=[raw, scaler, KMeans(k=k, seed=seed, featuresCol="features", predictionCol="cluster")])


def fit_personas(df: DataFrame, cols: list[str], k: int = 4, scale: str = "minmax", seed: int = 42, starts: int = 10) -> means.PersonaModel:
    """The cheapest of ``starts`` k-means models, all moved in the same passes."""
    points, shape = means.scaled(df, cols, scale)
    points = points.persist()
    try:
        found = means.best(means.settle(points, [means.Start(k, seed + i) for i in range(starts)], len(cols)))[0]
    finally:
        points.unpersist()
    centres = () if found.centres is None else tuple(map(tuple, found.centres.tolist()))
    # digits after the twelfth depend on which models shared a product
    return means.PersonaModel(tuple(cols), tuple(shape), centres, float(f"{found.cost:.12g}"))


def choose_k(df: DataFrame, cols: list[str], ks=range(2, 11), cap: int = 3, scale: str = "minmax", starts: int = 10) -> tuple[int, DataFrame]:
    """Inertia and silhouette per k, best of ``starts``; the k of the best silhouette, at most ``cap``. All models share each pass."""
    points, _ = means.scaled(df, cols, scale)
    points = points.persist()
    try:
        chosen = means.best(means.settle(points, [means.Start(k, 42 + i) for k in ks for i in range(starts)], len(cols)))
        rows = [(s.k, *r) for s, r in zip(chosen, means.silhouettes(points, chosen, len(cols)))]
    finally:
        points.unpersist()
    return min(max(rows, key=lambda r: r[2])[0], cap), df.sparkSession.createDataFrame(rows, "k int, inertia double, silhouette double")


def stability_runs(df: DataFrame, cols: list[str], k: int, n: int = 100, frac: float = 0.8, scale: str = "minmax", starts: int = 10) -> DataFrame:
    """(run, silhouette) of ``n`` resamples with replacement, each fitted anew from ``starts`` starts; all share each pass."""
    points, _ = means.scaled(df, cols, scale)
    points = points.persist()
    try:
        chosen = means.best(means.settle(points, [means.Start(k, 42 + i, r) for r in range(n) for i in range(starts)], len(cols), frac))
        rows = [(s.resample, r[1]) for s, r in zip(chosen, means.silhouettes(points, chosen, len(cols), frac))]
    finally:
        points.unpersist()
    return df.sparkSession.createDataFrame(rows, "run int, silhouette double")


def cluster_stability(df: DataFrame, cols: list[str], k: int, n: int = 100, frac: float = 0.8, scale: str = "minmax", starts: int = 10) -> DataFrame:
    """Silhouettes over resamples: mean, deviation, extremes."""
    return stability_runs(df, cols, k, n, frac, scale, starts).agg(
        F.count("*").alias("runs"), F.avg("silhouette").alias("mean_silhouette"), F.stddev_pop("silhouette").alias("std_silhouette"),
        F.min("silhouette").alias("min_silhouette"), F.max("silhouette").alias("max_silhouette"))


def pca_2d(df: DataFrame, key: str, cols: list[str], scale: str = "minmax") -> DataFrame:
    """First two components per row with the share of variance each explains."""
    stages = persona_pipeline(cols, 2, scale).getStages()[:2] + [PCA(k=2, inputCol="features", outputCol="pc")]
    model = Pipeline(stages=stages).fit(complete_cases(df, cols))
    share = model.stages[-1].explainedVariance.toArray()
    v = vector_to_array("pc")
    return model.transform(df).select(key, v[0].alias("pc1"), v[1].alias("pc2"),
                                      F.lit(float(share[0])).alias("share1"), F.lit(float(share[1])).alias("share2"))


# ---- density clusters ----------------------------------------------------------------------

def connected_components(nodes: DataFrame, edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(node, component): the smallest node of each component, by repeated minimum over neighbours and shortcuts.

    Every round is written to the checkpoint folder, so a lost executor costs one round at most.
    """
    e = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    e = cut_lineage(e)
    label = cut_lineage(nodes.select("node", F.col("node").alias("component")))
    for _ in range(max_rounds):
        near = e.join(label, e["a"] == label["node"]).groupBy("b").agg(F.min("component").alias("c"))
        step = label.join(near, label["node"] == near["b"], "left").select(
            "node", F.least("component", F.coalesce("c", "component")).alias("component"))
        # shortcut: take the component of one's component
        hop = step.select(F.col("node").alias("h"), F.col("component").alias("hc"))
        step = step.join(hop, step["component"] == hop["h"], "left").select(
            "node", F.least("component", F.coalesce("hc", "component")).alias("component"))
        step = cut_lineage(step)
        changed = step.join(label.withColumnRenamed("component", "old"), "node").filter("component <> old").limit(1).count()
        label = step
        if not changed:
            return label
    raise RuntimeError("components did not settle; raise max_rounds")


def density_cluster(df: DataFrame, key: str, cols: list[str], eps: float = 0.35, min_pts: int = 10, chunk: int = 2048) -> DataFrame:
    """DBSCAN labels (-1 is noise) without pairs of rows leaving a task.

    Points lie in cells so small that all points of a cell are neighbours: a full cell is core without any distance.
    For the rest, space is cut into tiles; a tile's points meet those of the tile and of an ``eps`` rim around it, in
    chunks of bounded size, and a meeting returns one count, one label or one edge per cell pair. Cells of core points
    meet by their outermost points first, so dense cells are not compared point by point. Clusters are numbered by their
    smallest cell; a border point joins the smallest cluster in reach.
    """
    d, kt = len(cols), df.schema[key].dataType.simpleString()
    side = eps / d ** 0.5 * (1 - 1e-9)
    pts = complete_cases(df, cols).select(F.col(key).alias("id"), F.array(*[F.col(c).cast("double") for c in cols]).alias("x"))
    pts = pts.withColumn("cell", F.concat_ws(",", F.transform("x", lambda v: F.floor(v / side).cast("string"))))
    m = min(d, 3)
    shape = df.agg(F.count("*"), *[F.max(c) - F.min(c) for c in cols[:m]]).first()
    # tiles of about half a chunk each, but never thinner than eps
    per_dim = max(1.0, (2 * (shape[0] or 1) / chunk) ** (1 / m))
    sides = [max(eps, float(shape[i + 1] or 0.0) / per_dim) * (1 + 1e-9) for i in range(m)]
    tile = F.array(*[F.floor(F.col("x")[i] / w) for i, w in enumerate(sides)])
    size = pts.groupBy("cell").agg(F.count("*").alias("n"))
    pts = cut_lineage(pts.join(size, "cell").withColumn("full", F.col("n") >= min_pts).withColumn("tile", tile).drop("n"))

    counts = _meet(pts.filter("not full"), pts, sides, eps, chunk, _count_near(eps), f"id {kt}, n long")
    counted = counts.groupBy("id").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_pts).select("id")
    core = cut_lineage(pts.filter("full").unionByName(pts.filter("not full").join(counted, "id", "left_semi")))
    comp = _linked_cells(core, d, sides, eps, side, chunk)
    owned = core.join(comp.withColumnRenamed("node", "cell"), "cell")
    rest = pts.join(core.select("id"), "id", "left_anti")
    border = _meet(rest, owned, sides, eps, chunk, _nearest_label(eps), f"id {kt}, component string")
    named = owned.select("id", "component").unionByName(border.groupBy("id").agg(F.min("component").alias("component")))
    numbers = global_rank(comp.select("component").distinct(), ["component"], "no")
    named = named.join(numbers, "component").select("id", (F.col("no") - 1).alias("cluster"))
    return pts.select("id").join(named, "id", "left").select(F.col("id").alias(key), F.coalesce("cluster", F.lit(-1)).alias("cluster"))


def _linked_cells(core: DataFrame, d: int, sides: list[float], eps: float, side: float, chunk: int) -> DataFrame:
    """(node, component) of the cells of core points; two cells are linked if a point of one is near a point of the other.

    One row per cell settles nearly all pairs: the outermost points of two cells are near, or their boxes are too far
    apart. Points only meet for pairs that this leaves open and that lie in different components so far.
    """
    ends = [f("x", F.col("x")[i]) for i in range(d) for f in (F.min_by, F.max_by)]
    # rows are found by the first of their points, which lies anywhere in the cell
    reach = eps + 2 * side
    wide = [max(w, reach * (1 + 1e-9)) for w in sides]
    cells = core.groupBy("cell").agg(F.flatten(F.array(*ends)).alias("x")).withColumn("id", F.col("cell"))
    cells = cut_lineage(cells.withColumn("tile", F.array(*[F.floor(F.col("x")[i] / w) for i, w in enumerate(wide)])))
    nodes = cells.select(F.col("cell").alias("node"))
    met = cut_lineage(_meet(cells, cells, wide, reach, chunk, _outer_points_near(eps, d), "a string, b string, sure boolean"))
    sure = met.filter("sure").select("a", "b")
    comp = connected_components(nodes, sure)
    of = lambda c: comp.select(F.col("node").alias(c), F.col("component").alias(f"{c}_of"))
    left = met.filter("not sure").join(of("a"), "a").join(of("b"), "b").filter("a_of <> b_of")
    left = cut_lineage(left.select(F.explode(F.array("a", "b")).alias("cell")).distinct())
    if left.isEmpty():
        return comp
    some = core.join(left, "cell", "left_semi")
    return connected_components(nodes, sure.unionByName(_meet(some, some, sides, eps, chunk, _touching(eps), "a string, b string")))


def _meet(left: DataFrame, right: DataFrame, sides: list[float], eps: float, chunk: int, fn, schema: str) -> DataFrame:
    """Runs ``fn`` on a chunk of a tile's left points and a chunk of the right points in the tile or its rim."""
    l = left.select("id", "x", "cell", "tile")
    r = right.select(F.col("id").alias("rid"), F.col("x").alias("y"), F.col("cell").alias("other"), "tile",
                     *[F.col(c) for c in ("component",) if c in right.columns])
    for i, w in enumerate(sides):
        # a point within eps of a face also belongs to the rim of the tile behind it
        steps = F.array_compact(F.array(F.lit(0), F.when(F.col("y")[i] - F.col("tile")[i] * w <= eps, F.lit(-1)),
                                        F.when((F.col("tile")[i] + 1) * w - F.col("y")[i] <= eps, F.lit(1))))
        r = r.withColumn("_s", F.explode(steps)).withColumn(f"_t{i}", F.col("tile")[i] + F.col("_s")).drop("_s")
    r = r.withColumn("tile", F.array(*[F.col(f"_t{i}") for i in range(len(sides))])).drop(*[f"_t{i}" for i in range(len(sides))])
    parts = lambda df, name: df.groupBy("tile").agg(F.ceil(F.count("*") / chunk).cast("int").alias(name))
    n = parts(l, "lp").join(parts(r, "rp"), "tile")
    every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    l = l.join(n, "tile").withColumn("li", F.pmod(F.xxhash64("id"), F.col("lp")).cast("int")).withColumn("ri", every("rp"))
    r = r.join(n, "tile").withColumn("ri", F.pmod(F.xxhash64("rid"), F.col("rp")).cast("int")).withColumn("li", every("lp"))
    ks = ["tile", "li", "ri"]
    tag = lambda df: df.withColumn("pair", F.to_json(F.struct(*ks))).drop(*ks, "lp", "rp")
    return tag(l).groupBy("pair").cogroup(tag(r).groupBy("pair")).applyInPandas(fn, schema)


def _mat(col: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.float64) for v in col])


def _near(a: pd.DataFrame, y: np.ndarray, eps: float, step: int = 256):
    """(start, closeness matrix) for slices of the left points."""
    x = _mat(a["x"])
    for i in range(0, len(x), step):
        yield i, ((x[i:i + step, None, :] - y[None, :, :]) ** 2).sum(axis=2) <= eps * eps


def _count_near(eps: float):
    def run(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if a.empty or b.empty:
            return pd.DataFrame({"id": a["id"][:0], "n": pd.Series(dtype="int64")})
        y = _mat(b["y"])
        return pd.DataFrame({"id": a["id"].to_numpy(), "n": np.concatenate([c.sum(axis=1) for _, c in _near(a, y, eps)]).astype("int64")})
    return run


def _outer_points_near(eps: float, d: int):
    """Pairs of cells whose boxes are near, and whether points on their outside surely are."""
    def run(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(a) and len(b):
            x, y = _mat(a["x"]).reshape(len(a), -1, d), _mat(b["y"]).reshape(len(b), -1, d)
            names, others, low, high = a["cell"].to_numpy(), b["other"].to_numpy(), y.min(axis=1), y.max(axis=1)
            for name, p in zip(names, x):
                gap = np.maximum(np.maximum(low - p.max(axis=0), p.min(axis=0) - high), 0)
                at = np.flatnonzero(((gap ** 2).sum(axis=1) <= eps * eps) & (others > name))
                near = ((y[at][:, :, None, :] - p) ** 2).sum(axis=3) <= eps * eps
                out += zip([name] * len(at), others[at], near.any(axis=(1, 2)))
        return pd.DataFrame(out, columns=["a", "b", "sure"]).astype({"sure": bool})
    return run


def _touching(eps: float):
    def run(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        found = set()
        if len(a) and len(b):
            y = _mat(b["y"])
            left, lnames = pd.factorize(a["cell"])
            right, rnames = pd.factorize(b["other"])
            hit = np.zeros((len(lnames), len(rnames)), dtype=bool)
            for i, c in _near(a, y, eps):
                p, q = np.nonzero(c)
                hit[left[i + p], right[q]] = True
            found = {(lnames[p], rnames[q]) for p, q in zip(*np.nonzero(hit)) if lnames[p] < rnames[q]}
        return pd.DataFrame(sorted(found), columns=["a", "b"], dtype=object)
    return run


def _nearest_label(eps: float):
    def run(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        ids, labels = [], []
        if len(a) and len(b):
            b = b.sort_values("component")
            y, comp = _mat(b["y"]), b["component"].to_numpy()
            for i, c in _near(a, y, eps):
                some = c.any(axis=1)
                ids.extend(a["id"].to_numpy()[i:i + len(c)][some])
                labels.extend(comp[c.argmax(axis=1)[some]])
        return pd.DataFrame({"id": pd.Series(ids, dtype=a["id"].dtype), "component": pd.Series(labels, dtype=object)})
    return run
