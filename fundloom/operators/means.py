"""K-means for many models in one pass: every k, every start and every resample share each scan of the points.

A pass sends all centres to the tasks; a task assigns its points for all models by one matrix product a block and returns
counts and sums by model and cluster, which are added up by Spark. The number of passes is that of the slowest model to
settle, whatever the number of models. Resamples are Poisson weights that a row's hash gives, so no resample is ever
built. A start is k-means++ over a bounded sample of points (``INIT``).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame, functions as F

from .filters import complete_cases

#: Points from which starts are drawn, chosen by hash; numbers that a block of distances may hold; and points whose
#: distances to all centres are taken at once.
INIT, CELLS, STEP = 2048, 1 << 21, 512
#: Tasks whose sums are added up in one step.
WIDE = 64
#: Rows of a task: at least (unless there are fewer) and at most, however many cores there are.
FEW, MANY = 1 << 10, 1 << 18


@dataclass
class Start:
    """One model: number of clusters, seed of its start, and resample (none: every point counts once)."""

    k: int
    seed: int
    resample: int | None = None
    centres: np.ndarray | None = None
    cost: float = field(default=np.inf)
    settled: bool = False


def scaled(df: DataFrame, cols: list[str], scale: str = "minmax") -> tuple[DataFrame, list[tuple[float, float]]]:
    """x (array of scaled columns) and h (hash of the row) of the rows without gaps; and (offset, divisor) per column.

    The points are dealt evenly over the cores, in tasks of bounded size: many passes follow.
    """
    rows = complete_cases(df, cols)
    number = [F.col(c).cast("double") for c in cols]
    if scale == "minmax":
        n, *s = rows.agg(F.count("*"), *[F.struct(F.min(c), F.max(c)) for c in number]).first()
        shape = [(0.0, 1.0) if r[0] is None else (r[0], (r[1] - r[0]) or 1.0) for r in s]
    else:
        n, *s = rows.agg(F.count("*"), *[F.struct(F.avg(c), F.stddev_samp(c)) for c in number]).first()
        shape = [(r[0] or 0.0, r[1] or 1.0) for r in s]
    tasks = max(1, ceil(n / MANY), min(df.sparkSession.sparkContext.defaultParallelism, ceil(n / FEW)))
    points = rows.select(_place(cols, shape).alias("x"), F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).alias("h"))
    # by the rows' turn, so that many equal rows are no large task
    return points.repartition(tasks), shape


def _place(cols: list[str], shape: list[tuple[float, float]]) -> Column:
    return F.array(*[(F.col(c).cast("double") - F.lit(low)) / F.lit(by) for c, (low, by) in zip(cols, shape)])


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def weights(h: np.ndarray, resamples: list[int | None], share: float) -> np.ndarray:
    """How often each row (down) is in each resample (across): Poisson with mean ``share``, by hash."""
    chance, steps = np.exp(-share), []
    total = 0.0
    for k in range(32):
        total += chance
        steps.append(total)
        chance *= share / (k + 1)
    out = np.ones((len(h), len(resamples)))
    for j, r in enumerate(resamples):
        if r is not None:
            u = _mixed(h.view(np.uint64) ^ _mixed(np.full(1, r + 1, np.uint64))).astype(np.float64) / 2.0**64
            out[:, j] = np.searchsorted(np.array(steps), u, side="right")
    return out


def _parts(source, per_row: int):
    """Points and hashes in blocks small enough for the distances to all centres."""
    for batch in source:
        step = max(1, CELLS // max(1, per_row))
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            x = part.column(0).flatten().to_numpy(zero_copy_only=False)
            yield x.reshape(part.num_rows, -1), part.column(1).to_numpy(zero_copy_only=False)


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of points (first) to the clusters (last) of models of one k (between)."""
    flat = centres.reshape(-1, centres.shape[2])
    d = (x**2).sum(axis=1)[:, None] - 2 * (x @ flat.T) + (flat**2).sum(axis=1)
    return np.maximum(d, 0).reshape(len(x), *centres.shape[:2])


def _grouped(models: list[Start]) -> list[tuple[list[int], np.ndarray, list]]:
    """Models by k: their places, centres and resamples."""
    by_k: dict[int, list[int]] = {}
    for m, s in enumerate(models):
        by_k.setdefault(s.k, []).append(m)
    return [(at, np.stack([models[m].centres for m in at]), [models[m].resample for m in at]) for at in by_k.values()]


def _blocks(points: DataFrame, d: int) -> RDD:
    """(coordinates, hashes) by blocks of rows, kept for the passes; an RDD, because a pass is too short to plan a query for each."""
    def run(source):
        for batch in source:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([pa.array([b], pa.binary()) for b in (x.tobytes(), batch.column(1).to_numpy(zero_copy_only=False).tobytes())], names=["x", "h"])

    def unpacked(row):
        return np.frombuffer(row.x).reshape(-1, d), np.frombuffer(row.h, np.int64)
    return points.select("x", "h").mapInArrow(run, "x binary, h binary").rdd.map(unpacked).persist(StorageLevel.MEMORY_AND_DISK)


def _owners(point: np.ndarray, centres: np.ndarray):
    """For each cluster in turn: 1 where it is the first of the nearest of its model (down) to a point (across), else 0.

    ``point`` has the coordinates and a 1, ``centres`` (cluster, model) -2 times the coordinates and the square.
    """
    far = [c @ point for c in centres]
    least = far[0]
    for f in far[1:]:
        least = np.minimum(least, f)
    free = np.ones(least.shape, bool)
    for f in far:
        own = (f <= least) & free
        free &= ~own
        yield own.astype(np.float64)


def assigned(blocks: RDD, models: list[Start], share: float, d: int) -> dict[tuple[int, int], np.ndarray]:
    """(model, cluster) -> weight, cost, sum of squares and sums of its points, from one pass.

    Sums are products of 0/1 rows with the points, models of one resample together. Costs follow from the sums.
    """
    groups, drawn = [], list(dict.fromkeys(s.resample for s in models))
    by: dict[tuple, list[int]] = {}
    for m, s in enumerate(models):
        by.setdefault((s.k, s.resample), []).append(m)
    for k in sorted({k for k, _ in by}):
        mine = [(drawn.index(r), at) for (j, r), at in by.items() if j == k]
        places = [m for _, at in mine for m in at]
        centres = np.stack([models[m].centres for m in places], axis=1)
        ends = np.cumsum([len(at) for _, at in mine])
        groups.append((places, np.concatenate([-2 * centres, (centres**2).sum(axis=2)[:, :, None]], axis=2),
                       [(j, slice(e - len(at), e)) for (j, at), e in zip(mine, ends)]))

    def run(source):
        total = [np.zeros((*c.shape[:2], 2 + d)) for _, c, _ in groups]
        for points, h in source:
            drawn_rows = weights(h, drawn, share)
            for i in range(0, len(points), STEP):
                x, w = points[i : i + STEP], drawn_rows[i : i + STEP]
                row = np.column_stack([np.ones(len(x)), (x**2).sum(axis=1), x])
                weighed = [w[:, j : j + 1] * row for j in range(len(drawn))]
                point = np.column_stack([x, np.ones(len(x))]).T.copy()
                for out, (_, centres, parts) in zip(total, groups):
                    for c, own in enumerate(_owners(point, centres)):
                        for j, at in parts:
                            out[c, at] += own[at] @ weighed[j]
        yield np.concatenate([t.ravel() for t in total])
    # models times clusters, however many points there are
    sums = blocks.mapPartitions(run)
    sums = sums.reduce(np.add) if blocks.getNumPartitions() <= WIDE else sums.treeReduce(np.add)
    found, start = {}, 0
    for places, centres, _ in groups:
        shape = (*centres.shape[:2], 2 + d)
        size = int(np.prod(shape))
        for c, row in enumerate(sums[start : start + size].reshape(shape)):
            for m, (n, q, *s) in zip(places, row):
                s, centre = np.array(s), models[m].centres[c]
                found[m, c] = np.array([n, max(0.0, q - 2 * (centre @ s) + n * (centre @ centre)), q, *s])
        start += size
    return found


def _start(x: np.ndarray, w: np.ndarray, k: int, seed: int) -> np.ndarray:
    """k-means++: each next centre is drawn by weight and squared distance to those before."""
    rng = np.random.default_rng(seed)
    chosen = [int(rng.choice(len(x), p=w / w.sum()))]
    far = ((x - x[chosen[0]]) ** 2).sum(axis=1)
    while len(chosen) < k:
        p = far * w
        chosen.append(int(rng.choice(len(x), p=p / p.sum())) if p.sum() > 0 else int(rng.integers(len(x))))
        far = np.minimum(far, ((x - x[chosen[-1]]) ** 2).sum(axis=1))
    return x[chosen]


def settle(points: DataFrame, models: list[Start], d: int, share: float = 1.0, tolerance: float = 1e-4, rounds: int = 300) -> list[Start]:
    """All models moved until no centre goes further than ``tolerance`` (or ``rounds`` passes), with their costs."""
    sample = points.orderBy(F.xxhash64("h"), "h", "x").limit(INIT).toArrow()
    if not sample.num_rows:
        return models
    x = sample.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(sample.num_rows, d)
    drawn = {r: weights(sample.column("h").to_numpy(), [r], share)[:, 0] for r in {s.resample for s in models}}
    for s in models:
        w = drawn[s.resample]
        s.centres = _start(x, w if w.any() else np.ones(len(x)), s.k, s.seed)
    blocks = _blocks(points, d)
    try:
        for _ in range(rounds):
            open_ = [s for s in models if not s.settled]
            if not open_:
                break
            sums = assigned(blocks, open_, share, d)
            for m, s in enumerate(open_):
                rows = np.stack([sums[m, c] for c in range(s.k)])
                new = np.where(rows[:, :1] > 0, rows[:, 3:] / np.maximum(rows[:, :1], 1e-300), s.centres)
                s.settled = bool((((new - s.centres) ** 2).sum(axis=1) <= tolerance**2).all())
                s.cost, s.centres = float(rows[:, 1].sum()), new
    finally:
        blocks.unpersist()
    return models


def best(models: list[Start]) -> list[Start]:
    """Of the starts of each k and resample the cheapest, the first of equals."""
    out: dict[tuple, Start] = {}
    for s in models:
        key = s.k, s.resample
        if key not in out or s.cost < out[key].cost:
            out[key] = s
    return list(out.values())


def silhouettes(points: DataFrame, models: list[Start], d: int, share: float = 1.0) -> list[tuple[float, float]]:
    """(cost, mean silhouette) of each model by squared distance, from per-cluster sums: two passes for all models."""
    blocks = _blocks(points, d)
    try:
        sums = assigned(blocks, models, share, d)
    finally:
        blocks.unpersist()
    groups = []
    for places, centres, resamples in _grouped(models):
        rows = np.stack([[sums[m, c] for c in range(centres.shape[1])] for m in places])
        n = rows[:, :, 0]
        some = np.maximum(n, 1e-300)
        groups.append((places, centres, resamples, n, rows[:, :, 3:] / some[:, :, None], rows[:, :, 2] / some))

    def run(source):
        total = np.zeros((len(models), 2))
        for x, h in _parts(source, sum(g[1].shape[0] * g[1].shape[1] for g in groups)):
            square = (x**2).sum(axis=1)
            for places, centres, resamples, n, mean, q in groups:
                near = _distances(x, centres).argmin(axis=2)[:, :, None]
                far = square[:, None, None] - 2 * (x @ mean.reshape(-1, d).T).reshape(len(x), *n.shape) + q
                far = np.where(n > 0, np.maximum(far, 0), np.inf)
                size = np.take_along_axis(np.broadcast_to(n, far.shape), near, 2)[:, :, 0]
                own = np.take_along_axis(far, near, 2)[:, :, 0] * size / np.maximum(size - 1, 1e-300)
                np.put_along_axis(far, near, np.inf, 2)
                other = far.min(axis=2)
                s = np.where((size > 1) & np.isfinite(other), (other - own) / np.maximum(np.maximum(own, other), 1e-300), 0.0)
                w = weights(h, resamples, share)
                total[places, 0] += (w * s).sum(axis=0)
                total[places, 1] += w.sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(models)), pa.int32()), pa.array(total[:, 0]), pa.array(total[:, 1])], names=["m", "s", "n"])
    found = {r.m: r.s / r.n if r.n else 0.0 for r in points.mapInArrow(run, "m int, s double, n double").groupBy("m").agg(F.sum("s").alias("s"), F.sum("n").alias("n")).collect()}
    cost = [sum(sums[m, c][1] for c in range(s.k)) for m, s in enumerate(models)]
    return [(float(cost[m]), float(found.get(m, 0.0))) for m in range(len(models))]


@dataclass(frozen=True)
class PersonaModel:
    """Scaled columns and centres; rows with a gap are left out."""

    cols: tuple[str, ...]
    shape: tuple[tuple[float, float], ...]
    centres: tuple[tuple[float, ...], ...]
    cost: float

    def transform(self, df: DataFrame, name: str = "cluster") -> DataFrame:
        x = _place(list(self.cols), list(self.shape))
        far = [F.aggregate(F.zip_with(x, F.lit(list(c)), lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, v: s + v) for c in self.centres]
        return complete_cases(df, list(self.cols)).withColumn(name, F.expr("0").cast("int") if not far else (
            F.array_position(F.array(*far), F.least(*far) if len(far) > 1 else far[0]) - 1).cast("int"))
