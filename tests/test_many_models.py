"""Many models in one pass: the same as each model alone, and passes that do not grow with the number of models."""

import numpy as np
import pytest
from fundloom.operators import boosting as B, clusters as C, means
from pyspark.sql import functions as F

COLS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def points(spark):
    return spark.range(400).select("id", *[(F.col("id") % 4 * 3 + F.rand(7) * (3 + i)).alias(c) for i, c in enumerate(COLS)]).persist()


def plain_means(x, w, centres, tolerance=1e-4):
    while True:
        far = ((x[:, None] - centres) ** 2).sum(axis=2)
        near = far.argmin(axis=1)
        cost = (w * far.min(axis=1)).sum()
        new = np.stack([np.average(x[near == c], axis=0, weights=w[near == c]) if w[near == c].sum() else centres[c] for c in range(len(centres))])
        done = (((new - centres) ** 2).sum(axis=1) <= tolerance**2).all()
        centres = new
        if done:
            return cost, centres


def plain_silhouette(x, w, centres):
    x = np.repeat(x, w.astype(int), axis=0)
    near = ((x[:, None] - centres) ** 2).sum(axis=2).argmin(axis=1)
    far = ((x[:, None] - x[None]) ** 2).sum(axis=2)
    out = []
    for i in range(len(x)):
        own = near == near[i]
        if own.sum() < 2:
            out.append(0.0)
            continue
        a = far[i, own].sum() / (own.sum() - 1)
        b = min(far[i, near == c].mean() for c in set(near) - {near[i]})
        out.append((b - a) / max(a, b))
    return np.mean(out)


def test_models_together_are_models_alone(points):
    xs, _ = means.scaled(points, COLS)
    rows = xs.collect()
    x, h = np.array([r.x for r in rows]), np.array([r.h for r in rows])
    models = [means.Start(k, seed, r) for k in (2, 4) for seed in (1, 2) for r in (None, 0, 5)]
    means.settle(xs, models, 3, 0.8)
    for s, (cost, score) in zip(models, means.silhouettes(xs, models, 3, 0.8)):
        w = means.weights(h, [s.resample], 0.8)[:, 0]
        sample = xs.orderBy(F.xxhash64("h"), "h", "x").limit(means.INIT).collect()
        first = means._start(np.array([r.x for r in sample]), means.weights(np.array([r.h for r in sample]), [s.resample], 0.8)[:, 0], s.k, s.seed)
        want, centres = plain_means(x, w, first)
        assert s.cost == pytest.approx(want) and s.centres == pytest.approx(centres)
        assert score == pytest.approx(plain_silhouette(x, w, centres)) and cost <= want + 1e-9


def test_resamples_are_poisson():
    h = np.arange(200_000, dtype=np.int64)
    w = means.weights(h, [None, 0, 1], 0.8)
    assert (w[:, 0] == 1).all() and abs(w[:, 1].mean() - 0.8) < 0.01 and abs(w[:, 1].var() - 0.8) < 0.02
    assert abs(np.corrcoef(w[:, 1], w[:, 2])[0, 1]) < 0.01


def test_passes_do_not_grow_with_models(points, monkeypatch):
    real, passes = means.assigned, []
    monkeypatch.setattr(means, "assigned", lambda *a: passes.append(len(a[1])) or real(*a))
    slowest = 0
    for i in range(4):
        passes.clear()
        C.cluster_stability(points, COLS, 4, n=1, starts=1 + i)
        slowest = max(slowest, len(passes))
    passes.clear()
    got = C.cluster_stability(points, COLS, 4, n=40, starts=5).first()
    assert got.runs == 40 and len(passes) <= 3 * slowest and passes[0] == 200
    assert 0 < got.min_silhouette <= got.mean_silhouette <= got.max_silhouette < 1


def test_best_of_ten_starts(points):
    found = C.fit_personas(points, COLS, 4)
    one = [C.fit_personas(points, COLS, 4, seed=42 + i, starts=1).cost for i in range(10)]
    assert found.cost == min(one) and found.transform(points).groupBy("cluster").count().count() == 4


def test_gaps_and_empty_tables(spark, points):
    gap = points.union(spark.createDataFrame([(1000, None, 1.0, 2.0)], points.schema))
    assert C.fit_personas(gap, COLS, 3).transform(gap).count() == 400
    none = points.limit(0)
    assert C.fit_personas(none, COLS, 3).transform(none).count() == 0


# ---- boosted trees ---------------------------------------------------------------------------

NUM, CAT = ["u", "v"], ["s"]


@pytest.fixture(scope="module")
def leads(spark):
    return spark.range(600).select(
        F.col("id").cast("string").alias("id"), F.rand(3).alias("u"), (F.col("id") % 17).cast("double").alias("v"), F.concat(F.lit("s"), (F.col("id") % 5).cast("string")).alias("s")
    ).withColumn("y", ((F.col("u") * 4 + F.when(F.col("s") == "s2", 3).otherwise(0) + F.col("v") / 17) > 2.8).cast("int")).persist()


def plain_tree(codes, g, h, depth, n_num, values):
    """One tree over the whole table, by the same rules."""
    leaf = lambda rows: -g[rows].sum() / (h[rows].sum() + 1)

    def grow(rows, level):
        best = (1e-9, None)
        if level < depth:
            whole = g[rows].sum() ** 2 / (h[rows].sum() + 1)
            for f in range(codes.shape[1]):
                for b in range(B.BINS) if f < n_num else range(values[f - n_num]):
                    right = codes[rows, f] > b if f < n_num else codes[rows, f] == b
                    r, left = rows[right], rows[~right]
                    if h[r].sum() >= 1 and h[left].sum() >= 1:
                        gain = sum(g[k].sum() ** 2 / (h[k].sum() + 1) for k in (r, left)) - whole
                        if gain > best[0] + 1e-9:
                            best = (gain, left, r)
        if best[1] is None:
            return [(rows, leaf(rows))]
        return grow(best[1], level + 1) + grow(best[2], level + 1)
    return grow(np.arange(len(g)), 0)


def test_rounds_match_plain_boosting(leads):
    binned = B.binning(leads, NUM, CAT)
    spec = B.Spec(3, 0.3, 1.0, 1.0)
    trees, _ = B.boost(leads, binned, [spec], 4, "y", "id")
    table = leads.select(*NUM, *CAT, "y").toArrow()
    codes, y = binned.codes([table.column(i).combine_chunks() for i in range(3)]), table.column("y").to_numpy()
    margin, mine = np.zeros(len(y)), np.zeros(len(y))
    for t in trees:
        p = 1 / (1 + np.exp(-margin))
        for rows, value in plain_tree(codes, p - y, p * (1 - p), 3, 2, [len(v) for v in binned.values]):
            margin[rows] += 0.3 * value
        mine += t.value[0, t.walk(codes, 2, 3)[:, 0]]
        assert mine == pytest.approx(margin, abs=1e-4)
    assert ((margin > 0) == (y == 1)).mean() > 0.9


@pytest.mark.parametrize("task", [1, 8])
def test_models_of_a_grid_are_models_alone(leads, monkeypatch, task):
    monkeypatch.setattr(B, "TASK", task)
    binned = B.binning(leads, NUM, CAT)
    data = leads.withColumn("fold", (F.col("id").cast("int") % 3))
    specs = [B.Spec(d, s, r, c, f) for d in (2, 3) for s, r, c in ((0.1, 0.7, 0.6), (0.3, 1.0, 1.0)) for f in range(3)]
    many, counts = B.boost(data, binned, specs, 5, "y", "id", fold="fold", stages=[3, 5])
    monkeypatch.setattr(B, "TASK", 8)
    assert sorted(counts) == [3, 5] and (counts[5].sum(axis=1) > 0).all()
    for m in (0, 5, 7, 11):
        alone, own = B.boost(data.repartition(3), binned, [specs[m]], 5, "y", "id", fold="fold", stages=[3])
        assert (own[3][0] == counts[3][m]).all()
        for a, b in zip(many, alone):
            n = b.column.shape[1]
            assert (a.column[m, :n] == b.column[0]).all() and (a.bin[m, :n] == b.bin[0]).all() and (a.value[m, :n] == b.value[0]).all()


def test_grid_scores(leads):
    out = B.boosted_grid(leads, NUM, CAT, "y", "id", {"rounds": [2, 12], "depth": [1, 3], "step": [0.3]}, folds=3).collect()
    got = {r.params: r.score for r in out}
    assert set(got) == {f"depth={d}, rounds={r}, step=0.3" for d in (1, 3) for r in (2, 12)}
    assert got["depth=3, rounds=12, step=0.3"] > 0.85 and all(0 <= v <= 1 for v in got.values())


def test_boosted_scores(spark, leads):
    model = B.fit_boosted(leads, NUM, CAT, "y", "id", rounds=15, depth=3, step=0.3)
    out = B.score_boosted(leads, model)
    assert out.columns == [*leads.columns, "pred_label", "pred_proba"] and out.filter("pred_label = y").count() > 540
    odd = spark.createDataFrame([("x", 0.5, 3.0, "new", None), ("z", 0.9, 1.0, None, 1)], "id string, u double, v double, s string, y int")
    assert all(0 < r.pred_proba < 1 for r in B.score_boosted(odd, model).collect())
    none = leads.limit(0)
    assert B.score_boosted(none, B.fit_boosted(none, NUM, CAT, "y", "id", rounds=2)).count() == 0
