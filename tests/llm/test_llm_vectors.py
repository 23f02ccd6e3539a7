"""Embedding near-duplicates and the permutation index against all pairs."""

import numpy as np
import pytest

from fundloom.llm import ann, embdedup

VECS = "vec_id long, embedding array<float>, label int, kept int, score string"


def made(seed, n=300, d=16):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d))
    x[40:100] = x[0] + rng.normal(scale=0.2, size=(60, d))
    x[100:130] = x[1]
    for k in range(130, 160):
        x[k] = x[k - 1] + rng.normal(scale=0.3, size=d)
    return x * rng.uniform(0.1, 5, n)[:, None]


@pytest.fixture(scope="module")
def frame(spark):
    x = made(3).astype(np.float32)
    odd = [(900, None), (901, []), (902, [0.0] * 16), (903, [float("nan")] * 16), (904, [float("inf")] + [1.0] * 15), (905, [None] + [1.0] * 15), (906, [1.0, 2.0]), (None, [1.0] * 16)]
    rows = [(i, [float(c) for c in v], 1, 2, "s") for i, v in enumerate(x)] + [(i, v, None, None, None) for i, v in odd]
    return x.astype(np.float64), spark.createDataFrame(rows, VECS)


def test_bounds_hold():
    rng = np.random.default_rng(1)
    for scale in (1e-30, 1.0, 1e30):
        x, y = made(1)[:50] * scale, made(2)[:80] * scale
        u, q, s, e = embdedup.quantised(x)
        v, p, t, f = embdedup.quantised(y)
        near = (q.astype(float) @ p.T.astype(float)) * s[:, None] * t
        assert (np.abs(u @ v.T - near) <= e[:, None] + f + e[:, None] * f).all()
        threshold = float(rng.uniform(0.1, 0.5))
        assert (embdedup.links(x, y, threshold) == (u @ v.T >= threshold)).all()


@pytest.mark.parametrize("tile", [4096, 64])
def test_links_match_all_pairs(frame, monkeypatch, tile):
    monkeypatch.setattr(embdedup, "TILE", tile)
    x, df = frame
    got = {r.vec_id: r for r in embdedup.near_vectors(df).collect()}
    u = x / np.linalg.norm(x, axis=1)[:, None]
    linked = u @ u.T >= 0.9
    np.fill_diagonal(linked, False)
    low = np.arange(len(x))
    while (new := np.minimum(low, np.where(linked, low[None], len(x)).min(axis=1))).tolist() != low.tolist():
        low = new
    assert [got[i].n_links for i in range(len(x))] == linked.sum(axis=1).tolist()
    assert [got[i].component_id for i in range(len(x))] == low.tolist()
    assert all(got[i].n_links == 0 and got[i].component_id == i and got[i].kept for i in range(900, 907))
    assert got[None].component_id is None and got[None].kept and len(got) == len(x) + 8


def test_repeated_and_no_vectors(spark, frame):
    twice = spark.createDataFrame([(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.01]), (3, [0.0, 1.0]), (3, [1.0, 0.0])], "vec_id long, embedding array<double>")
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in embdedup.near_vectors(twice).collect())
    assert got == [(1, 3, 1), (1, 3, 1), (2, 3, 1), (3, 0, 1), (3, 3, 1)]
    empty = frame[1].limit(0)
    assert embdedup.near_vectors(empty).count() == 0
    assert ann.nearest(empty, empty).count() == 0
    null = frame[1].filter("vec_id = 900")
    assert embdedup.near_vectors(null).count() == 1 and ann.nearest(null, null).count() == 0


def test_all_candidates_give_the_exact_neighbours(frame, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 100)
    x, df = frame
    got = {}
    for r in ann.nearest(df, df.filter("vec_id % 20 = 0"), k=7, pivots=32, length=32, share=1.0).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(got) == set(range(0, len(x), 20))
    for q, rows in got.items():
        score = np.einsum("ij,j->i", x, x[q])
        best = [int(i) for i in np.lexsort((np.arange(len(x)), -score)) if i != q][:7]
        assert [(r, v) for r, v, _ in sorted(rows)] == list(enumerate(best, 1))
        assert all(abs(s - score[v]) < 1e-9 for _, v, s in rows)


def test_recall(frame, tables):
    df = tables.embeddings
    x = np.array([r.embedding for r in df.orderBy("vec_id").collect()])
    ids = np.array([r.vec_id for r in df.orderBy("vec_id").collect()])
    got = {}
    for r in ann.nearest(df, df.filter("vec_id % 20 = 0")).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hits = []
    for q in ids[ids % 20 == 0]:
        score = x @ x[ids == q][0]
        score[ids == q] = -np.inf
        hits.append(len(got[q] & set(ids[np.argsort(-score)[:20]].tolist())) / min(20, len(ids) - 1))
    assert np.mean(hits) >= 0.9


def test_few_candidates(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [3.0, 0.0]), (2, [3.0, 0.0]), (2, [-1.0, 0.0])], "vec_id long, embedding array<double>")
    got = [(r.rank, r.vec_id, r.score) for r in ann.nearest(df, df.filter("vec_id = 0")).orderBy("rank").collect()]
    assert got == [(1, 1, 3.0), (2, 2, 3.0), (3, 2, -1.0)]


def test_files_sum_the_truncated_footrule():
    rng = np.random.default_rng(4)
    near = np.array([rng.permutation(12)[:5] for _ in range(60)])
    files = ann.Files(near, 12)
    assert sorted(zip(files.row[files.first[3] : files.first[4]], files.place[files.first[3] : files.first[4]])) == sorted((r, list(n).index(3)) for r, n in enumerate(near) if 3 in n)
    for query in near[:10]:
        far = files.distances(query)
        for r, n in enumerate(near):
            assert far[r] == sum(abs(list(n).index(p) - i) if p in n else 5 for i, p in enumerate(query))


def test_a_query_reads_only_the_files_of_its_pivots(tables, monkeypatch):
    df = tables.embeddings
    rows = [(r.vec_id, r.embedding) for r in df.orderBy("vec_id").collect()]
    x = np.array([e for _, e in rows], float)
    longest = np.linalg.norm(x, axis=1).max()
    pivots = ann.choose_pivots(ann.lifted(x[:400], longest), 64)
    files = ann.Files(ann.nearest_pivots(ann.lifted(x, longest), pivots, 6).astype(int), len(pivots))
    query = ann.nearest_pivots(np.hstack([x[:1], [[0.0]]]), pivots, 6)[0].astype(int)
    read = sum(files.first[p + 1] - files.first[p] for p in query)
    assert read < len(x) * 6 / 2 and (files.distances(query) == 36).sum() > len(x) / 4
