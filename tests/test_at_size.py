"""Steps whose work outgrows their input are dealt over many tasks, and give the same results as plain versions."""

import numpy as np
import pandas as pd
import pytest
from fundloom.operators import aggregates as A, boosting as B, features as E, joins as J, means, models as M, search as S
from fundloom.operators.ordered import exact_quantiles, range_bucket
from pyspark.sql import functions as F


def test_distributors_are_matched_in_many_tasks(spark):
    kinds = ["growth", "balanced", "passive", None]
    kind = lambda n: F.element_at(F.array(*[F.lit(k) for k in kinds]), (F.col("id") % n + 1).cast("int")).alias("persona")
    inv = spark.range(0, 400, 1, 1).select(F.col("id").alias("investor_id"), kind(4))
    dist = spark.range(0, 60, 1, 1).select(F.floor(F.col("id") / 6).alias("s"), kind(3))
    got = J.distributors_for(inv, dist)
    assert len([n for n in got.rdd.glom().map(len).collect() if n]) > 8
    # a repeated distributor stays repeated
    want = [(r.investor_id, d.s, d.persona, 95 if r.persona == d.persona else 75) for r in inv.collect() for d in dist.collect() if d.persona in (r.persona, "balanced") and d.persona]
    assert sorted(map(tuple, got.select("investor_id", "s", "distributor_persona", "match_score").collect())) == sorted(want)


def test_points_of_one_file_are_moved_by_many_tasks(spark):
    points = spark.range(0, 40_000, 1, 1).select("id", (F.col("id") % 101).alias("a"), (F.col("id") % 7).alias("b"))
    xs, _ = means.scaled(points, ["a", "b"])
    assert xs.rdd.getNumPartitions() >= 8
    sizes = xs.rdd.glom().map(len).collect()
    assert sum(sizes) == 40_000 and max(sizes) < 2 * 40_000 / len(sizes)


def test_sums_by_products_are_sums_by_points(spark):
    rng = np.random.default_rng(3)
    x = np.round(rng.random((1500, 2)), 1)
    h = rng.integers(-(2**62), 2**62, 1500)
    frame = spark.createDataFrame(pd.DataFrame({"x": list(x), "h": h}), "x array<double>, h long").repartition(5)
    models = [means.Start(k, 0, r, rng.choice(x, k)) for k in (1, 3, 2) for r in (None, 4, 9)]
    got = means.assigned(means._blocks(frame, 2), models, 0.8, 2)
    assert len(got) == sum(s.k for s in models)
    for m, s in enumerate(models):
        far = ((x[:, None] - s.centres) ** 2).sum(axis=2)
        w = means.weights(h, [s.resample], 0.8)[:, 0]
        cost = sum(got[m, c][1] for c in range(s.k))
        assert cost == pytest.approx((w * far.min(axis=1)).sum()) and sum(got[m, c][0] for c in range(s.k)) == w.sum()
        assert sum(got[m, c][3:] for c in range(s.k)) == pytest.approx(w @ x)


def test_a_grid_is_boosted_by_many_tasks(spark, monkeypatch):
    real, seen = B._blocks, []
    monkeypatch.setattr(B, "_blocks", lambda df, *a: seen.append(df.rdd.getNumPartitions()) or real(df, *a))
    data = spark.range(0, 40_000, 1, 1).select("id", (F.col("id") % 11).cast("double").alias("a"), (F.col("id") % 3 == 0).cast("int").alias("y"))
    grown, _ = B.boost(data, B.binning(data, ["a"], []), [B.Spec(2, 0.1, 1.0, 1.0)], 1, "y", "id")
    assert seen[0] >= 8 and len(grown) == 1


def test_models_grown_whole_are_those_grown_level_by_level(spark, monkeypatch):
    data = spark.range(0, 3000, 1, 3).select(
        "id", F.rand(5).alias("a"), (F.col("id") % 23).cast("double").alias("b"), F.concat(F.lit("s"), (F.col("id") % 5).cast("string")).alias("c"),
        (F.col("id") * 7 % 3).cast("int").alias("fold"), (1 + F.col("id") % 2).alias("w")).withColumn("y", (F.col("a") * 2 + F.col("b") / 23 + (F.col("c") == "s1").cast("int") > 1.6).cast("int")).persist()
    binned = B.binning(data, ["a", "b"], ["c"])
    specs = [B.Spec(d, 0.2, r, 0.7, k) for d in (2, 5) for r in (0.6, 1.0) for k in (0, 1, -1)]
    found, real = [], B._sums
    monkeypatch.setattr(B, "_sums", lambda *a: found.append(a) or real(*a))
    whole, few = B.boost(data, binned, specs, 4, "y", "id", "w", "fold", [2, 4])
    # no job for a level; large and small nodes are summed alike
    assert not found
    monkeypatch.setattr(B, "ALONE", 0)
    levels, many = B.boost(data, binned, specs, 4, "y", "id", "w", "fold", [2, 4])
    assert found and few.keys() == many.keys() and all((few[k] == many[k]).all() for k in few)
    for a, b in zip(whole, levels):
        assert (a.column == b.column).all() and (a.value == b.value).all() and (a.bin == b.bin).all()
    assert max((t.column >= 0).sum() for t in whole) > 40


def test_rows_are_summed_together_as_column_by_column(monkeypatch):
    rng = np.random.default_rng(4)
    binned = B.Binning(("a", "b"), ("c",), (tuple(range(40)), tuple(range(63))), (("u", "v"),))
    n = 5000
    block = {"codes": np.stack([rng.integers(0, k, n) for k in (41, 64, 3)], axis=1).astype(np.uint8), "label": np.zeros(n), "key": np.arange(n).astype(np.uint64), "weight": np.ones(n), "fold": np.arange(n) % 4}
    rows = B._Rows([block], binned, 3)
    g, h = rng.integers(-99, 99, rows.seen).astype(float), rng.integers(0, 99, rows.seen).astype(float)
    picked, node = np.arange(0, rows.seen, 3), np.arange(0, rows.seen, 3) % 2
    together = rows.sums(g, h), rows.sums(g, h, picked, node, 2)
    monkeypatch.setattr(B, "FEW", 1 << 30)
    apart = rows.sums(g, h), rows.sums(g, h, picked, node, 2)
    assert rows.seen == 3750 and len(rows.sets) < 3 and all((a == b).all() for a, b in zip(together, apart))
    assert together[1][1, 0, 0, 7] == g[picked[(node == 1) & (rows.codes[0, picked] == 7)]].sum()


def test_a_key_range_is_found_with_few_comparisons(spark):
    for n, parts in ((0, 3), (1, 3), (500, 7), (500, 16)):
        df = spark.range(n).select((F.col("id") * 37 % 101).alias("v"), "id")
        got = range_bucket(df, ["v", "id"], parts).collect()
        at = sorted((r.v, r.id, r._bucket) for r in got)
        # ranges are in order and none is passed over
        assert [b for *_, b in at] == sorted(b for *_, b in at) and {b for *_, b in at} == set(range(min(parts, n) + 1 if n > 1 else n))
    plan = range_bucket(df, ["v", "id"], 100)._jdf.queryExecution().optimizedPlan().toString()
    assert "slice(" in plan


def test_forests_are_grown_by_as_many_tasks_as_cores(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(M, "lead_estimator", lambda *a: type("Fits", (), {"fit": lambda _, df: seen.append(df.rdd.getNumPartitions())})())
    M.fit_lead_model(spark.range(0, 1000, 1, 1).select(F.col("id").alias("a"), (F.col("id") % 2).alias("y")), ["a"], [], "y")
    assert seen == [spark.sparkContext.defaultParallelism]


def test_neighbours_in_boxes_are_neighbours(monkeypatch):
    rng = np.random.default_rng(5)
    # few places and repeated ids, so that many distances are equal
    x, y = np.round(rng.random((300, 2)), 1), np.round(rng.random((3000, 2)), 1)
    ida, idb = np.arange(300), rng.permutation(3000)
    row, to, dist = E._closest(x, y, ida, idb, 5, 1.5)
    for i in range(300):
        far = np.sqrt(((y[:, 0] - x[i, 0]) ** 2 + (y[:, 1] - x[i, 1]) ** 2) * 1.5)
        far[idb == ida[i]] = np.inf
        want = np.lexsort((idb, far))[:5]
        assert list(to[row == i]) == list(want) and list(dist[row == i]) == list(far[want])
    # spread out points meet few boxes only
    x, y, met = rng.random((64, 2)) * 0.01, rng.random((100_000, 2)), []
    real = np.lexsort
    monkeypatch.setattr(np, "lexsort", lambda keys: met.append(1) or real(keys))
    E._closest(x, y, np.arange(64), np.arange(100_000) + 64, 5, 1.0)
    assert len(met) < 40


def test_vectors_move_for_few_blocks_of_queries(spark, monkeypatch):
    real, sizes = S._blocks, []
    monkeypatch.setattr(S, "_blocks", lambda df, key, size: sizes.append(size) or real(df, key, size))
    vectors = spark.createDataFrame([(i, [float(i % 5), 1.0]) for i in range(50)], "id int, embedding array<double>")
    top = S.cosine_topk(vectors, vectors, "id", "id", k=2).collect()
    assert len(top) == 100 and min(sizes) >= 4096


ODD_TEXTS = [(1, "a bb cc bb cc"), (2, None), (3, ""), (4, "bb bb Bb é"), (5, "cc bb, dd_1 bb cc"), (5, "cc éé"), (6, "solo"), (None, "bb cc")]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_row_per_document_and_term_is_shuffled_for_weights(spark, monkeypatch):
    docs = spark.createDataFrame(ODD_TEXTS, "id int, t string")
    for chars in (4, 1 << 20):
        monkeypatch.setattr(S, "BLOCK_CHARS", chars, raising=False)
        for bigrams, least in ((True, 1), (False, 1), (True, 2)):
            w = S.tfidf(docs, "id", "t", bigrams=bigrams, min_df=least)
            plan = _plan(w)
            assert "hashpartitioning(term" not in plan and "hashpartitioning(id" not in plan
            counts = S.term_counts(docs, "id", "t", bigrams)
            idf = S.inverse_document_frequency(counts, "id", F.lit(len(ODD_TEXTS)), least)
            want = S._unit(counts.join(idf, "term").select("id", "term", (F.col("tf") * F.col("idf")).alias("raw")), "id")
            got = {(r.id, r.term): r.weight for r in w.collect()}
            assert got and got == pytest.approx({(r.id, r.term): r.weight for r in want.collect()})
    assert S.tfidf(docs.limit(0), "id", "t").collect() == []


def test_search_over_blocks_is_search_over_all(spark, monkeypatch):
    docs = spark.createDataFrame(ODD_TEXTS + [(i, f"word{i % 7} bb word{i % 3} cc") for i in range(7, 60)], "id long, t string")
    asks = spark.createDataFrame([(f"q{i}", f"bb word{i} nowhere") for i in range(9)] + [("none", "nowhere"), ("null", None)], "q string, u string")
    monkeypatch.setattr(S, "SLICE", 3, raising=False)
    seen = []
    for chars, block in ((1 << 20, 4096), (40, 5)):
        monkeypatch.setattr(S, "BLOCK_CHARS", chars, raising=False)
        monkeypatch.setattr(S, "cut_lineage", lambda df: seen.append(df.columns) or df)
        found = S.tfidf_search(asks, docs, "q", "u", "id", "t", 4, doc_block=block, query_block=3)
        got = sorted(map(tuple, found.select("q", "id", "match_score", "rank").collect()))
        n = docs.count()
        counts = S.term_counts(docs, "id", "t")
        idf = S.inverse_document_frequency(counts, "id", F.lit(n))
        unit = lambda c, k: {(r[0], r[1]): r[2] for r in S._unit(c.join(idf, "term").select(k, "term", (F.col("tf") * F.col("idf")).alias("raw")), k).collect()}
        mine, theirs, want = unit(counts, "id"), unit(S.term_counts(asks, "q", "u"), "q"), []
        for q in {q for q, _ in theirs}:
            sums = {}
            for (d, term), w in mine.items():
                if d is not None and (q, term) in theirs:
                    sums[d] = sums.get(d, 0) + w * theirs[q, term]
            best = sorted((-np.floor(v * 100 * 100 + 0.5) / 100, d) for d, v in sums.items())[:4]
            want += [(q, d, -s, i + 1) for i, (s, d) in enumerate(best)]
        assert got == sorted(want)
    # what is written are counts of shared terms, not the postings
    assert all("term" not in c and "tf" not in c for c in seen)


def test_a_users_row_is_aggregated_as_bits(spark):
    items = [f"i{k}" for k in range(130)] + ["a.b"]
    held = [("u", i) for i in ("i0", "i62", "i63", "i125", "i126", "i0")] + [("v", "other"), (None, "a.b"), ("u", None)]
    wide = A.pivot_interactions(spark.createDataFrame(held, "user string, item string"), items)
    assert "pivotfirst" not in _plan(wide).lower()
    want = [(u, *[int((u, i) in held) for i in items]) for u in ("u", "v", None)]
    assert sorted(map(tuple, wide.collect()), key=str) == sorted(want, key=str)


def test_values_below_a_bracket_are_compared_in_a_join_not_one_by_one(spark):
    xs = np.round(np.random.default_rng(2).random(30_000) * 1000, 1)
    frame = spark.createDataFrame(pd.DataFrame({"a": xs, "b": xs % 7}), "a double, b double").unionByName(
        spark.createDataFrame([(None, float("nan"))], "a double, b double"))
    probs = [0.0, 0.25, 0.5, 0.75, 1.0]
    got = exact_quantiles(frame, ["a", "b"], probs)
    plan = _plan(got)
    assert "_lo" in plan and "BroadcastHashJoin [column" in plan
    assert {(r.column, r.prob): r.value for r in got.collect()} == pytest.approx(
        {(c, p): np.quantile(v, p) for c, v in (("a", xs), ("b", xs % 7)) for p in probs})


def test_terms_of_a_hashed_vector_are_counted_without_its_zeros(spark, tables):
    from fundloom.plans import all_queries, registry
    from pyspark.ml.functions import vector_to_array
    all_queries.load()
    got = registry.QUERIES["hashed_tfidf"](spark, tables.folder)
    assert "vector_to_array" not in _plan(got).lower() and got.schema["terms"].dataType.simpleString() == "int"
    m = E.hashing_tfidf(tables.documents, "text").transform(tables.documents)
    want = m.select("doc_id", F.size(F.filter(vector_to_array("tfidf"), lambda v: v > 0)))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_terms_are_hashed_by_batch_and_as_by_hashing_tf(spark, monkeypatch):
    from pyspark.ml.feature import IDF, HashingTF, NGram, RegexTokenizer
    texts = ["a bb cc bb cc", "", "é über 你好吗 你好 x́y ab‍cd foo_bar ²½ ٣٤ bb cc", "solo", "q" * 37 + " zz", "\U0001d400\U0001d401 ‿‿ à", "̀́ -́b ć"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts * 3)], "id int, t string").repartition(2)
    words = RegexTokenizer(inputCol="t", outputCol="w1", pattern=r"(?U)\b\w\w+\b", gaps=False).transform(docs)
    grams = NGram(n=2, inputCol="w1", outputCol="w2").transform(words).withColumn("grams", F.concat("w1", "w2"))
    plain = RegexTokenizer(inputCol="t", outputCol="w1", pattern=r"(?U)\w\w+", gaps=False).transform(docs)
    for buckets, limit in ((1 << 18, 1 << 20), (100, 4)):
        monkeypatch.setattr(M, "SLICE_WORDS", limit)
        want = HashingTF(inputCol="grams", outputCol="tf", numFeatures=buckets).transform(grams)
        got = M.TermHasher("w1", "tf", buckets).transform(plain)
        assert sorted(got.select("id", "w1", "tf").collect()) == sorted(want.select("id", "w1", "tf").collect())
    # passes of the fit read saved counts, not texts
    real, seen = IDF.fit, []
    monkeypatch.setattr(IDF, "fit", lambda self, df: seen.append(df.storageLevel.useDisk) or real(self, df))
    data = spark.createDataFrame([("great profit up", "1"), ("bad loss down", "0")] * 20, "t string, label string")
    assert "HashingTF" not in str(M.fit_sentiment(data, "t", "label").stages) and seen == [True]


def test_days_of_calendars_are_dealt_over_tasks(spark, tables, monkeypatch):
    from fundloom.operators import timeseries as TS
    from fundloom.plans import all_queries, registry
    all_queries.load()
    nav = spark.sql("SELECT id % 40 AS scheme, date_add(DATE'2020-01-01', CAST(id * 37 % 900 AS INT)) AS date, id / 7.0D AS nav FROM range(1000)")
    whole = TS.nav_preprocess(nav)
    monkeypatch.setattr(TS, "TASK_DAYS", 1000)
    many = TS.nav_preprocess(nav)
    # 40 schemes of up to 900 days each; neither windows, bounds nor duplicates are shuffled again
    days = whole.count()
    assert _plan(many).count("hashpartitioning(") == 2 == _plan(many).count("REPARTITION_BY_NUM")
    assert many.rdd.getNumPartitions() == -(-days // 1000) > 16
    assert sorted(map(tuple, many.collect())) == sorted(map(tuple, whole.collect()))
    # the query groups raw rows where they were dealt
    plan = _plan(registry.QUERIES["nav_preprocess"](spark, tables.folder))
    assert plan.count("hashpartitioning(") == 2 == plan.count("REPARTITION_BY_NUM")
    assert TS.nav_preprocess(nav.limit(0)).collect() == []


@pytest.mark.parametrize("chunk", [2048, 16])
def test_dense_cells_meet_by_their_outer_points(spark, monkeypatch, chunk):
    from fundloom.operators import clusters as C
    rng = np.random.default_rng(8)
    # two dense lines, a bent chain whose cells' outermost points are far from each other, and single points
    lines = np.concatenate([np.column_stack([rng.random(900), np.full(900, v)]) for v in (0.0, 0.5)])
    chain = np.concatenate([rng.normal((1.4 + 0.05 * i, 0.3 + 0.045 * (i % 3)), 0.012, (12, 2)) for i in range(9)])
    pts = np.concatenate([lines, chain, rng.random((60, 2)) * (2, 1)])
    eps, need = 0.08, 6
    met, real = [], C._touching
    monkeypatch.setattr(C, "_touching", lambda e: met.append(1) or real(e))
    frame = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(pts)], "id int, a double, b double")
    got = {r["id"]: r["cluster"] for r in C.density_cluster(frame, "id", ["a", "b"], eps, need, chunk).collect()}
    near = ((pts[:, None] - pts[None]) ** 2).sum(2) <= eps * eps
    core, comp = near.sum(1) >= need, np.arange(len(pts))
    while True:
        low = np.where(near & core[None], comp[None], len(pts)).min(1)
        new = np.where(core, np.minimum(low, comp), comp)
        if (new == comp).all():
            break
        comp = new
    for i in np.flatnonzero(core):
        assert all((got[i] == got[j]) == (comp[i] == comp[j]) for j in np.flatnonzero(core)[::7])
    assert all((got[i] >= 0) == (near[i] & core).any() for i in range(len(pts)))
    # dense lines alone need no meeting of points
    met.clear()
    C.density_cluster(frame.filter(f"id < {len(lines)}"), "id", ["a", "b"], eps, need, chunk).collect()
    assert met == []


def test_pairs_are_derived_once_for_recommendations(spark, monkeypatch):
    from collections import Counter
    from fundloom.operators import collab as CO
    pairs = spark.range(300).select((F.col("id") * 7 % 40).cast("string").alias("user"), F.concat(F.lit("i"), F.col("id") * 11 % 13).alias("item")).distinct()
    users = spark.createDataFrame([(str(i),) for i in (*range(0, 40, 2), 77, 78)], "user string")
    cuts, real = [], CO.cut_lineage
    monkeypatch.setattr(CO, "cut_lineage", lambda df: cuts.append(1) or real(df))
    out = CO.collab_recommend(pairs, users, 3)
    assert "Range (" not in _plan(out) and len(cuts) == 1
    held = {}
    for u, i in pairs.collect():
        held.setdefault(u, set()).add(i)
    count = Counter(i for items in held.values() for i in items)
    want = []
    for u in [r.user for r in users.collect()]:
        score = Counter()
        for mine in held.get(u, ()):
            for items in held.values():
                score.update(items - held[u] if mine in items else ())
        best = sorted((score if u in held else count).items(), key=lambda e: (-e[1], e[0]))[:3]
        want += [(u, i, float(s), n + 1) for n, (i, s) in enumerate(best)]
    assert want and sorted(map(tuple, out.collect())) == sorted(want)
