import datetime as dt
import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fundloom.operators import (aggregates as A, clusters as C, collab as CO, derive as D, evaluation as EV, features as E, filters as X, impact as I,
                                joins as J, quality as Q, risk as K, search as S, timeseries as TS, topk as T)
from fundloom.operators.ordered import exact_quantiles, global_rank, running_totals


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


# ---- order and quantiles under skew --------------------------------------------------------

def test_global_rank_with_a_hot_value(spark):
    data = [(7.0 if i % 3 else float(i), i) for i in range(3000)]
    df = spark.createDataFrame(data, "v double, id long").repartition(5)
    got = [r["id"] for r in global_rank(df, ["v", "id"]).orderBy("rank").collect()]
    assert got == [i for _, i in sorted(data)]


def test_running_totals_by_group(spark):
    data = [(g, i, i % 4) for g in "ab" for i in range(200)]
    df = spark.createDataFrame(data, "g string, i long, w long")
    got = {(r["g"], r["i"]): (r["s"], r["s_total"]) for r in running_totals(df, ["i"], {"s": F.col("w")}, ["g"], totals=True).collect()}
    cum = list(itertools.accumulate(i % 4 for i in range(200)))
    assert all(got[g, i] == (cum[i], cum[-1]) for g in "ab" for i in range(200))


@pytest.mark.parametrize("seed", range(3))
def test_quantiles_equal_numpy(spark, seed):
    rnd = random.Random(seed)
    v = [5.0 if rnd.random() < 0.4 else round(rnd.gauss(0, 10), rnd.choice([0, 5])) for _ in range(4001)]
    df = spark.createDataFrame([(x, x * 2 if i % 9 else None) for i, x in enumerate(v)], "a double, b double")
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = {(r["column"], r["prob"]): r["value"] for r in exact_quantiles(df, ["a", "b"], probs, accuracy=100).collect()}
    b = [x * 2 for i, x in enumerate(v) if i % 9]
    for p in probs:
        assert got["a", p] == pytest.approx(np.quantile(v, p), abs=1e-9)
        assert got["b", p] == pytest.approx(np.quantile(b, p), abs=1e-9)


@pytest.mark.parametrize("n", [1, 2, 6, 137, 101, 102])
def test_quantiles_of_few_rows(spark, n):
    v = [float(i * i % 97) for i in range(n)]
    df = spark.createDataFrame([(x,) for x in v], "a double")
    got = {r["prob"]: r["value"] for r in exact_quantiles(df, ["a"], [0.01, 0.25, 0.5, 0.99], accuracy=100).collect()}
    assert all(got[p] == pytest.approx(np.quantile(v, p)) for p in got) and len(got) == 4


def test_quantile_of_one_row_and_nan(spark):
    df = spark.createDataFrame([(3.0,), (float("nan"),), (None,)], "a double")
    assert rows(exact_quantiles(df, ["a"], [0.5])) == [("a", 0.5, 3.0)]


# ---- quality -------------------------------------------------------------------------------

def test_null_profile_counts_nan_and_skips_empty(spark):
    df = spark.createDataFrame([(1.0, None), (float("nan"), "x"), (2.0, "y"), (3.0, None)], "a double, b string")
    assert rows(Q.null_profile(df), "column") == [("a", 1, 25.0), ("b", 2, 50.0)]
    assert rows(Q.null_profile(df.limit(0))) == []


def test_normalize_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["Total Visits (%)", "_keep Me", "A-B/C"])
    assert Q.normalize_columns(df).columns == ["total_visits_pct", "_keep Me", "a-b/c"]
    assert Q.normalize_columns(df, "strict").columns == ["total_visits_pct", "_keep Me", "a_b_c"]
    with pytest.raises(ValueError):
        Q.normalize_columns(spark.createDataFrame([(1, 2)], ["A b", "a_B"]))


def test_absent_columns_are_no_ops(spark):
    df = spark.createDataFrame([(1.0,)], "a double")
    assert Q.impute(df, "mean", ["zz"]).columns == ["a"]
    assert Q.winsorize(df, "zz").columns == ["a"]
    assert Q.to_numeric(df, ["zz"]).columns == ["a"]
    assert D.lead_features(df).columns == ["a"]


def test_impute_keeps_present_values(spark):
    df = spark.createDataFrame([(1.0, "x"), (None, None), (3.0, "x"), (float("nan"), "y")], "a double, s string")
    assert [r["a"] for r in Q.impute(df, "mean", ["a"]).collect()] == [1.0, 2.0, 3.0, 2.0]
    assert [r["s"] for r in Q.impute(df, "mode", ["s"]).collect()] == ["x", "x", "x", "y"]


def test_outliers_of_a_null_column(spark):
    df = spark.createDataFrame([(None,), (None,)], "a double")
    assert {r["is_outlier"] for r in Q.iqr_outliers(df, "a").collect()} == {False}


def test_dedupe_first_and_last(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 3, "b"), (2, 1, None)], "k int, t int, v string")
    assert rows(Q.dedupe(df, ["k"], ["t"]), "k") == [(1, 3, "b"), (2, 1, None)]
    assert rows(Q.dedupe(df, ["k"], ["t"], last=True), "k") == [(1, 5, "a"), (2, 1, None)]


def test_approx_uniques_within_five_percent(spark):
    df = spark.range(20000).select((F.col("id") % 5000).alias("k"))
    assert abs(Q.approx_uniques(df, ["k"], 0.01).first()["approx_unique"] - 5000) <= 250


# ---- filters -------------------------------------------------------------------------------

def test_quality_split_is_complete(spark):
    df = spark.createDataFrame([("a", 1.0, 0.5), (None, 1.0, 0.5), ("b", None, 0.5), ("c", -1.0, 0.5), ("d", 0.0, 0.0)],
                               "lead_id string, total_visits double, Conversion_Probability double")
    good, bad = X.quality_split(df)
    assert sorted(r["lead_id"] for r in good.collect()) == ["a", "d"]
    assert bad.count() == 3


def test_hash_sample_does_not_depend_on_layout(spark):
    df = spark.range(50000)
    a = {r["id"] for r in X.sample(df.repartition(3), 0.2, key=["id"]).collect()}
    b = {r["id"] for r in X.sample(df.repartition(7), 0.2, key=["id"]).collect()}
    assert a == b and abs(len(a) / 50000 - 0.2) < 0.01
    assert X.sample_n(df, 10, ["id"]).count() == 10


# ---- joins ---------------------------------------------------------------------------------

def test_upsert(spark):
    base = spark.createDataFrame([("1", "Ann", "Won"), ("2", "Bob", "New")], "lead_id string, name string, status string")
    upd = spark.createDataFrame([("2", None, "Lost"), ("3", "Cy", None), ("4", None, None)], "lead_id string, first_name string, status string")
    got = {r["lead_id"]: (r["name"], r["status"], r["notes"]) for r in J.upsert(base, upd).collect()}
    assert got == {"1": ("Ann", "Won", None), "2": ("Bob", "Lost", None), "3": ("Cy", "New", ""), "4": ("Lead 4", "New", "")}


def test_override(spark):
    a = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    b = spark.createDataFrame([(2, None), (3, "c")], "k int, v string")
    assert rows(J.override(a, b, "k"), "k") == [(1, "a"), (2, None), (3, "c")]


def test_market_snapshot_needs_no_join(spark):
    m = spark.createDataFrame([(21.0, "bearish")], "vix double, sentiment string")
    df = J.with_market(spark.range(3), m)
    assert df.select("market.vix").distinct().collect()[0][0] == 21.0
    assert "Join" not in df._jdf.queryExecution().executedPlan().toString()


def test_cooccurrence_blocks_agree_with_self_join(spark):
    rnd = random.Random(1)
    pairs = {("hot", f"i{j}") for j in range(40)} | {(f"u{rnd.randrange(60)}", f"i{rnd.randrange(40)}") for _ in range(500)}
    df = spark.createDataFrame(sorted(pairs), "user string, item string")
    want = {}
    by = {}
    for u, i in pairs:
        by.setdefault(u, []).append(i)
    for items in by.values():
        for i in items:
            for j in items:
                want[i, j] = want.get((i, j), 0) + 1
    for ub, ib in ((4096, 2048), (10, 7)):
        got = {(r["item"], r["other"]): r["users"] for r in CO.cooccurrence(df, ub, ib).collect()}
        assert got == want
        score = {(r["user"], r["item"]): r["score"] for r in CO.cooccurrence_scores(df, user_block=ub, item_block=ib).collect()}
        ref = {(u, i): float(sum(want.get((j, i), 0) for j in items)) for u, items in by.items() for i in {f"i{j}" for j in range(40)} - set(items)}
        assert score == {k: v for k, v in ref.items() if v > 0}


# ---- series --------------------------------------------------------------------------------

def series(spark, values, key="s"):
    return spark.createDataFrame([(key, i, v) for i, v in enumerate(values)], "scheme string, d int, nav double").select(
        "scheme", F.date_add(F.lit("2024-01-01").cast("date"), F.col("d")).alias("date"), "nav")


def test_forward_fill_and_calendar(spark):
    df = series(spark, [1.0, None, None, 4.0]).filter("nav is not null or day(date) = 2")
    assert [r["nav"] for r in TS.forward_fill(df).orderBy("date").collect()] == [1.0, 1.0, 1.0, 4.0]
    assert [r["nav"] for r in TS.calendar(df).orderBy("date").collect()] == [1.0, None, None, 4.0]


def test_constant_series_scales_to_zero(spark):
    assert {r["nav_scaled"] for r in TS.minmax_by(series(spark, [2.0, 2.0, None])).collect()} == {0.0, None}


def test_momentum_needs_thirty_rows(spark):
    assert TS.momentum_forecast(series(spark, [1.0] * 29)).count() == 0
    got = TS.momentum_forecast(series(spark, [float(i) for i in range(30)])).orderBy("step").collect()
    assert [r["forecast"] for r in got] == [29.8, 30.6, 31.4, 32.2, 33.0]
    assert got[0]["trend"] == "UPWARD"


def test_temporal_split_truncates(spark):
    got = [r["split"] for r in TS.temporal_split(series(spark, [1.0] * 11)).orderBy("date").collect()]
    assert got == ["train"] * 7 + ["val"] + ["test"] * 3


@pytest.mark.parametrize("span,n", [(20, 1900), (2, 1500), (1, 50), (300, 1200)])
def test_ema_is_the_recursion(spark, span, n):
    rnd = random.Random(2)
    v = [rnd.random() * 10 ** (i % 7 - 3) for i in range(n)]
    got = [r["e"] for r in TS.ema(series(spark, v), span, name="e").orderBy("date").collect()]
    e, a = v[0], 2 / (span + 1)
    for x, g in zip(v, got):
        e = e if x is v[0] else a * x + (1 - a) * e
        assert g == pytest.approx(e, rel=1e-9)


def test_ema_keeps_its_value_over_nulls(spark):
    got = [r["e"] for r in TS.ema(series(spark, [None, 2.0, None, 4.0, None]), 3, name="e").orderBy("date").collect()]
    assert got == [None, 2.0, 2.0, 3.0, 3.0]


def test_lag_forecast_is_the_regression_on_all_samples(spark):
    import numpy as np
    from fundloom.operators import models as M
    rnd = random.Random(5)
    lengths = [3, 8, 9, 12, 40, 120]
    data = [(f"s{k}", dt.date(2020, 1, 1) + dt.timedelta(days=i), rnd.random() + i / 50) for k, n in enumerate(lengths) for i in range(n)]
    df = spark.createDataFrame(data, "scheme string, date date, nav double")
    model = M.fit_nav_forecast(df, lookback=6, horizon=3, reg=0.0)
    x, y, rows = [], [], {}
    for s, _, v in data:
        rows.setdefault(s, []).append(v)
    for v in rows.values():
        for i in range(len(v) - 8):
            x.append([1.0, *v[i : i + 6]])
            y.append(v[i + 6 : i + 9])
    want = np.linalg.lstsq(np.array(x), np.array(y), rcond=None)[0]
    assert np.array(model.intercepts) == pytest.approx(want[0], abs=1e-8)
    assert np.array(model.weights).T == pytest.approx(want[1:], abs=1e-8)
    got = M.apply_nav_forecast(df, model).filter("step_1 IS NOT NULL").orderBy("scheme", "date").collect()
    assert len(got) == sum(max(0, n - 5) for n in lengths)
    first = rows["s1"][:6]
    assert next(r for r in got if r.scheme == "s1").step_2 == pytest.approx(want[0, 1] + np.dot(first, want[1:, 1]))
    empty = M.fit_nav_forecast(df.limit(0), lookback=6, horizon=3)
    assert set(empty.intercepts) == {0.0} and M.apply_nav_forecast(df, empty).count() == len(data)


def test_rolling_drift_over_chunk_edges(spark):
    data = [(i, f"t{i}", "negative" if i % 3 else "positive") for i in range(300)]
    df = spark.createDataFrame(data, "id int, title string, sentiment string").withColumn("ts", F.timestamp_seconds("id"))
    got = TS.drift_series(df, "ts", "id", chunk=60).orderBy("rank").collect()
    score = [-0.5 if i % 3 else 0.5 for i in range(300)]
    for i, r in enumerate(got):
        w = score[max(0, i - 49):i + 1]
        assert r["samples"] == len(w) and r["mean_score"] == pytest.approx(sum(w) / len(w))
    assert not got[10]["drift_detected"] and got[11]["drift_detected"]


def test_mean_shift_of_nothing(spark):
    r = TS.mean_shift(spark.createDataFrame([], "score double, t int"), "score", ["t"]).first()
    assert (r["n"], r["mean_score"], r["drift"]) == (0, 0.0, False)


# ---- risk and impact -----------------------------------------------------------------------

HOLD = "portfolio int, fund_id int, fund_name string, category string, sector string, value double, returns double, persona string"
MARKET = "vix double, change_pct double, market_status string, sentiment string, volume_spike boolean"


def test_risk_of_one_portfolio(spark):
    h = spark.createDataFrame([(1, 1, "Alpha", "equity", "IT", 60000.0, 10.0, "conservative"), (1, 2, "Liquid", "debt", None, 40000.0, 5.0, "conservative")], HOLD)
    m = spark.createDataFrame([(22.0, -2.5, "OPEN", "bearish", True)], MARKET)
    r = K.risk_score(h, m).first()
    beta, var, dd = round(0.7 * 1.1, 2), round(100000 * 1.645 * 0.22, 2), round(0.12 * 1.1 * 100, 2)
    assert (r["beta"], r["var_95"], r["max_drawdown"], r["sharpe_ratio"]) == (beta, var, dd, round(2 / 22, 2))
    assert r["portfolio_risk_score"] == round((beta * 20 + var / 10000 + dd * 1.5) * 1.15 * 1.5, 1)
    assert r["risk_level"] == "high"
    a = K.risk_alerts(h, m).first()
    assert a["alerts"] == ["volume_spike", "elevated_vix", "market_down_over_2pct", "equity_high_for_conservative", "sector_over_half"]
    assert a["recommendations"] == ["raise_liquid_and_debt", "pause_equity_sips", "keep_emergency_corpus", "diversify_categories"]


def test_worthless_portfolio_does_not_divide_by_zero(spark):
    h = spark.createDataFrame([(1, 1, "A", "equity", "IT", 0.0, 1.0, "growth")], HOLD)
    m = spark.createDataFrame([(0.0, 0.0, "OPEN", "neutral", False)], MARKET)
    r = K.portfolio_health(h, m).first()
    assert r["sector_concentration_pct"] == 0 and r["fund_overlap_pct"] == 0
    assert K.sharpe(h, m).first()["sharpe_ratio"] == 0


def test_a_phrase_across_two_texts_counts(spark):
    s = spark.createDataFrame([(1, 1, "RBI plans a rate"), (1, 2, "  "), (1, 3, "hike says bank"), (2, 1, "hike"), (2, 2, "rate")], "g int, t int, title string")
    m = spark.createDataFrame([(15.0, "neutral")], "vix double, sentiment string")
    got = {(r["g"], r["sector"]): r["impact"] for r in I.sector_impact(s, m, "g", ["t"]).collect()}
    # rbi and "rate hike"; no separator counts as a text
    assert got[1, "Banking"] == 0.7 and got[1, "Debt"] == -0.15
    assert got[2, "Banking"] == 0.0
    e = {r["g"]: (r["headline"], r["opening"]) for r in I.impact_explain(s, "g", ["t"]).collect()}
    assert e[1] == ("RBI plans a rate", "rbi plans a rate hike says bank")


@pytest.mark.parametrize("vix,text,want", [(28.0, "growth", "critical"), (22.0, "growth", "high"), (18.0, "growth", "positive"), (18.5, "growth", "moderate"), (10.0, "hike crash", "critical")])
def test_severity_boundaries(spark, vix, text, want):
    s = spark.createDataFrame([(1, 1, text)], "g int, t int, title string")
    m = spark.createDataFrame([(vix, "neutral")], "vix double, sentiment string")
    assert I.impact_severity(s, m, "g", ["t"]).first()["severity"] == want


# ---- search, neighbours, clusters against brute force ----------------------------------------

def test_cosine_blocks(spark):
    rnd = np.random.default_rng(3)
    v = rnd.normal(size=(300, 8))
    v[5] = v[6] = v[7]
    v[9] = 0
    df = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(v)], "id int, embedding array<double>")
    q = df.filter("id < 20").withColumnRenamed("id", "qid")
    got = {}
    for r in S.cosine_topk(q, df, "qid", "id", k=4, query_block=7, corpus_block=50).collect():
        got.setdefault(r["qid"], {})[r["rank"]] = r["id"]
    n = np.linalg.norm(v, axis=1)
    sim = np.round(np.divide(v @ v.T, np.outer(n, n), out=np.zeros((300, 300)), where=np.outer(n, n) > 0), 12)
    for i in range(20):
        assert [got[i][k] for k in (1, 2, 3, 4)] == sorted(range(300), key=lambda j: (-sim[i, j], j))[:4]


def test_knn_blocks_agree(spark):
    rnd = random.Random(4)
    data = [(i, *[None if rnd.random() < 0.15 else rnd.random() for _ in range(3)]) for i in range(120)]
    df = spark.createDataFrame(data, "id int, a double, b double, c double")
    a = rows(E.knn_impute(df, "id", ["a", "b", "c"], block=8192), "id")
    b = rows(E.knn_impute(df, "id", ["a", "b", "c"], block=17), "id")
    assert np.allclose(np.array(a), np.array(b))

    def fill(i, c):
        x, out = data[i][1:], []
        for j, *y in data:
            both = [k for k in range(3) if x[k] is not None and y[k] is not None]
            if j != i and y[c] is not None and both:
                out.append((math.sqrt(sum((x[k] - y[k]) ** 2 for k in both) * 3 / len(both)), j, y[c]))
        best = sorted(out)[:5]
        return sum(v for _, _, v in best) / len(best) if best else None

    for r in a:
        for c in range(3):
            if data[r[0]][c + 1] is not None:
                assert r[c + 1] == data[r[0]][c + 1]
            elif fill(r[0], c) is not None:
                assert r[c + 1] == pytest.approx(fill(r[0], c))


@pytest.mark.parametrize("chunk", [2048, 16])
def test_density_clusters_are_dbscan(spark, chunk):
    rnd = np.random.default_rng(5)
    pts = np.concatenate([rnd.normal((0.2, 0.2), 0.03, (60, 2)), rnd.normal((0.7, 0.6), 0.05, (60, 2)), rnd.random((25, 2)), np.full((30, 2), 0.95)])
    eps, need = 0.08, 6
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(pts)], "id int, a double, b double")
    got = {r["id"]: r["cluster"] for r in C.density_cluster(df, "id", ["a", "b"], eps, need, chunk).collect()}
    near = ((pts[:, None] - pts[None]) ** 2).sum(2) <= eps * eps
    core = near.sum(1) >= need
    comp = list(range(len(pts)))
    find = lambda i: i if comp[i] == i else find(comp[i])
    for i, j in zip(*np.nonzero(near)):
        if core[i] and core[j]:
            comp[find(i)] = find(j)
    for i in range(len(pts)):
        if core[i]:
            assert all((got[i] == got[j]) == (find(i) == find(j)) for j in range(len(pts)) if core[j])
        elif (near[i] & core).any():
            assert got[i] in {got[j] for j in np.flatnonzero(near[i] & core)}
        else:
            assert got[i] == -1


def test_tfidf_rows_have_unit_length(spark):
    df = spark.createDataFrame([(1, "gold bond fund"), (2, "gold index"), (3, "")], "id int, t string")
    w = S.tfidf(df, "id", "t", bigrams=False)
    assert all(r["s"] == pytest.approx(1) for r in w.groupBy("id").agg(F.sum(F.col("weight") ** 2).alias("s")).collect())
    idf_gold, idf_index = math.log(4 / 3) + 1, math.log(4 / 2) + 1
    got = {(r["id"], r["term"]): r["weight"] for r in w.collect()}
    assert got[2, "gold"] == pytest.approx(idf_gold / math.hypot(idf_gold, idf_index))


def test_knowledge_retrieval(spark):
    kb = spark.createDataFrame([("General", "both", ["hello"], "general help hello"), ("SIP", "investor", ["sip"], "monthly sip plan"),
                                ("Leads", "distributor", ["lead"], "hot lead call")], "title string, audience string, tags array<string>, text string")
    chat = D.route_utterances(spark.createDataFrame([("1", "Start a monthly SIP"), ("2", "zzz"), ("3", "call my lead")], "cid string, text string"))
    got = {r["cid"]: (r["matched_topic"], r["confidence"]) for r in S.kb_retrieve(chat, kb, "cid", "utterance", "General").collect()}
    assert got["1"][0] == "SIP" and got["1"][1] == 0.97
    assert got["2"] == ("General", 0.42)
    assert got["3"][0] == "Leads"


def test_only_general_questions_fall_back_to_the_default_item(spark):
    kb = spark.createDataFrame([("General", "both", ["hello"], "general help"), ("Alpha", "investor", ["zzz"], "alpha text"), ("Beta", "distributor", [], "beta text")],
                               "title string, audience string, tags array<string>, text string")
    chat = spark.createDataFrame([("1", "zzz qqq", "tax", "investor"), ("2", "qqq", "tax", "distributor"), ("3", "qqq", "general", "both"), ("4", "qqq", "tax", "both")],
                                 "cid string, utterance string, intent string, audience string")
    got = {r["cid"]: r["matched_topic"] for r in S.kb_retrieve(chat, kb, "cid", "utterance", "General").collect()}
    assert got == {"1": "Alpha", "2": "Beta", "3": "General", "4": "Alpha"}


# ---- evaluation and models -----------------------------------------------------------------

def test_report_with_an_empty_class(spark):
    df = spark.createDataFrame([(0, 0), (0, 0), (1, 0)], "y int, p int")
    got = {r["class"]: r for r in EV.classification_report(df, "y", "p").collect()}
    assert got["1"]["precision"] == 0 and got["1"]["recall"] == 0 and got["1"]["support"] == 1
    assert got["accuracy"]["f1"] == pytest.approx(2 / 3)


def test_auc_with_ties(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.5), (1, 0.5), (0, 0.1)], "y int, p double")
    assert EV.roc_auc(df, "y", "p").first()[0] == 0.875
    assert EV.average_precision(df, "y", "p").first()[0] == pytest.approx(0.5 + 0.5 * 2 / 3)
    assert EV.roc_curve(df, "y", "p").filter("isnan(threshold) or threshold > 1").count() == 1


def test_first_best_threshold_wins(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.1)], "y int, p double")
    assert EV.threshold_search(df, "y", "p").first()["threshold"] == 0.25
    assert len(EV.THRESHOLDS) == 29 and EV.THRESHOLDS[-1] == 0.81


def test_split_and_folds(spark):
    df = spark.range(203).select(F.col("id"), (F.col("id") % 4 == 0).cast("int").alias("y"))
    s = E.stratified_split(df, "y", "id")
    assert rows(s.groupBy("y").agg(F.count_if("is_test")), "y") == [(0, 31), (1, 11)]
    f = E.stratified_folds(df, "y", "id", 5).groupBy("y", "fold").count().collect()
    assert {r["y"]: None for r in f} and max(r["count"] for r in f if r["y"] == 0) - min(r["count"] for r in f if r["y"] == 0) <= 1


def test_encoders(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("c",)], "s string")
    assert {r["s"]: r["s_encoded"] for r in E.label_encode(df, "s").collect()} == {"a": 0, "b": 1, "c": 2, None: 3}
    assert E.dummies(df, "s", drop_first=True).columns == ["s", "s_b", "s_c"]


def test_lead_model(spark):
    from fundloom.operators import models as M
    df = spark.range(600).select((F.col("id") % 10).alias("totalvisits"), F.when(F.col("id") % 2 == 0, "Web").alias("lead_source"),
                                 (F.col("id") % 10 > 6).cast("int").alias("converted"), "id")
    num, cat = ["totalvisits"], ["lead_source"]
    model = M.fit_lead_model(df, num, cat, trees=10, depth=4)
    scored = M.score_leads(df, model, num=num, cat=cat)
    assert scored.columns == [*df.columns, "pred_label", "pred_proba"]
    assert scored.filter("pred_proba < 0 or pred_proba > 1").count() == 0
    assert scored.filter("pred_label = converted").count() >= 590
    assert scored.schema["totalvisits"].dataType == df.schema["totalvisits"].dataType
    own = M.score_with_function(df, lambda p: (p["totalvisits"] > 6).astype(float))
    assert own.filter("pred_label <> converted").count() == 0
    again = M.score_leads(df, M.fit_lead_model(df, num, cat, trees=10, depth=4), num=num, cat=cat)
    assert rows(again.select("id", "pred_proba"), "id") == rows(scored.select("id", "pred_proba"), "id")


def test_sentiment_model(spark):
    from fundloom.operators import models as M
    df = spark.createDataFrame([("great profit up", "positive"), ("bad loss down", "negative"), ("it is so", "neutral")] * 20, "t string, label string")
    model = M.fit_sentiment(df, "t", "label")
    got = {r["t"]: r for r in M.score_sentiment(spark.createDataFrame([("great profit",), ("",), (None,)], "t string"), model, "t", positive=2).collect()}
    assert got["great profit"]["predicted_label"] == "positive"
    assert got[""]["p_positive"] == 0.5 and got[None]["p_positive"] == 0.5


def test_personas(spark):
    df = spark.range(90).select("id", *[(F.col("id") % 3 * 5 + F.rand(1)).alias(c) for c in ("a", "b", "c")])
    got = C.fit_personas(df, ["a", "b", "c"], 3).transform(df)
    assert got.groupBy(F.col("id") % 3).agg(F.count_distinct("cluster").alias("n")).filter("n <> 1").count() == 0
    k, table = C.choose_k(df, ["a", "b", "c"], range(2, 5))
    assert k == 3 and table.count() == 3


# ---- plans ---------------------------------------------------------------------------------

def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(tables):
    df = X.filter_in(tables.customer, {"c_mktsegment": ["BUILDING"]}).select("c_custkey")
    assert "In(c_mktsegment" in plan(df) or "EqualTo(c_mktsegment" in plan(df)
    assert "c_acctbal" not in plan(df)


def test_top_k_is_limited_before_the_shuffle(tables):
    df = T.topk(tables.lineitem, ["l_suppkey"], [F.desc("l_quantity"), F.col("l_orderkey")], 3)
    assert plan(df).count("WindowGroupLimit") == 2


@pytest.mark.parametrize("name", ["risk_scores", "fund_recommendations", "iqr_outliers", "rolling_drift", "sector_impact", "tfidf_search", "roc_auc", "winsorize"])
def test_no_cartesian_and_no_python(spark, folder, name):
    import __spark_entry__ as entry
    text = plan(entry.queries()[name](spark, folder))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "Python" not in text and "InPandas" not in text


def test_statistics_stay_in_the_plan(tables):
    df = Q.impute(tables.orders.select("o_totalprice"), "mean", ["o_totalprice"])
    assert "Subquery" in plan(df)


def test_sentiment_names_every_label(spark):
    df = spark.createDataFrame([(f"word{i} of {i}x", f"l{i:03d}") for i in range(150) for _ in range(2)], "text string, label string")
    from fundloom.operators import models as M
    model = M.fit_sentiment(df, "text", "label", min_df=1, max_iter=60, strength=1000.0, buckets=1 << 12)
    out = M.score_sentiment(df, model, "text")
    assert out.filter("predicted_label = label").count() == 300 and "label" in out.columns
