"""Encoders, scalers, splits, models and clusters."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Window, functions as F

from ..functions.words import TRAITS
from ..operators import boosting as B, clusters as C, evaluation as EV, features as E, models as M, quality as Q
from ..sources.scratch import cut_lineage
from . import etl, views as V
from .registry import query

NUM, CAT = ["total_visits", "time_spent", "page_views", "activity"], ["lead_source", "lead_origin", "country"]
#: The published grid of boosted trees: 32 points.
LEAD_GRID = {"rounds": [180, 240], "depth": [5, 6], "step": [0.04, 0.06], "rows": [0.85, 0.95], "columns": [0.85, 0.95]}


@query("""SELECT lead_id, CAST(lead_origin = 'origin_0' AS INTEGER) AS origin_0, CAST(lead_origin = 'origin_2' AS INTEGER) AS origin_2 FROM leads""", "leads")
def onehot_columns(t):
    return E.dummies(V.leads(t), "lead_origin").select("lead_id", F.col("lead_origin_origin_0").alias("origin_0"), F.col("lead_origin_origin_2").alias("origin_2"))


@query("""SELECT lead_source, count(*) AS n, CAST(dense_rank() OVER (ORDER BY lead_source) - 1 AS DOUBLE) AS slot FROM leads GROUP BY 1""", "leads")
def onehot_vectors(t):
    o = E.onehot(V.leads(t), ["lead_source"])
    slot = F.array_position(vector_to_array("lead_source_vec"), 1.0) - 1
    return o.groupBy("lead_source").agg(F.count("*").alias("n"), F.max(slot).cast("double").alias("slot"))


@query("""SELECT lead_id, dense_rank() OVER (ORDER BY coalesce(lead_quality, 'nan')) - 1 AS lead_quality_encoded FROM leads""", "leads")
def label_encoding(t):
    return E.label_encode(V.leads(t), "lead_quality").select("lead_id", "lead_quality_encoded")


@query("""SELECT lead_id, round(avg(converted) OVER (PARTITION BY lead_source), 6) AS lead_source_target FROM leads""", "leads")
def target_encoding(t):
    return E.target_encode(V.leads(t), "lead_source", "converted").select("lead_id", F.round("lead_source_target", 6).alias("lead_source_target"))


@query("""SELECT investor_id, round((Affordability - min(Affordability) OVER ()) / (max(Affordability) OVER () - min(Affordability) OVER ()), 8) AS a,
 round((Growth - min(Growth) OVER ()) / (max(Growth) OVER () - min(Growth) OVER ()), 8) AS g FROM traits WHERE Technology IS NOT NULL""", "traits")
def minmax_vectors(t):
    m = E.minmax_vector(V.traits(t), ["Affordability", "Growth", "Technology"])
    v = vector_to_array("num_features")
    return m.select("investor_id", F.round(v[0], 8).alias("a"), F.round(v[1], 8).alias("g"))


@query("""SELECT investor_id, round((Affordability - avg(Affordability) OVER ()) / stddev_pop(Affordability) OVER (), 6) AS z FROM traits""", "traits")
def standard_scaling(t):
    return E.standard_scale(V.traits(t), ["Affordability"]).select("investor_id", F.round("Affordability_z", 6).alias("z"))


@query("""SELECT l_orderkey, l_linenumber, round((l_extendedprice - m) / (b - a), 6) AS scaled FROM lineitem, (SELECT quantile_cont(l_extendedprice, 0.25) AS a, quantile_cont(l_extendedprice, 0.5) AS m, quantile_cont(l_extendedprice, 0.75) AS b FROM lineitem)""")
def robust_scaling(t):
    return E.robust_scale(t.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice"), "l_extendedprice", "scaled").select("l_orderkey", "l_linenumber", F.round("scaled", 6).alias("scaled"))


KNN = ["Affordability", "Liquidity", "Growth", "Technology"]


@query(f"""WITH b AS (SELECT investor_id AS id, {', '.join(KNN)} FROM traits), g AS (SELECT * FROM b WHERE Technology IS NULL),
d AS (SELECT g.id, b.id AS donor, b.Technology AS v, sqrt((pow(g.Affordability - b.Affordability, 2) + pow(g.Liquidity - b.Liquidity, 2) + pow(g.Growth - b.Growth, 2)) * 4 / 3) AS dist FROM g, b WHERE b.Technology IS NOT NULL),
f AS (SELECT id, avg(v) AS v FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY dist, donor) AS rn FROM d) WHERE rn <= 5 GROUP BY 1)
SELECT b.id AS investor_id, round(coalesce(b.Technology, f.v), 6) AS Technology FROM b LEFT JOIN f USING (id)""", "traits")
def knn_imputation(t):
    tr = V.traits(t)
    return E.knn_impute(tr, "investor_id", KNN).select("investor_id", F.round("Technology", 6).alias("Technology"))


@query("""SELECT converted, CAST(ceil(count(*) * 0.2::DOUBLE) AS BIGINT) AS test_rows, count(*) AS n_rows FROM leads GROUP BY 1""", "leads")
def stratified_split(t):
    s = E.stratified_split(V.leads(t), "converted", "lead_id")
    return s.groupBy("converted").agg(F.count_if("is_test").alias("test_rows"), F.count("*").alias("n_rows"))


@query("""SELECT lead_id, round(n / (k * m), 8) AS weight FROM leads JOIN (SELECT converted, count(*) AS m, sum(count(*)) OVER () AS n, count(*) OVER () AS k FROM leads GROUP BY 1) USING (converted)""", "leads")
def class_weights(t):
    return E.class_weights(V.leads(t), "converted").select("lead_id", F.round("weight", 8).alias("weight"))


@query()
def hashed_tfidf(t):
    m = E.hashing_tfidf(t.documents, "text")
    return m.transform(t.documents).select("doc_id", E.positive_entries("tfidf").alias("terms"))


def saved_split(t):
    """The model's columns and the split, ranked once; fitting and scoring read the same table."""
    # the label must not be a function of a feature: converted follows the account balance, features the orders;
    # the split reads its rows several times, so the leads' joins are saved before it
    lead = cut_lineage(M.feature_frame(V.leads(t), NUM, CAT).select("lead_id", *NUM, *CAT, "converted"))
    return cut_lineage(E.stratified_split(lead, "converted", "lead_id").select("lead_id", *NUM, *CAT, "converted", "is_test"))


@query()
def lead_model_scores(t):
    data = saved_split(t)
    model = M.fit_lead_model(data.filter("not is_test"), NUM, CAT, "converted")
    return M.score_leads(data.filter("is_test"), model, 0.5, NUM, CAT).select("lead_id", "converted", "pred_label", "pred_proba")


@query()
def boosted_lead_model(t):
    data = saved_split(t)
    model = B.fit_boosted(data.filter("not is_test"), NUM, CAT, "converted", "lead_id")
    return EV.classification_report(B.score_boosted(data.filter("is_test"), model), "converted", "pred_label")


@query()
def lead_feature_importance(t):
    data = V.leads(t)
    return M.top_features(M.fit_lead_model(data, NUM, CAT, "converted"), data, NUM, CAT, 10)


@query()
def lead_grid_search(t):
    data = saved_split(t).filter("not is_test")
    return B.boosted_grid(data, NUM, CAT, "converted", "lead_id", LEAD_GRID)


@query()
def activity_scores(t):
    lead = V.leads(t).withColumnsRenamed({"total_visits": "totalvisits", "time_spent": "total_time_spent_on_website", "page_views": "page_views_per_visit"})
    model = M.fit_lead_model(lead)
    few = lead.select("lead_id", "totalvisits", "total_time_spent_on_website", "page_views_per_visit")
    return M.score_activity(few, model).select("lead_id", "pred_label", "pred_proba")


@query()
def sentiment_model(t):
    data = t.documents.join(t.labels, "doc_id").withColumn("quality", F.col("quality").cast("string"))
    model = M.fit_sentiment(data, "text", "quality")
    return M.score_sentiment(t.documents.select("doc_id", "text"), model, "text").select("doc_id", "predicted_label", "confidence", "p_positive")


@query()
def investor_personas(t):
    tr = V.traits(t)
    return C.fit_personas(tr, TRAITS).transform(tr).select("investor_id", "cluster")


@query()
def choose_k(t):
    return C.choose_k(V.traits(t), TRAITS)[1]


@query()
def cluster_stability(t):
    return C.cluster_stability(V.traits(t), TRAITS, 3)


SCALED = ", ".join(f"({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER ())" for c in TRAITS)
MOMENTS = ", ".join("[" + ", ".join(f"covar_samp(x[{i}], x[{j}])" for j in range(1, 8)) + "]" for i in range(1, 8))


@query(f"""WITH RECURSIVE c AS (SELECT investor_id, [{SCALED}] AS x FROM traits WHERE Technology IS NOT NULL), m AS (SELECT [{MOMENTS}] AS m FROM c),
tr AS (SELECT m[1][1] + m[2][2] + m[3][3] + m[4][4] + m[5][5] + m[6][6] + m[7][7] AS t FROM m),
p1(k, v) AS (SELECT 0, [1.0::DOUBLE, 0.9, 0.8, 0.7, 0.6, 0.5, 0.4] UNION ALL
 SELECT k + 1, list_transform(w, lambda y: y / sqrt(list_dot_product(w, w))) FROM (SELECT k, list_transform(m, lambda r: list_dot_product(r, v)) AS w FROM p1, m) WHERE k < 3000),
e1 AS (SELECT v, list_dot_product(v, list_transform(m, lambda r: list_dot_product(r, v))) AS l FROM p1, m WHERE k = 3000),
m2 AS (SELECT list_transform(range(1, 8), lambda i: list_transform(range(1, 8), lambda j: m[i][j] - l * v[i] * v[j])) AS m FROM m, e1),
p2(k, v) AS (SELECT 0, [0.4::DOUBLE, -0.9, 0.8, 0.7, -0.6, 0.5, 1.0] UNION ALL
 SELECT k + 1, list_transform(w, lambda y: y / sqrt(list_dot_product(w, w))) FROM (SELECT k, list_transform(m, lambda r: list_dot_product(r, v)) AS w FROM p2, m2) WHERE k < 3000),
e2 AS (SELECT v, list_dot_product(v, list_transform(m, lambda r: list_dot_product(r, v))) AS l FROM p2, m2 WHERE k = 3000)
SELECT investor_id, round(abs(list_dot_product(x, e1.v)), 5) AS pc1, round(abs(list_dot_product(x, e2.v)), 5) AS pc2, round(e1.l / t, 6) AS share1, round(e2.l / t, 6) AS share2 FROM c, e1, e2, tr""", "traits")
def pca_components(t):
    """A component's direction has no sign, so places along it are compared without one."""
    p = C.pca_2d(V.traits(t), "investor_id", TRAITS)
    return p.select("investor_id", *[F.round(F.abs(c), 5).alias(c) for c in ("pc1", "pc2")], *[F.round(c, 6).alias(c) for c in ("share1", "share2")])


SIL = ["Affordability", "Growth", "Trustworthiness"]


@query("""WITH p AS (SELECT investor_id AS id, CAST(investor_id % 3 AS INTEGER) AS c, Affordability AS a, Growth AS g, Trustworthiness AS r FROM traits),
d AS (SELECT p.id, p.c AS own, q.c AS other, sum(pow(p.a - q.a, 2) + pow(p.g - q.g, 2) + pow(p.r - q.r, 2)) AS s, count(*) AS n FROM p, p q GROUP BY 1, 2, 3),
m AS (SELECT id, own, max(s / (n - 1)) FILTER (own = other) AS a, min(s / n) FILTER (own <> other) AS b FROM d GROUP BY 1, 2)
SELECT id AS investor_id, own AS cluster, round((b - a) / greatest(a, b), 6) AS silhouette FROM m""", "traits")
def silhouette_points(t):
    tr = V.traits(t).withColumn("cluster", (F.col("investor_id") % 3).cast("int"))
    return EV.silhouette_points(tr, "investor_id", SIL, "cluster").withColumn("silhouette", F.round("silhouette", 6))


DENSE = ["Affordability", "Growth", "Liquidity"]
EPS, DENSE_POINTS = 0.08, 8
SIDE = EPS / 3 ** 0.5 * (1 - 1e-9)
NEAR = f"pow(p.a - q.a, 2) + pow(p.g - q.g, 2) + pow(p.l - q.l, 2) <= {EPS * EPS!r}::DOUBLE"


@query(f"""WITH RECURSIVE z AS (SELECT investor_id AS id, {', '.join(f'({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER ()) AS {n}' for c, n in zip(DENSE, 'agl'))} FROM traits),
pt AS (SELECT *, concat_ws(',', {', '.join(f'CAST(CAST(floor({n} / {SIDE!r}::DOUBLE) AS BIGINT) AS VARCHAR)' for n in 'agl')}) AS cell FROM z WHERE a IS NOT NULL AND g IS NOT NULL AND l IS NOT NULL),
core AS (SELECT pt.* FROM pt JOIN (SELECT p.id FROM pt p JOIN pt q ON {NEAR} GROUP BY 1 HAVING count(*) >= {DENSE_POINTS}) USING (id)),
e AS (SELECT DISTINCT p.cell AS a, q.cell AS b FROM core p JOIN core q ON {NEAR}),
cc(cell, low) AS (SELECT DISTINCT cell, cell FROM core UNION SELECT e.b, cc.low FROM cc JOIN e ON e.a = cc.cell WHERE cc.low < e.b),
own AS (SELECT core.id, c.low FROM core JOIN (SELECT cell, min(low) AS low FROM cc GROUP BY 1) c USING (cell)),
edge AS (SELECT p.id, min(own.low) AS low FROM pt p JOIN core q ON {NEAR} JOIN own ON own.id = q.id WHERE p.id NOT IN (SELECT id FROM core) GROUP BY 1),
named AS (SELECT * FROM own UNION ALL SELECT * FROM edge), no AS (SELECT low, row_number() OVER (ORDER BY low) - 1 AS no FROM (SELECT DISTINCT low FROM own))
SELECT pt.id AS investor_id, coalesce(no, -1) AS cluster FROM pt LEFT JOIN named USING (id) LEFT JOIN no USING (low)""", "traits")
def density_clusters(t):
    tr = E.minmax_scale(V.traits(t), DENSE)
    return C.density_cluster(tr, "investor_id", [f"{c}_scaled" for c in DENSE], eps=EPS, min_pts=DENSE_POINTS)


def _nav_split(t):
    from ..operators import timeseries as TS
    return TS.temporal_split(TS.minmax_global(V.nav(t), name="y").select("scheme", "date", "y"))


NAV_SPLIT = """y AS (SELECT scheme, date, (nav - min(nav) OVER ()) / (max(nav) OVER () - min(nav) OVER ()) AS y, row_number() OVER (PARTITION BY scheme ORDER BY date) - 1 AS i, count(*) OVER (PARTITION BY scheme) AS n FROM nav),
train AS (SELECT scheme, date, y, i FROM y WHERE i < floor(n * 0.7::DOUBLE))"""


@query(f"""WITH {NAV_SPLIT}, r AS (SELECT scheme, y, i, count(*) OVER (PARTITION BY scheme) - 1 - i AS j FROM train),
p AS (SELECT a.i, a.j, b.i - a.i AS lag, a.y * b.y AS v FROM r a JOIN r b ON a.scheme = b.scheme AND b.i BETWEEN a.i AND a.i + 34)
SELECT CAST(CASE WHEN i < 35 THEN i END AS INTEGER) AS head, CAST(CASE WHEN j < 35 THEN j END AS INTEGER) AS tail, count(*) FILTER (lag = 0) AS n,
 {', '.join(f"round(sum(v) FILTER (lag = {d}), 7) AS p{d}" for d in (0, 1, 2, 5, 10, 20, 29, 30, 34))} FROM p GROUP BY 1, 2""", "nav")
def nav_lag_sums(t):
    s = M.lag_sums(_nav_split(t).filter("split = 'train'"), col="y", lookback=30, horizon=5)
    return s.select("head", "tail", "n", *[F.round(f"p{d}", 7).alias(f"p{d}") for d in (0, 1, 2, 5, 10, 20, 29, 30, 34)])


@query()
def nav_lag_forecast(t):
    split = cut_lineage(_nav_split(t))
    model = M.fit_nav_forecast(split.filter("split = 'train'"), col="y", lookback=30, horizon=5)
    held = M.apply_nav_forecast(split.filter("split = 'test'"), model, col="y")
    after = Window.partitionBy("scheme").orderBy("date")
    # as many values must follow as are forecast
    whole = held.withColumns({"actual": F.lead("y", 1).over(after), "_fifth": F.lead("y", 5).over(after)}).filter("_fifth IS NOT NULL")
    return EV.regression_metrics(whole, "actual", "step_1")


@query()
def lead_preprocessing(t):
    lead = V.leads(t).select("lead_id", "total_visits", "time_spent", "page_views", "lead_origin", "country", "lead_quality", "lead_source", "converted")
    return etl.lead_preprocess(lead, "lead_id")
