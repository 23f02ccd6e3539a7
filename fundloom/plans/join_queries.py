"""Joins, merges, matching, recommendations and catalogue queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregates as A, collab as C, derive as D, joins as J, recommend as R, topk as K
from . import views as V
from .registry import query


@query("""SELECT id, current_age, round(coalesce(s, 0), 2) AS behavior_spend_sum, coalesce(n, 0) AS behavior_spend_count FROM users
LEFT JOIN (SELECT client_id, sum(CAST(replace(amount, '$', '') AS DOUBLE)) AS s, count(*) AS n FROM txns GROUP BY 1) ON client_id = id""", "users txns")
def users_with_spend(t):
    p = J.investor_profiles(V.users(t), A.client_spend(V.txns(t)))
    return p.select("id", "current_age", F.round("behavior_spend_sum", 2).alias("behavior_spend_sum"), "behavior_spend_count")


@query("""SELECT s_suppkey, s_name, coalesce(n_name, 'elsewhere') AS n_name FROM supplier LEFT JOIN (SELECT * FROM nation WHERE n_nationkey < 20) ON s_nationkey = n_nationkey""")
def dimension_lookup(t):
    dim = t.nation.filter("n_nationkey < 20").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    return J.lookup(t.supplier, dim, "s_nationkey", {"n_name": "elsewhere"}).select("s_suppkey", "s_name", "n_name")


@query("""SELECT p_partkey, vix, sentiment FROM part, (SELECT vix, sentiment FROM market ORDER BY ts DESC, snap DESC LIMIT 1)""", "market")
def current_market(t):
    newest = K.latest(V.market(t), "ts", "snap")
    return J.with_market(t.part, newest).select("p_partkey", "market.vix", "market.sentiment")


KEYWORDS = {"a": ["ring", "widget"], "b": ["red", "small", "re"], "c": ["zz"]}


@query("""SELECT p_partkey, label, keyword FROM part, (VALUES ('a', 'ring'), ('a', 'widget'), ('b', 'red'), ('b', 'small'), ('b', 're'), ('c', 'zz')) k(label, keyword) WHERE contains(lower(p_name), keyword)""")
def keyword_hits(t):
    return D.keyword_hits(t.part, "p_name", KEYWORDS).select("p_partkey", F.inline("hits"))


@query("""SELECT a.item, b.item AS other, count(*) AS users FROM pairs a JOIN pairs b ON a."user" = b."user" GROUP BY 1, 2""", "pairs")
def item_cooccurrence(t):
    return C.cooccurrence(A.interaction_pairs(V.interactions(t)))


COLLAB = """c AS (SELECT a.item AS i, b.item AS j, count(*) AS n FROM pairs a JOIN pairs b ON a."user" = b."user" GROUP BY 1, 2),
s AS (SELECT p."user", c.j AS item, CAST(sum(c.n) AS DOUBLE) AS score FROM pairs p JOIN c ON c.i = p.item GROUP BY 1, 2),
u AS (SELECT * FROM s WHERE NOT EXISTS (SELECT 1 FROM pairs p WHERE p."user" = s."user" AND p.item = s.item))"""


@query(f"""WITH {COLLAB} SELECT "user", item, score FROM u""", "pairs")
def cooccurrence_scores(t):
    return C.cooccurrence_scores(A.interaction_pairs(V.interactions(t)))


@query(f"""WITH {COLLAB}, want AS (SELECT CAST(c_custkey AS VARCHAR) AS "user" FROM customer UNION SELECT 'new-' || CAST(s_suppkey AS VARCHAR) FROM supplier),
pop AS (SELECT item, CAST(count(*) AS DOUBLE) AS score, row_number() OVER (ORDER BY count(*) DESC, item) AS rank FROM pairs GROUP BY 1)
SELECT "user", item, score, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY "user" ORDER BY score DESC, item) AS rank FROM u) WHERE rank <= 5
UNION ALL SELECT "user", item, score, CAST(rank AS INTEGER) FROM want, pop WHERE rank <= 5 AND "user" NOT IN (SELECT "user" FROM pairs)""", "pairs")
def collab_recommendations(t):
    users = t.customer.select(F.col("c_custkey").cast("string").alias("user")).unionByName(
        t.supplier.select(F.concat(F.lit("new-"), F.col("s_suppkey").cast("string")).alias("user")))
    return C.collab_recommend(A.interaction_pairs(V.interactions(t)), users, 5)


@query("""SELECT p_partkey FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 48)""")
def exclude_seen(t):
    seen = t.lineitem.filter("l_quantity > 48").select(F.col("l_partkey").alias("p_partkey"))
    return J.exclude(t.part, seen, ["p_partkey"]).select("p_partkey")


@query("""SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity = 50)""")
def requested_orders(t):
    ids = t.lineitem.filter("l_quantity = 50").select(F.col("l_orderkey").alias("o_orderkey"))
    return J.fetch_ids(t.orders, ids, "o_orderkey").select("o_orderkey", "o_totalprice")


@query("""SELECT lead_id, CASE WHEN new THEN coalesce(nullif(trim(fn || ' ' || ln), ''), '') ELSE name END AS name, status, notes, assignee, next_step_at FROM (
SELECT coalesce(b.lead_id, u.lead_id) AS lead_id, b.lead_id IS NULL AS new, b.name, coalesce(u.fn, '') AS fn, coalesce(u.ln, '') AS ln,
  coalesce(u.status, b.status, CASE WHEN b.lead_id IS NULL THEN 'New' END) AS status, coalesce(u.notes, CASE WHEN b.lead_id IS NULL THEN '' END) AS notes,
  CASE WHEN b.lead_id IS NULL THEN '' END AS assignee, CASE WHEN b.lead_id IS NULL THEN '' END AS next_step_at
FROM (SELECT lead_id, name, status FROM leads WHERE c_custkey % 3 <> 0) b FULL JOIN
 (SELECT lead_id, 'First' || lead_id AS fn, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE 'Last' END AS ln, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE 'Won' END AS status, 'called' AS notes FROM leads WHERE c_custkey % 2 = 0) u
ON b.lead_id = u.lead_id)""", "leads")
def upsert_leads(t):
    lead = V.leads(t)
    k = F.col("c_custkey")
    base = lead.filter(k % 3 != 0).select("lead_id", "name", "status")
    upd = lead.filter(k % 2 == 0).select("lead_id", F.concat(F.lit("First"), "lead_id").alias("first_name"), F.when(k % 4 != 0, "Last").alias("last_name"),
                                         F.when(k % 5 != 0, "Won").alias("status"), F.lit("called").alias("notes"))
    return J.upsert(base, upd).select("lead_id", "name", "status", "notes", "assignee", "next_step_at")


@query("""SELECT s_suppkey AS id, CASE WHEN s_suppkey % 2 = 0 THEN 'custom' ELSE s_name END AS name FROM supplier""")
def override_rows(t):
    base = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    return J.override(base, base.filter("id % 2 = 0").withColumn("name", F.lit("custom")), "id")


@query("""WITH inv AS (SELECT investor_id, CASE investor_id % 5 WHEN 0 THEN 'NJ IndiaInvest Pvt Ltd (National Distributor)' WHEN 1 THEN 'Zerodha Fund House / Coin' WHEN 2 THEN 'Local Advisors' ELSE NULL END AS d FROM traits),
fb(pos, n, s, f) AS (VALUES (1, 'NJ IndiaInvest Pvt Ltd (National Distributor)', 0.95::DOUBLE, 'Equity & High Growth Funds'), (2, 'Prudent Corporate Advisory Services Ltd', 0.88, 'Balanced & Hybrid Funds'),
 (3, 'State Bank of India (Wealth)', 0.82, 'Debt & Low Volatility Funds'), (4, 'Zerodha Fund House / Coin', 0.79, 'Index & Passive Funds')),
al AS (SELECT investor_id, 0 AS pos, d AS distributor_name, 0.98::DOUBLE AS match_score, 'Mine' AS offered_fund_type FROM inv WHERE d IS NOT NULL
 UNION ALL SELECT investor_id, pos, n, CASE WHEN d IS NULL THEN s ELSE round_even(s - 0.05::DOUBLE, 2) END, f FROM inv, fb WHERE d IS NULL OR d <> n)
SELECT investor_id, CAST(rank AS INTEGER) AS rank, distributor_name, match_score, offered_fund_type FROM (SELECT *, row_number() OVER (PARTITION BY investor_id ORDER BY pos) AS rank FROM al) WHERE rank <= 4""", "traits")
def distributor_matches(t):
    k = F.col("investor_id")
    inv = V.traits(t).select("investor_id", F.when(k % 5 == 0, "NJ IndiaInvest Pvt Ltd (National Distributor)").when(k % 5 == 1, "Zerodha Fund House / Coin")
                             .when(k % 5 == 2, "Local Advisors").alias("distributor"), F.lit("Mine").alias("fund_type"))
    return J.match_distributors(inv, "investor_id", n=4)


PERSONA = "CASE {k} % 4 WHEN 0 THEN 'growth' WHEN 1 THEN 'conservative' WHEN 2 THEN 'balanced' ELSE 'passive' END"


@query(f"""SELECT i.investor_id, d.s_suppkey, d.p AS distributor_persona, CASE WHEN d.p = i.p THEN CAST(95 AS INTEGER) ELSE CAST(75 AS INTEGER) END AS match_score
FROM (SELECT investor_id, {PERSONA.format(k='investor_id')} AS p FROM traits) i JOIN (SELECT s_suppkey, {PERSONA.format(k='s_suppkey')} AS p FROM supplier) d ON d.p = i.p OR d.p = 'balanced'""", "traits")
def persona_distributors(t):
    persona = lambda c: F.when(F.col(c) % 4 == 0, "growth").when(F.col(c) % 4 == 1, "conservative").when(F.col(c) % 4 == 2, "balanced").otherwise("passive").alias("persona")
    inv = V.traits(t).select("investor_id", persona("investor_id"))
    dist = t.supplier.select("s_suppkey", persona("s_suppkey"))
    return J.distributors_for(inv, dist).select("investor_id", "s_suppkey", "distributor_persona", "match_score")


@query("""SELECT scheme, count(*) AS n, round(corr(nav, close), 6) AS corr FROM nav JOIN bench USING (date) GROUP BY 1""", "nav bench")
def series_correlation(t):
    return J.pair_corr(V.nav(t), V.bench(t), ["date"], "nav", "close", by=["scheme"]).withColumn("corr", F.round("corr", 6))


@query("""SELECT * FROM catalog""", "catalog")
def fund_catalog(t):
    return V.catalog(t).drop("personas")


@query("""SELECT scheme_code, match_score, aum FROM catalog WHERE (category_group IN ('balanced', 'passive') OR risk IN ('medium', 'high'))
 AND (contains(lower(scheme_name), 'ring') OR contains(lower(category), 'ring') OR contains(lower(amc), 'ring') OR contains(lower(scheme_name), 'hybrid') OR contains(lower(category), 'hybrid') OR contains(lower(amc), 'hybrid'))
ORDER BY match_score DESC, aum DESC, scheme_code LIMIT 100""", "catalog")
def catalog_view(t):
    return R.catalog_view(V.catalog(t), "Balanced", "ring of-hybrid").select("scheme_code", "match_score", "aum")


@query("""SELECT scheme_code, r1, rating FROM catalog WHERE category_group IN ('growth', 'balanced') AND risk IN ('high', 'medium') AND r1 >= 15.0""", "catalog")
def fund_explorer(t):
    return K.explore_funds(V.catalog(t), ["growth", "balanced"], ["high", "medium"], 15.0).select("scheme_code", "r1", "rating")


PROFILES = """prof AS (SELECT id AS investor_id, CASE WHEN id % 3 = 0 THEN 'Aggressive (Equity)' WHEN id % 3 = 1 THEN 'Conservative (Debt)' ELSE 'Passive index' END AS risk_profile,
 CASE id % 4 WHEN 0 THEN 'small ring' WHEN 1 THEN 'brand#1 liquid' WHEN 2 THEN '' ELSE 'mid cap widget' END AS goals FROM users),
asked AS (SELECT investor_id, CASE WHEN risk_profile LIKE 'Agg%' THEN 'growth' WHEN risk_profile LIKE 'Con%' THEN 'conservative' ELSE 'passive' END AS persona,
  list_filter(regexp_split_to_array(lower(risk_profile || ' ' || goals), '[^a-z0-9]+'), lambda w: length(w) > 2) AS words FROM prof),
combo AS (SELECT DISTINCT persona, words FROM asked),
fit AS (SELECT persona, words, c.*, row_number() OVER (PARTITION BY persona, words ORDER BY match_score DESC, aum DESC, scheme_code) AS rank
  FROM combo JOIN catalog c ON (CASE persona WHEN 'growth' THEN category_group = 'growth' OR risk IN ('medium', 'high') WHEN 'conservative' THEN category_group = 'conservative' OR risk = 'low'
    ELSE category_group IN ('passive', 'balanced') OR risk IN ('medium', 'high') END)
  AND len(list_filter(words, lambda w: contains(lower(scheme_name), w) OR contains(lower(category), w) OR contains(lower(amc), w))) > 0)"""


@query(f"""WITH {PROFILES} SELECT investor_id, a.persona, CAST(rank AS INTEGER) AS rank, scheme_code, scheme_name, category, risk, aum, round(match_score, 4) AS match_score,
 CAST(greatest(8, least(40, 24 - (rank - 1) * 4)) AS INTEGER) AS recommended_allocation_pct FROM asked a JOIN fit f ON a.persona = f.persona AND a.words = f.words WHERE rank <= 5""", "users catalog")
def fund_recommendations(t):
    k = F.col("id")
    prof = V.users(t).select(k.alias("investor_id"), F.when(k % 3 == 0, "Aggressive (Equity)").when(k % 3 == 1, "Conservative (Debt)").otherwise("Passive index").alias("risk_profile"),
                             F.when(k % 4 == 0, "small ring").when(k % 4 == 1, "brand#1 liquid").when(k % 4 == 2, "").otherwise("mid cap widget").alias("goals"))
    return R.recommend_funds(prof, V.catalog(t))


@query("""SELECT scheme_code, mood, who, CAST(least(99, 65 + CASE WHEN category_group = who THEN 25 ELSE 0 END + CASE WHEN (mood = 'bullish' AND category = 'Small Cap Fund') OR (mood = 'bearish' AND category = 'Liquid Fund') THEN 7 ELSE 0 END
 + CASE WHEN (risk = 'high' AND who = 'growth') OR (risk = 'low' AND who = 'conservative') THEN 5 ELSE 0 END) AS INTEGER) AS match_score FROM
(SELECT *, CASE scheme_code % 3 WHEN 0 THEN 'bullish' WHEN 1 THEN 'bearish' ELSE 'neutral' END AS mood, CASE scheme_code % 2 WHEN 0 THEN 'growth' ELSE 'conservative' END AS who FROM catalog)""", "catalog")
def fund_match_scores(t):
    k = F.col("scheme_code")
    c = V.catalog(t).withColumn("mood", F.when(k % 3 == 0, "bullish").when(k % 3 == 1, "bearish").otherwise("neutral")).withColumn("who", F.when(k % 2 == 0, "growth").otherwise("conservative"))
    c = c.withColumn("category", F.when(F.col("category") == "Small Cap Fund", "equity").when(F.col("category") == "Liquid Fund", "debt").otherwise("other"))
    return D.fund_match_score(c, "who", "mood").select("scheme_code", "mood", "who", "match_score")


@query("""SELECT scheme_code, rank, CAST(greatest(8, least(40, 24 - (rank - 1) * 4)) AS INTEGER) AS allocation_pct FROM (SELECT scheme_code, CAST(row_number() OVER (PARTITION BY category_group ORDER BY match_score DESC, aum DESC, scheme_code) AS INTEGER) AS rank FROM catalog)""", "catalog")
def rank_allocation(t):
    from ..operators.timeseries import high_first, rank_allocation as ra
    return ra(V.catalog(t), ["category_group"], [high_first("match_score"), high_first("aum"), F.col("scheme_code")]).select("scheme_code", "rank", "allocation_pct")


@query("""SELECT p_brand, p_partkey, p_retailprice FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS rn FROM part) WHERE rn <= 3""")
def topk_per_brand(t):
    return K.topk(t.part, ["p_brand"], [F.desc("p_retailprice"), F.col("p_partkey")], 3).select("p_brand", "p_partkey", "p_retailprice")


@query("""(SELECT c_custkey, c_acctbal, 'gainer' AS side FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 3) UNION ALL (SELECT c_custkey, c_acctbal, 'loser' FROM customer ORDER BY c_acctbal, c_custkey LIMIT 3)""")
def gainers_losers(t):
    return K.gainers_losers(t.customer.select("c_custkey", "c_acctbal"), "c_acctbal", "c_custkey")


@query("""SELECT event_id, user_id, event_type FROM events ORDER BY ts DESC, event_id DESC LIMIT 1""")
def latest_event(t):
    return K.latest(t.events, "ts", "event_id").select("event_id", "user_id", "event_type")
