"""Lead and investor derivations, filters and overviews."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions.scalars import clean_currency, first_number, launch_year, parse_amount, parse_investment_amount, safe_name, to_float0, to_number
from ..operators import aggregates as A, derive as D, filters as X, quality as Q, topk as K
from . import etl, views as V
from .registry import query

TIER = "CASE WHEN conversion_probability > 0.85 THEN 'hot' WHEN conversion_probability > 0.65 THEN 'warm' ELSE 'cold' END"


@query(f"""
SELECT {TIER} AS tier, count(*) AS leads, round(avg(conversion_probability), 4) AS mean_probability
FROM leads WHERE lead_id IS NOT NULL AND total_visits >= 0 AND conversion_probability >= 0 GROUP BY 1""", "leads")
def lead_tier_overview(t):
    lead = V.leads(t).withColumnRenamed("conversion_probability", "Conversion_Probability")
    return A.tier_table(X.quality_filter(lead), "Conversion_Probability").orderBy("tier")


@query("""
SELECT lead_id, round(es, 4) AS engagement_score, CASE WHEN es > 50 THEN 'High' WHEN es > 20 THEN 'Medium' ELSE 'Low' END AS engagement_tier,
       round(eb, 4) AS engagement_score_bi, CASE WHEN eb <= 10 THEN 'Low' WHEN eb <= 30 THEN 'Medium' WHEN eb > 30 THEN 'High' END AS engagement_tier_bi,
       (coalesce(activity, 0) + coalesce(profile, 0)) / 2 AS profile_strength,
       round(CASE WHEN time_spent > 0 THEN page_views / time_spent ELSE 0 END, 6) AS engagement_velocity,
       round(total_visits * page_views, 4) AS activity_score,
       CASE WHEN total_visits <= 0 THEN 'New' WHEN total_visits <= 5 THEN 'Active' WHEN total_visits <= 15 THEN 'Engaged' ELSE 'Hot' END AS lead_age_bin,
       CASE WHEN coalesce(time_spent, 0) > 1500 THEN 'Aggressive Growth Chaser' WHEN coalesce(time_spent, 0) > 800 THEN 'Brand Loyalist'
            ELSE 'Conservative Wealth Preserver' END AS pitch_persona,
       CASE WHEN time_spent > 1000 THEN 'Equity Scheme' ELSE 'Debt Scheme' END AS asset_class
FROM (SELECT *, total_visits * 0.3::DOUBLE + time_spent * 0.0005::DOUBLE + page_views * 10 AS es, total_visits * 0.3::DOUBLE + time_spent * 0.0005::DOUBLE AS eb FROM leads)""", "leads")
def lead_features(t):
    f = D.lead_features(V.leads(t))
    r = {"engagement_score": 4, "engagement_score_bi": 4, "engagement_velocity": 6, "activity_score": 4}
    return f.select("lead_id", *[(F.round(c, r[c]).alias(c) if c in r else F.col(c)) for c in (
        "engagement_score", "engagement_tier", "engagement_score_bi", "engagement_tier_bi", "profile_strength", "engagement_velocity",
        "activity_score", "lead_age_bin", "pitch_persona", "asset_class")])


@query("""
SELECT lead_id, CASE WHEN conversion_probability > 0.85 THEN 'hot' WHEN conversion_probability > 0.65 THEN 'warm' ELSE 'cold' END AS strict,
       CASE WHEN conversion_probability >= 0.85 THEN 'hot' WHEN conversion_probability >= 0.65 THEN 'warm' ELSE 'cold' END AS inclusive,
       CASE WHEN conversion_probability >= 0.8 THEN 'Tier 1: Hot' WHEN conversion_probability >= 0.5 THEN 'Tier 2: Nurture' ELSE 'Tier 3: Cold' END AS tier123
FROM leads""", "leads")
def lead_tiers(t):
    p = "conversion_probability"
    return V.leads(t).select("lead_id", R.lead_tier(p).alias("strict"), R.lead_tier(p, "inclusive").alias("inclusive"), R.lead_tier(p, "tier123").alias("tier123"))


INVEST = """CASE WHEN potential_investment = '' OR potential_investment IS NULL THEN 500000.0::DOUBLE
     WHEN potential_investment LIKE '%Cr%' THEN n * 1e7::DOUBLE WHEN potential_investment LIKE '%L' THEN n * 1e5::DOUBLE
     WHEN potential_investment LIKE '%k' THEN n * 1e3::DOUBLE WHEN n < 1000 THEN n * 1e5::DOUBLE ELSE n END"""


@query(f"""SELECT lead_id, {INVEST} AS amount FROM
(SELECT *, TRY_CAST(regexp_extract(potential_investment, '[0-9]+[.]?[0-9]*', 0) AS DOUBLE) AS n FROM leads)""", "leads")
def investment_amounts(t):
    return V.leads(t).select("lead_id", parse_investment_amount("potential_investment").alias("amount"))


@query("""SELECT scheme_code, CAST(CASE WHEN average_aum_cr = '-' THEN '0' ELSE average_aum_cr END AS DOUBLE) AS aum,
CAST((scheme_code % 50) * 1000 AS DOUBLE) AS min_amount, CASE WHEN scheme_code % 9 = 0 THEN NULL ELSE CAST(1990 + scheme_code % 30 AS INTEGER) END AS launch_year,
CASE WHEN average_aum_cr = '-' THEN NULL ELSE CAST(average_aum_cr AS DOUBLE) END AS aum_or_null,
CAST(scheme_code % 50 AS DOUBLE) AS first_number, replace(replace(scheme_min_amt, '.', ''), ',', '') AS tidy FROM schemes""", "schemes")
def amount_parsing(t):
    s = V.schemes(t)
    # the leading dot of "Rs." is not part of the amount here
    plain = F.regexp_replace("scheme_min_amt", "Rs[.]", "Rs")
    return s.select("scheme_code", to_float0("average_aum_cr").alias("aum"), parse_amount(plain).alias("min_amount"), launch_year("launch_date").alias("launch_year"),
                    to_number("average_aum_cr").alias("aum_or_null"), first_number("scheme_min_amt").alias("first_number"),
                    F.replace(safe_name("scheme_min_amt"), F.lit("_"), F.lit(" ")).alias("tidy"))


@query("""SELECT id, CAST(replace(replace(yearly_income, '$', ''), ',', '') AS DOUBLE) AS income, CAST(replace(total_debt, '$', '') AS DOUBLE) AS debt FROM users""", "users")
def currency_cleaning(t):
    return V.users(t).select("id", clean_currency("yearly_income").alias("income"), clean_currency("total_debt").alias("debt"))


@query("""
SELECT id, current_age, inc AS yearly_income, debt AS total_debt, round(dti, 6) AS debt_to_income_ratio, credit_score,
       round(coalesce(s, 0), 2) AS behavior_spend_sum, coalesce(n, 0) AS behavior_spend_count,
       CASE WHEN credit_score > 720 AND dti < 1.5 THEN 'Aggressive (Equity)' WHEN credit_score > 650 AND dti < 2.5 THEN 'Moderate (Hybrid)' ELSE 'Conservative (Debt)' END AS inferred_risk_profile
FROM (SELECT *, debt / CASE WHEN inc = 0 THEN 1 ELSE inc END AS dti FROM (
  SELECT *, CAST(replace(replace(yearly_income, '$', ''), ',', '') AS DOUBLE) AS inc, CAST(replace(total_debt, '$', '') AS DOUBLE) AS debt FROM users))
LEFT JOIN (SELECT client_id, sum(CAST(replace(amount, '$', '') AS DOUBLE)) AS s, count(*) AS n FROM txns GROUP BY 1) ON client_id = id""", "users txns")
def investor_features(t):
    f = etl.investor_features(V.users(t), V.txns(t))
    return f.withColumn("behavior_spend_sum", F.round("behavior_spend_sum", 2)).withColumn("debt_to_income_ratio", F.round("debt_to_income_ratio", 6))


@query("""SELECT client_id, round(sum(CAST(replace(amount, '$', '') AS DOUBLE)), 2) AS behavior_spend_sum, count(*) AS behavior_spend_count FROM txns GROUP BY 1""", "txns")
def client_spend(t):
    return A.client_spend(V.txns(t)).withColumn("behavior_spend_sum", F.round("behavior_spend_sum", 2))


@query("""
SELECT investor_id, p AS persona, CASE p WHEN 'Cluster 0: Aggressive Growth' THEN 'High Risk' WHEN 'Cluster 2: Brand Loyalists' THEN 'Medium Risk' ELSE 'Low Risk' END AS risk_tolerance
FROM (SELECT investor_id, CASE WHEN Growth > 5 THEN 'Cluster 0: Aggressive Growth' WHEN Liquidity > 5 THEN 'Cluster 1: Liquid Needers'
      WHEN Trustworthiness > 6 THEN 'Cluster 2: Brand Loyalists' ELSE 'Cluster 3: Conservative Preservers' END AS p FROM traits)""", "traits")
def rule_personas(t):
    return D.rule_persona(V.traits(t)).select("investor_id", "persona", "risk_tolerance")


@query("""
SELECT investor_id, CASE WHEN Growth > 5 AND Diversification > 3 THEN 'Cluster 0: Aggressive Growth' WHEN Liquidity > 5 THEN 'Cluster 1: Liquid Needers'
      WHEN Trustworthiness > 6 THEN 'Cluster 2: Brand Loyalists' ELSE 'Cluster 3: Conservative Preservers' END AS persona FROM traits""", "traits")
def rule_personas_with_risk(t):
    tr = V.traits(t).withColumn("Risk", (F.col("Diversification") > 3).cast("int"))
    return D.rule_persona(tr).select("investor_id", "persona")


@query("""
SELECT investor_id, CAST(c AS INTEGER) AS cluster, CASE c WHEN 0 THEN 'Equity & High Growth Funds' WHEN 1 THEN 'Liquid & Debt Preservation' WHEN 2 THEN 'Hybrid & Asset Allocation' ELSE 'Index & Passive Smart-Beta' END AS fund_type,
       CASE c WHEN 0 THEN 'NJ IndiaInvest Pvt Ltd (National Distributor)' WHEN 1 THEN 'State Bank of India (Wealth)' WHEN 2 THEN 'Prudent Corporate Advisory Services Ltd' ELSE 'Zerodha Fund House / Coin' END AS distributor
FROM (SELECT investor_id, investor_id % 6 AS c FROM traits)""", "traits")
def cluster_routes(t):
    return D.route_clusters(V.traits(t).select("investor_id", (F.col("investor_id") % 6).cast("int").alias("cluster")))


@query("""
SELECT investor_id, CASE WHEN g >= greatest(c, b, p) THEN 'growth' WHEN c >= greatest(b, p) THEN 'conservative' WHEN b >= p THEN 'balanced' ELSE 'passive' END AS persona
FROM (SELECT investor_id, count(*) FILTER (answer = 'growth') AS g, count(*) FILTER (answer = 'conservative') AS c,
      count(*) FILTER (answer = 'balanced') AS b, count(*) FILTER (answer = 'passive') AS p FROM answers GROUP BY 1)""", "answers")
def survey_personas(t):
    return D.survey_persona(V.answers(t))


@query("""SELECT investor_id, CASE WHEN a >= 4 THEN 'growth' WHEN a >= 3 THEN 'balanced' WHEN a >= 2 THEN 'passive' ELSE 'conservative' END AS persona
FROM (SELECT investor_id, avg(coalesce(value, 3)) AS a FROM answers GROUP BY 1)""", "answers")
def survey_personas_numeric(t):
    return D.survey_persona_numeric(V.answers(t))


@query("""
SELECT lead_id AS client_id, name, p AS probability, round_even(1.0::DOUBLE - p, 2) AS sip_drop_probability, p < 0.45 AS inactive_flag,
       round_even(0.1::DOUBLE + 0.5::DOUBLE * (1.0::DOUBLE - p), 2) AS redemption_likelihood,
       CASE WHEN p < 0.5 THEN 'Decreasing due to Volatility' WHEN p < 0.85 THEN 'Stable' ELSE 'Increasing' END AS risk_appetite_change,
       round_even(50 + p * 45, 1) AS portfolio_health_score, round_even(1.0::DOUBLE - p, 2) > 0.60 AS retention_alert,
       CASE WHEN p > 0.8 THEN 'Equity SIP Top-up' WHEN p > 0.6 THEN 'Tax Saving ELSS Plan' ELSE 'Liquid Safe Harbor Parking' END AS upsell_opportunity
FROM (SELECT lead_id, name, conversion_probability AS p FROM leads) ORDER BY p DESC, lead_id LIMIT 12""", "leads")
def client_insights(t):
    return D.client_insights(V.leads(t))


@query("""
SELECT lead_id, fv AS future_value, m * y * 12 AS invested, round(fv - m * y * 12, 2) AS gains FROM (SELECT lead_id, m, y, round(CASE WHEN r = 0 THEN m * y * 12 ELSE
  m * ((pow(1 + r / 1200, y * 12) - 1) / (r / 1200)) * (1 + r / 1200) END, 2) AS fv
FROM (SELECT lead_id, CAST(1000 + c_custkey % 50 * 100 AS DOUBLE) AS m, CAST(c_custkey % 21 AS DOUBLE) AS r, CAST(c_custkey % 15 + 1 AS DOUBLE) AS y FROM leads))""", "leads")
def sip_projection(t):
    k = F.col("c_custkey")
    base = V.leads(t).select("lead_id", (1000 + k % 50 * 100).cast("double").alias("monthly"), (k % 21).cast("double").alias("rate"), (k % 15 + 1).cast("double").alias("years"))
    out = D.sip_projection(base).withColumn("future_value", F.round("future_value", 2))
    return out.select("lead_id", "future_value", "invested", F.round(F.col("future_value") - F.col("invested"), 2).alias("gains"))


# ---- filters -------------------------------------------------------------------------------

@query("""SELECT lead_id, "City", total_visits FROM lead_events WHERE lead_id IS NOT NULL AND total_visits >= 0 AND "Conversion_Probability" >= 0""", "lead_events")
def quality_filter(t):
    return X.quality_filter(V.lead_events(t)).select("lead_id", "City", "total_visits")


@query("""SELECT "City", count(*) AS rejected FROM lead_events WHERE NOT coalesce(lead_id IS NOT NULL AND total_visits >= 0 AND "Conversion_Probability" >= 0, false) GROUP BY 1""", "lead_events")
def quality_rejected(t):
    return X.quality_split(V.lead_events(t))[1].groupBy("City").agg(F.count("*").alias("rejected"))


@query("""SELECT o_orderkey, o_totalprice AS amount FROM orders WHERE o_totalprice - 200000 > 0""")
def positive_amounts(t):
    amt = (F.col("o_totalprice") - 200000).cast("string").alias("amount")
    kept = X.positive_amount(t.orders.select("o_orderkey", "o_totalprice", amt))
    return kept.select("o_orderkey", F.col("o_totalprice").alias("amount"))


@query("""SELECT investor_id FROM traits WHERE Technology IS NOT NULL AND Affordability IS NOT NULL""", "traits")
def complete_cases(t):
    return X.complete_cases(V.traits(t), ["Technology", "Affordability", "absent"]).select("investor_id")


@query("""SELECT c_custkey FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')""")
def multi_value_filter(t):
    return X.filter_in(t.customer, {"c_mktsegment": ["BUILDING", "MACHINERY"], "c_nationkey": []}).select("c_custkey")


@query(f"""SELECT lead_id, city, conversion_probability FROM leads
WHERE (lower(name) LIKE '%nation_1%' OR lower(city) LIKE '%nation_1%' OR lower(occupation) LIKE '%nation_1%' OR lower(lead_id) LIKE '%nation_1%' OR lower(industry) LIKE '%nation_1%' OR lower(lead_source) LIKE '%nation_1%')
  AND lower(coalesce(status, 'New')) = 'new' AND {TIER} = 'warm' ORDER BY conversion_probability DESC, lead_id LIMIT 20""", "leads")
def lead_search(t):
    return X.search_leads(V.leads(t), "Nation_1", "NEW", "warm").select("lead_id", "city", "conversion_probability")


@query("""SELECT p_partkey, p_name FROM part WHERE lower(p_name) LIKE '%widget%'""")
def name_contains(t):
    return X.name_like(t.part, "p_name", "Widget").select("p_partkey", "p_name")


@query(f"""SELECT l_returnflag, count(*) AS sampled FROM lineitem
WHERE substr(md5(l_orderkey || '|' || l_linenumber || '|' || l_partkey || '|42'), 1, 13) < '{int(0.2 * 16**13):013x}' GROUP BY 1""")
def hashed_sample(t):
    """Repeatable 20 % sample of the order lines, counted per return flag."""
    s = X.sample(t.lineitem, 0.2, key=["l_orderkey", "l_linenumber", "l_partkey"])
    return s.groupBy("l_returnflag").agg(F.count("*").alias("sampled"))


@query("""SELECT o_orderkey, o_totalprice FROM orders ORDER BY md5(o_orderkey || '|42'), o_orderkey LIMIT 100""")
def exact_sample(t):
    return X.sample_n(t.orders, 100, ["o_orderkey"]).select("o_orderkey", "o_totalprice")


@query("""SELECT lead_id, conversion_probability FROM leads ORDER BY conversion_probability DESC, lead_id LIMIT 50""", "leads")
def top_leads(t):
    return K.top_leads(V.leads(t), 50).select("lead_id", "conversion_probability")


@query("""SELECT lead_id, conversion_probability FROM leads WHERE conversion_probability >= 0.65""", "leads")
def leads_master(t):
    return K.leads_master(V.leads(t)).select("lead_id", "conversion_probability")


# ---- overviews -----------------------------------------------------------------------------

@query(f"""
SELECT count(*) AS total_leads, count(*) FILTER (conversion_probability > 0.85) AS hot_prospects, round(avg(conversion_probability), 4) AS mean_conversion_probability,
       CAST(CAST(round_even(avg(conversion_probability) * 100, 0) AS INTEGER) AS VARCHAR) || '%' AS conversion_rate, round(sum({INVEST}), 2) AS pipeline_value
FROM (SELECT *, TRY_CAST(regexp_extract(potential_investment, '[0-9]+[.]?[0-9]*', 0) AS DOUBLE) AS n FROM leads)""", "leads")
def lead_overview(t):
    return A.lead_overview(V.leads(t))


@query("""SELECT lead_id, name, CASE WHEN coalesce(status, 'New') <> 'New' THEN 'Lead state set to ' || status
  ELSE 'AI scored conversion at ' || CAST(round_even(conversion_probability * 100, 0) AS INTEGER) || '%' END AS activity
FROM leads ORDER BY conversion_probability DESC, lead_id LIMIT 5""", "leads")
def recent_activity(t):
    return A.recent_activity(V.leads(t))


@query(f"""SELECT count(*) AS total, CAST(19 AS INTEGER) AS n_columns, round(avg(conversion_probability), 4) AS mean_probability,
 count(*) FILTER ({TIER} = 'hot') AS hot, count(*) FILTER ({TIER} = 'warm') AS warm, count(*) FILTER ({TIER} = 'cold') AS cold FROM leads""", "leads")
def tier_summary(t):
    return A.tier_summary(V.leads(t))


@query("""SELECT metric, CASE WHEN metric = 'mean_conversion_probability' THEN CAST(CAST(value AS DOUBLE) AS VARCHAR) ELSE value END AS value
FROM (SELECT CAST(count(*) AS VARCHAR) AS total_leads, CAST(round(avg(conversion_probability), 4) AS VARCHAR) AS mean_conversion_probability,
 CAST(CAST(sum(converted) AS BIGINT) AS VARCHAR) AS converted_leads, (SELECT CAST(count(*) AS VARCHAR) FROM traits) AS total_investors, (SELECT CAST(count(*) AS VARCHAR) FROM documents) AS total_texts FROM leads)
UNPIVOT (value FOR metric IN (total_leads, mean_conversion_probability, converted_leads, total_investors, total_texts))""", "leads traits")
def kpi_table(t):
    from ..sources.sinks import kpis_long
    return kpis_long(etl.kpis(V.leads(t), V.traits(t), t.documents))


@query("""SELECT lead_id, lead_source, time_spent, converted, CASE WHEN conversion_probability >= 0.8 THEN 'Tier 1: Hot' WHEN conversion_probability >= 0.5 THEN 'Tier 2: Nurture' ELSE 'Tier 3: Cold' END AS lead_tier,
 CASE WHEN time_spent > 1000 THEN 'Equity Scheme' ELSE 'Debt Scheme' END AS recommended_asset_class FROM leads""", "leads")
def distributor_view(t):
    return etl.distributor_view(V.leads(t)).select("lead_id", "lead_source", "time_spent", "converted", "lead_tier", "recommended_asset_class")


@query("""
SELECT lead_id, round(e, 4) AS engagement_score, CASE WHEN e <= 10 THEN 'Low' WHEN e <= 30 THEN 'Medium' WHEN e > 30 THEN 'High' END AS engagement_tier
FROM (SELECT lead_id, total_visits * 0.3::DOUBLE + time_spent * 0.0005::DOUBLE AS e FROM leads)""", "leads")
def leads_for_bi(t):
    b = etl.leads_for_bi(V.leads(t))
    return b.select("lead_id", F.round("engagement_score", 4).alias("engagement_score"), "engagement_tier")


@query("""SELECT * FROM (SELECT coalesce(a, b) AS id, coalesce(v, w) AS amount FROM (
 SELECT CASE WHEN l_orderkey % 3 = 0 THEN NULL ELSE l_orderkey END AS a, l_orderkey AS b, CASE WHEN l_linenumber % 2 = 0 THEN NULL ELSE l_quantity END AS v, l_extendedprice AS w FROM lineitem))""")
def alias_columns(t):
    src = t.lineitem.select(F.when(F.col("l_orderkey") % 3 != 0, F.col("l_orderkey")).alias("lead_id"), F.col("l_orderkey").alias("Lead Number"),
                            F.when(F.col("l_linenumber") % 2 != 0, F.col("l_quantity")).alias("amt"), F.col("l_extendedprice").alias("Amount (INR)"))
    return Q.coalesce_aliases(src, {"id": ["lead_id", "Lead Number"], "amount": ["amt", "Amount (INR)"]})


@query("""SELECT o_orderkey AS order_key, o_totalprice AS price_pct_inr, o_orderpriority AS a_b_c FROM orders""")
def normalized_names(t):
    src = t.orders.select(F.col("o_orderkey").alias(" Order Key "), F.col("o_totalprice").alias("Price % (INR)"), F.col("o_orderpriority").alias("A-B/C."))
    return Q.normalize_columns(src, "strict")
