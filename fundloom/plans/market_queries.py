"""Market state, portfolio risk, impact of signals, fund risk and suitability."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import rules as R, words as W
from ..functions.scalars import top_entries
from ..operators import derive as D, impact as I, risk as K
from . import views as V
from .registry import query


@query("""SELECT snap, CASE WHEN c > 1.5 THEN 'Very Bullish' WHEN c > 0.5 THEN 'Bullish' WHEN c < -1.5 THEN 'Highly Bearish' WHEN c < -0.5 THEN 'Bearish' ELSE 'Neutral' END AS sentiment_label,
 ss AS sentiment_score, vs AS volatility_score, greatest(0, least(100, round_even(vs * 0.6::DOUBLE + abs(ss) * 0.4::DOUBLE, 1))) AS risk_intensity_score FROM (
SELECT snap, change_pct AS c, greatest(-100, least(100, round_even(CASE WHEN change_pct > 1.5 THEN 85 + (least(change_pct, 5) - 1.5::DOUBLE) * 4.2::DOUBLE WHEN change_pct > 0.5 THEN 40 + (change_pct - 0.5::DOUBLE) * 45
 WHEN change_pct < -1.5 THEN -(85 + (least(-change_pct, 5) - 1.5::DOUBLE) * 4.2::DOUBLE) WHEN change_pct < -0.5 THEN -(40 + (-change_pct - 0.5::DOUBLE) * 45) ELSE change_pct * 80 END, 1))) AS ss,
 greatest(0, least(100, round_even(vix * 2.5::DOUBLE, 1))) AS vs FROM market)""", "market")
def market_scores(t):
    return D.market_scores(V.market(t)).select("snap", "sentiment_label", "sentiment_score", "volatility_score", "risk_intensity_score")


@query("""SELECT snap, abs(change_pct) > 1.5 OR vix > 25 AS is_volatile, CASE WHEN change_pct > 1 THEN 'bullish' WHEN change_pct < -1 THEN 'bearish' ELSE 'neutral' END AS sentiment,
 isodow(l) < 6 AND hour(l) * 60 + minute(l) BETWEEN 555 AND 930 AS is_open FROM (SELECT *, ts + INTERVAL '5 hours 30 minutes' AS l FROM market)""", "market")
def market_flags(t):
    return D.market_flags(V.market(t).drop("sentiment")).select("snap", "is_volatile", "sentiment", "is_open")


@query("""SELECT snap, s AS signal, CASE WHEN o AND s = 'Bullish' THEN 'green' WHEN o THEN 'yellow' ELSE 'red' END AS call_light FROM (
SELECT snap, CASE WHEN change_pct / 4 > 0.3 THEN 'Bullish' WHEN change_pct / 4 < -0.3 THEN 'Bearish' ELSE 'Neutral' END AS s, isodow(l) < 6 AND hour(l) * 60 + minute(l) BETWEEN 555 AND 930 AS o FROM (SELECT *, ts + INTERVAL '5 hours 30 minutes' AS l FROM market))""", "market")
def call_lights(t):
    m = D.market_flags(V.market(t).drop("sentiment")).withColumn("score", F.col("change_pct") / 4)
    return D.sentiment_signal(m).select("snap", "signal", "call_light")


CATS = ["Small Cap", "sectoral", "ELSS", "flexi-cap", "Index", "hybrid", "debt", "gilt", "gold"]
RISKS = ["Conservative", "balanced", "Moderate", "growth"]


@query(f"""SELECT snap, r AS fund_risk_rating, l AS fund_risk_label, NOT clash AS recommended, clash OR (sentiment = 'bearish' AND l IN ('high', 'medium-high')) AS mismatch_flag,
 CASE WHEN risk = 'conservative' THEN CASE WHEN l = 'low' THEN 15.0::DOUBLE ELSE 5.0::DOUBLE END WHEN risk IN ('balanced', 'moderate') THEN 25.0::DOUBLE ELSE 40.0::DOUBLE END AS suggested_allocation,
 CASE WHEN sentiment IN ('neutral', 'bearish') THEN 'Staggered Systematic Entry Recommended' ELSE 'Lump-sum / Accelerated SIP Permitted' END AS outlook,
 CASE WHEN clash AND risk = 'conservative' THEN 'too_volatile_for_conservative' WHEN clash THEN 'high_risk_for_balanced' WHEN sentiment = 'bearish' AND l IN ('high', 'medium-high') THEN 'bearish_market' END AS reason,
 CASE {" ".join(f"WHEN risk IN ({', '.join(repr(x) for x in levels)}) THEN '{'|'.join(names)}'" for levels, names in W.SUITABLE_FUNDS[:-1])} ELSE '{"|".join(W.SUITABLE_FUNDS[-1][1])}' END AS alternatives FROM (
SELECT *, (risk = 'conservative' AND l IN ('high', 'medium-high', 'medium')) OR (risk IN ('balanced', 'moderate') AND l = 'high') AS clash FROM (
SELECT *, CASE WHEN cat IN ('small cap', 'sectoral') THEN 90.0::DOUBLE WHEN cat IN ('elss', 'flexi-cap') THEN 65.0::DOUBLE WHEN cat IN ('index', 'hybrid') THEN 45.0::DOUBLE WHEN cat IN ('debt', 'gilt') THEN 15.0::DOUBLE ELSE 50.0::DOUBLE END AS r,
 CASE WHEN cat IN ('small cap', 'sectoral') THEN 'high' WHEN cat IN ('elss', 'flexi-cap') THEN 'medium-high' WHEN cat IN ('index', 'hybrid') THEN 'medium' WHEN cat IN ('debt', 'gilt') THEN 'low' ELSE 'medium' END AS l FROM (
SELECT snap, sentiment, lower(list_extract({CATS}, CAST(snap % 9 + 1 AS BIGINT))) AS cat, lower(list_extract({RISKS}, CAST(snap // 9 % 4 + 1 AS BIGINT))) AS risk FROM market)))""", "market")
def suitability(t):
    at = lambda values, i: F.element_at(F.array(*[F.lit(v) for v in values]), i.cast("int"))
    s = F.col("snap")
    m = V.market(t).withColumn("category", at(CATS, s % 9 + 1)).withColumn("risk_level", at(RISKS, F.floor(s / 9) % 4 + 1))
    return D.suitability(m).select("snap", "fund_risk_rating", "fund_risk_label", "recommended", "mismatch_flag", "suggested_allocation", "outlook", "reason",
                                   F.array_join("alternatives", "|").alias("alternatives"))


FUND_RISK = "CASE category WHEN 'equity' THEN 70 WHEN 'mid_cap' THEN 80 WHEN 'small_cap' THEN 90 WHEN 'debt' THEN 30 WHEN 'hybrid' THEN 50 WHEN 'index' THEN 65 ELSE 50 END"


@query(f"""SELECT fund_id, portfolio, round_even(x, 1) AS fund_risk_score, CASE WHEN x < 75 THEN 'Suitable' ELSE 'High Risk - Review' END AS recommendation FROM (
SELECT fund_id, h.portfolio, least(100, {FUND_RISK} * CASE WHEN market_status = 'VOLATILE' THEN 1.3::DOUBLE WHEN vix > 20 THEN 1.2::DOUBLE WHEN m.sentiment = 'bearish' THEN 1.1::DOUBLE ELSE 1.0::DOUBLE END) AS x FROM holdings h JOIN pmarket m ON m.portfolio = h.portfolio)""", "holdings pmarket")
def fund_risk_ratings(t):
    h = V.holdings(t).join(V.portfolio_market(t), "portfolio")
    return D.fund_risk_rating(h, status="market_status").select("fund_id", "portfolio", "fund_risk_score", "recommendation")


RISK = """ps AS (SELECT portfolio, max(persona) AS persona, count(*) AS n, sum(value) AS total,
 sum(value * CASE WHEN category IS NULL THEN 1.1::DOUBLE ELSE CASE category WHEN 'equity' THEN 1.1::DOUBLE WHEN 'mid_cap' THEN 1.3::DOUBLE WHEN 'small_cap' THEN 1.5::DOUBLE WHEN 'debt' THEN 0.1::DOUBLE WHEN 'hybrid' THEN 0.6::DOUBLE ELSE 1.0::DOUBLE END END) AS bv,
 sum(CASE WHEN category IN ('equity', 'mid_cap', 'small_cap') THEN value ELSE 0 END) AS ev, sum(returns * value) AS rv FROM holdings GROUP BY 1),
big AS (SELECT portfolio, max(v) AS big FROM (SELECT portfolio, coalesce(sector, 'Unknown') AS s, sum(value) AS v FROM holdings GROUP BY 1, 2) GROUP BY 1),
rk AS (SELECT ps.*, big, m.vix, m.change_pct, m.market_status, m.sentiment, m.volume_spike, round_even(bv / total * (vix / 20), 2) AS beta, round_even(total * 1.645::DOUBLE * (vix / 100), 2) AS var_95,
 round_even(CASE WHEN market_status = 'VOLATILE' THEN 0.15::DOUBLE WHEN vix > 20 THEN 0.12::DOUBLE WHEN vix > 15 THEN 0.08::DOUBLE ELSE 0.05::DOUBLE END * (0.5::DOUBLE + ev / total) * 100, 2) AS max_drawdown, round_even((rv / total - 6) / vix, 2) AS sharpe_ratio
 FROM ps JOIN big USING (portfolio) LEFT JOIN pmarket m ON m.portfolio = ps.portfolio),
rs AS (SELECT *, least(100, round_even(round((beta * 20 + least(var_95 / 10000, 30) + max_drawdown * 1.5::DOUBLE) * CASE WHEN market_status = 'VOLATILE' THEN 1.3::DOUBLE WHEN sentiment = 'bearish' THEN 1.15::DOUBLE ELSE 1.0::DOUBLE END
 * CASE persona WHEN 'conservative' THEN 1.5::DOUBLE WHEN 'balanced' THEN 1.0::DOUBLE WHEN 'growth' THEN 0.8::DOUBLE ELSE 0.9::DOUBLE END, 9), 1)) AS score FROM rk),
rl AS (SELECT *, CASE WHEN score < CASE persona WHEN 'conservative' THEN 30 WHEN 'balanced' THEN 40 WHEN 'growth' THEN 50 ELSE 35 END THEN 'low' WHEN score < CASE persona WHEN 'conservative' THEN 50 WHEN 'balanced' THEN 60 WHEN 'growth' THEN 70 ELSE 55 END THEN 'medium'
 WHEN score < CASE persona WHEN 'conservative' THEN 70 WHEN 'balanced' THEN 80 WHEN 'growth' THEN 85 ELSE 75 END THEN 'high' ELSE 'critical' END AS level FROM rs)"""
RISK_VIEWS = "holdings pmarket"


@query(f"WITH {RISK} SELECT portfolio, beta FROM rk", RISK_VIEWS)
def portfolio_beta(t):
    return K.portfolio_beta(V.holdings(t), V.portfolio_market(t), "portfolio")


@query(f"WITH {RISK} SELECT portfolio, var_95 FROM rk", RISK_VIEWS)
def value_at_risk(t):
    return K.value_at_risk(V.holdings(t), V.portfolio_market(t), "portfolio")


@query(f"WITH {RISK} SELECT portfolio, max_drawdown FROM rk", RISK_VIEWS)
def max_drawdown(t):
    return K.max_drawdown_est(V.holdings(t), V.portfolio_market(t), "portfolio")


@query(f"WITH {RISK} SELECT portfolio, sharpe_ratio FROM rk", RISK_VIEWS)
def sharpe_ratio(t):
    return K.sharpe(V.holdings(t), V.portfolio_market(t), on="portfolio")


@query(f"WITH {RISK} SELECT portfolio, beta, var_95, max_drawdown, sharpe_ratio, score AS portfolio_risk_score, level AS risk_level FROM rl", RISK_VIEWS)
def risk_scores(t):
    r = K.risk_score(V.holdings(t), V.portfolio_market(t), "portfolio")
    return r.select("portfolio", "beta", "var_95", "max_drawdown", "sharpe_ratio", "portfolio_risk_score", "risk_level")


@query(f"""WITH {RISK}, al AS (SELECT portfolio, concat_ws(',', CASE WHEN market_status = 'VOLATILE' THEN 'high_market_volatility' END, CASE WHEN volume_spike THEN 'volume_spike' END, CASE WHEN vix > 20 THEN 'elevated_vix' END,
 CASE WHEN change_pct > 2 THEN 'market_up_over_2pct' WHEN change_pct < -2 THEN 'market_down_over_2pct' END, CASE WHEN persona = 'conservative' AND ev / total * 100 > 40 THEN 'equity_high_for_conservative' END,
 CASE WHEN persona = 'growth' AND ev / total * 100 < 50 THEN 'equity_low_for_growth' END, CASE WHEN big / total > 0.5 THEN 'sector_over_half' END) AS alerts,
 concat_ws(',', CASE WHEN persona = 'conservative' AND level IN ('high', 'critical') THEN 'raise_liquid_and_debt,pause_equity_sips' END, CASE WHEN persona = 'conservative' THEN 'keep_emergency_corpus' END,
 CASE WHEN persona = 'growth' AND sentiment = 'bearish' THEN 'raise_equity_sips_in_dip' END, CASE WHEN persona = 'growth' AND level = 'low' THEN 'add_mid_small_cap' END, CASE WHEN persona = 'growth' THEN 'stay_invested' END,
 CASE WHEN persona = 'balanced' THEN 'rebalance_60_40' END, CASE WHEN persona = 'balanced' AND level = 'high' THEN 'shift_to_balanced_advantage' END, CASE WHEN persona = 'balanced' THEN 'continue_stp' END,
 CASE WHEN persona = 'passive' THEN 'continue_index_sips,review_expense_ratios' END, CASE WHEN vix > 25 THEN 'avoid_lump_sum' END, CASE WHEN n < 3 THEN 'diversify_categories' END) AS recommendations, vix, round_even(round(abs(change_pct), 9), 1) AS move_pct, round_even(round(coalesce(ev * 100 / nullif(total, 0), 0), 9), 0) AS equity_pct FROM rl)
SELECT p.portfolio, vix, move_pct, equity_pct, coalesce(alerts, 'no_portfolio_data') AS alerts, coalesce(recommendations, 'add_funds') AS recommendations
FROM (SELECT portfolio FROM pmarket UNION SELECT -1 - s_suppkey FROM supplier) p LEFT JOIN al ON al.portfolio = p.portfolio""", RISK_VIEWS)
def risk_alerts(t):
    every = t.customer.select(F.col("c_custkey").alias("portfolio")).unionByName(t.supplier.select((-1 - F.col("s_suppkey")).alias("portfolio")))
    r = K.risk_alerts(V.holdings(t), V.portfolio_market(t), "portfolio", every)
    return r.select("portfolio", "vix", "move_pct", "equity_pct", F.array_join("alerts", ",").alias("alerts"), F.array_join("recommendations", ",").alias("recommendations"))


@query(f"""WITH {RISK} SELECT rl.portfolio, score AS portfolio_risk_score, round_even(greatest(0, least(100, 100 - score)), 1) AS portfolio_health_score, fund_overlap_pct, conc AS sector_concentration_pct,
 round_even(greatest(50, least(100, 98 - vix * 0.5::DOUBLE)), 1) AS sip_consistency_score,
 round_even(greatest(5, least(95, vix * 1.5::DOUBLE + CASE persona WHEN 'conservative' THEN 25 WHEN 'balanced' THEN 10 ELSE 0 END + CASE WHEN sentiment = 'bearish' THEN 15 ELSE 0 END)), 1) AS panic_selling_probability
FROM rl JOIN (SELECT portfolio, CASE WHEN count(*) > 1 THEN round_even(round((1 - count(DISTINCT lower(coalesce(category, ''))) / count(*)) * 100, 9), 1) ELSE 0.0::DOUBLE END AS fund_overlap_pct FROM holdings GROUP BY 1) o ON o.portfolio = rl.portfolio
JOIN (SELECT portfolio, round_even(round(max(v) * 100 / sum(v), 9), 1) AS conc FROM (SELECT portfolio, coalesce(sector, 'Technology & Energy') AS s, sum(value) AS v FROM holdings GROUP BY 1, 2) GROUP BY 1) c ON c.portfolio = rl.portfolio""", RISK_VIEWS)
def portfolio_health(t):
    return K.portfolio_health(V.holdings(t), V.portfolio_market(t), "portfolio")


def _sql_list(words):
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


def _impact_sql():
    from ..functions import words as W
    has = lambda w: f"contains(blob, '{w}')"
    n = lambda ws: f"len(list_filter({_sql_list(ws)}, lambda w: contains(blob, w)))"
    bias = "CASE sentiment WHEN 'bearish' THEN -0.15::DOUBLE WHEN 'bullish' THEN 0.15::DOUBLE ELSE 0::DOUBLE END"
    rows = []
    for i, (sector, ws) in enumerate(W.SECTOR_KEYWORDS.items()):
        s = " + ".join(f"CASE WHEN {has(w)} THEN 0.35::DOUBLE ELSE 0::DOUBLE END" for w in ws)
        if sector in ("Banking", "Large Cap"):
            s += f" + CASE WHEN {has('gdp')} OR {has('earnings')} THEN 0.25::DOUBLE ELSE 0::DOUBLE END"
        if sector == "Debt":
            s += f" - CASE WHEN {has('rate hike')} OR {has('inflation')} THEN 0.5::DOUBLE ELSE 0::DOUBLE END"
        if sector == "Energy":
            s += f" + CASE WHEN {has('oil')} OR {has('crude')} THEN CASE WHEN {has('increase')} OR {has('spike')} THEN -0.35::DOUBLE ELSE 0.2::DOUBLE END ELSE 0::DOUBLE END"
        s += f" + ({bias} - CASE WHEN vix > 20 THEN 0.1::DOUBLE ELSE 0::DOUBLE END)" if sector in ("Mid Cap", "Large Cap", "IT") else f" + {bias} * 0.5::DOUBLE"
        rows.append(f"SELECT desk, {i} AS ord, '{sector}' AS sector, greatest(-1, least(1, {s})) AS impact FROM bm")
    return f"""bl AS (SELECT desk, count(*) AS n, string_agg(lower(title) || ' ' || lower(category), ' ' ORDER BY ts, event_id) AS blob, arg_min(title, ts) AS headline FROM desk GROUP BY 1),
bm AS (SELECT bl.*, vix, sentiment FROM bl LEFT JOIN dmarket USING (desk)),
im AS ({" UNION ALL ".join(rows)}),
se AS (SELECT *, CASE WHEN score <= -0.6 OR vix >= 28 THEN 'critical' WHEN score <= -0.25 OR vix >= 22 THEN 'high' WHEN score >= 0.45 AND vix <= 18 THEN 'positive' ELSE 'moderate' END AS severity,
 round(greatest(0.35::DOUBLE, least(0.95::DOUBLE, 0.55::DOUBLE + least(n, 8) * 0.04::DOUBLE + CASE WHEN vix <> 0 THEN 0.05::DOUBLE ELSE 0 END)), 4) AS confidence FROM (
 SELECT *, ({n(W.IMPACT_POSITIVE)} - {n(W.IMPACT_NEGATIVE)}) / greatest(1, {n(W.IMPACT_POSITIVE)} + {n(W.IMPACT_NEGATIVE)}) AS score FROM bm)),
ac AS (SELECT se.desk, se.severity, se.confidence, se.vix,
 (SELECT coalesce(string_agg(sector, ',' ORDER BY ord), '') FROM im WHERE im.desk = se.desk AND abs(impact) >= 0.25) AS affected,
 (SELECT string_agg('underperform:' || sector, ',' ORDER BY impact, ord) FROM (SELECT *, row_number() OVER (PARTITION BY desk ORDER BY impact, ord) AS r FROM im) x WHERE x.desk = se.desk AND r <= 2 AND impact <= -0.25) AS warn,
 (SELECT 'overweight:' || sector FROM (SELECT *, row_number() OVER (PARTITION BY desk ORDER BY impact DESC, ord) AS r FROM im) x WHERE x.desk = se.desk AND r = 1 AND impact > 0.25) AS over,
 (SELECT string_agg(sector, ',' ORDER BY abs(impact) DESC, ord) FROM (SELECT *, row_number() OVER (PARTITION BY desk ORDER BY abs(impact) DESC, ord) AS r FROM im) x WHERE x.desk = se.desk AND r <= 3) AS strongest FROM se),
ax AS (SELECT *, concat_ws(',', CASE WHEN severity IN ('high', 'critical') THEN 'defensive_positioning' END, CASE WHEN vix >= 25 THEN 'vix:' || format('{{:.1f}}', vix) END, warn) AS alerts FROM ac)"""


IMPACT = _impact_sql()
ORDER = ["ts", "event_id"]


@query(f"WITH {IMPACT} SELECT desk, sector, round(impact, 3) AS impact FROM im", "desk dmarket")
def sector_impact(t):
    return I.sector_impact(V.desk(t), V.desk_market(t), "desk", ORDER, "desk")


@query(f"WITH {IMPACT} SELECT desk, n, round(score, 4) AS score, severity, confidence FROM se", "desk dmarket")
def impact_severity(t):
    return I.impact_severity(V.desk(t), V.desk_market(t), "desk", ORDER, "desk")


@query(f"""WITH {IMPACT} SELECT desk, severity, affected, alerts, concat_ws(',', CASE WHEN severity IN ('high', 'critical') THEN 'raise_debt_or_liquid,stagger_equity' END,
 CASE WHEN desk % 3 = 0 THEN 'prefer_large_cap_and_debt' WHEN desk % 3 = 1 THEN 'build_strong_sectors' END, over) AS actions, strongest FROM ax""", "desk dmarket")
def impact_actions(t):
    d = V.desk(t)
    k = F.col("desk")
    prof = d.select("desk").distinct().withColumn("risk_profile", F.when(k % 3 == 0, "Conservative (Debt)").when(k % 3 == 1, "Aggressive Growth"))
    a = I.impact_actions(d, V.desk_market(t), "desk", ORDER, prof, "desk")
    return a.select("desk", "severity", *[F.array_join(c, ",").alias(c) for c in ("affected", "alerts", "actions")],
                    F.array_join(F.transform("strongest", lambda s: F.regexp_replace(s, r" [+-][0-9.]+$", "")), ",").alias("strongest"))


@query(f"""WITH {IMPACT} SELECT desk, severity, concat_ws(',', CASE WHEN vix > 24 THEN 'volatility_vix:' || format('{{:.1f}}', vix) END, nullif(array_to_string(string_split(alerts, ',')[1:2], ','), '')) AS alerts FROM ax""", "desk dmarket")
def live_alerts(t):
    a = I.live_alerts(V.desk(t), V.desk_market(t), "desk", ORDER, 2, "desk")
    return a.select("desk", "severity", F.array_join("alerts", ",").alias("alerts"))


@query(f"WITH {IMPACT} SELECT desk, headline, substr(blob, 1, 140) AS opening FROM bl", "desk dmarket")
def impact_openings(t):
    return I.impact_explain(V.desk(t), "desk", ORDER)


@query(f"""WITH {IMPACT} SELECT desk, string_agg(sector, ',' ORDER BY abs(impact) DESC, sector) AS top FROM (SELECT *, row_number() OVER (PARTITION BY desk ORDER BY abs(impact) DESC, sector) AS r FROM (SELECT desk, sector, round(impact, 3) AS impact FROM im) WHERE abs(impact) >= 0.1) WHERE r <= 3 GROUP BY 1""", "desk dmarket")
def top_sectors_map(t):
    """Map functions: sector scores as a map, small ones dropped, the three largest kept."""
    s = I.sector_impact(V.desk(t), V.desk_market(t), "desk", ORDER, "desk")
    m = s.groupBy("desk").agg(F.map_from_entries(F.collect_list(F.struct("sector", "impact"))).alias("m"))
    m = m.withColumn("m", F.map_filter("m", lambda k, v: F.abs(v) >= 0.1)).filter(F.size("m") > 0)
    return m.select("desk", F.array_join(F.transform(top_entries("m", 3), lambda e: e["key"]), ",").alias("top"))
