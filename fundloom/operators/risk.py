"""Portfolio risk. Holdings are summed once per portfolio; every measure is arithmetic on those sums and a snapshot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import words as W
from ..functions.rules import pick
from ..functions.scalars import clamp, default, keep, round_even, safe_div
from .aggregates import fund_overlap, sector_concentration
from .joins import with_market

KEY = "portfolio"


def portfolio_sums(holdings: DataFrame) -> DataFrame:
    """Sums every measure needs: total, beta-weighted, equity, return-weighted value, size, persona, largest sector."""
    value = default("value", 0.0)
    beta = F.when(F.col("category").isNull(), W.CATEGORY_BETA["equity"]).otherwise(pick(W.CATEGORY_BETA, "category", 1.0))
    by_sector = holdings.groupBy(KEY, default("sector", "Unknown").alias("_sector")).agg(
        F.sum(value).alias("v"), F.sum(beta * value).alias("bv"),
        F.sum(F.when(F.col("category").isin(W.EQUITY_CATEGORIES), value).otherwise(0.0)).alias("ev"),
        F.sum(default("returns", 0.0) * value).alias("rv"), F.count("*").alias("n"),
        F.max("persona").alias("persona"),
    )
    return by_sector.groupBy(KEY).agg(
        F.sum("v").alias("total"), F.sum("bv").alias("beta_value"), F.sum("ev").alias("equity_value"),
        F.sum("rv").alias("return_value"), F.sum("n").alias("holdings"), F.max("persona").alias("persona"),
        F.max("v").alias("largest_sector"))


def _in(sums: DataFrame, market: DataFrame, on: str | None) -> DataFrame:
    return with_market(sums, market, on, "m")


def beta_of() -> Column:
    weighted = F.when(F.col("total") > 0, F.col("beta_value") / F.nullif("total", F.lit(0.0))).otherwise(0.0)
    return round_even(weighted * (F.col("m.vix") / 20), 2)


def var_of() -> Column:
    return round_even(F.col("total") * 1.645 * (F.col("m.vix") / 100), 2)


def drawdown_of() -> Column:
    base = (
        F.when(F.col("m.market_status") == "VOLATILE", 0.15).when(F.col("m.vix") > 20, 0.12)
        .when(F.col("m.vix") > 15, 0.08).otherwise(0.05)
    )
    return round_even(base * (0.5 + safe_div("equity_value", "total", 0.0)) * 100, 2)


def sharpe_of(rf: float) -> Column:
    mean = F.when(F.col("total") > 0, F.col("return_value") / F.nullif("total", F.lit(0.0))).otherwise(0.0)
    return round_even(F.when(F.col("m.vix") > 0, (mean - rf) / F.nullif("m.vix", F.lit(0.0))).otherwise(0.0), 2)


def portfolio_beta(holdings: DataFrame, market: DataFrame, on: str | None = None) -> DataFrame:
    return _in(portfolio_sums(holdings), market, on).select(KEY, beta_of().alias("beta"))


def value_at_risk(holdings: DataFrame, market: DataFrame, on: str | None = None) -> DataFrame:
    return _in(portfolio_sums(holdings), market, on).select(KEY, var_of().alias("var_95"))


def max_drawdown_est(holdings: DataFrame, market: DataFrame, on: str | None = None) -> DataFrame:
    return _in(portfolio_sums(holdings), market, on).select(KEY, drawdown_of().alias("max_drawdown"))


def sharpe(holdings: DataFrame, market: DataFrame, rf: float = 6.0, on: str | None = None) -> DataFrame:
    return _in(portfolio_sums(holdings), market, on).select(KEY, sharpe_of(rf).alias("sharpe_ratio"))


def risk_score(holdings: DataFrame, market: DataFrame, on: str | None = None, rf: float = 6.0) -> DataFrame:
    """All measures, the 0-100 risk score and its level, one row per portfolio; sums and snapshot are kept as columns."""
    out = _in(portfolio_sums(holdings), market, on).select(
        "*", beta_of().alias("beta"), var_of().alias("var_95"), drawdown_of().alias("max_drawdown"),
        sharpe_of(rf).alias("sharpe_ratio"))
    base = F.col("beta") * 20 + F.least(F.col("var_95") / 10000, F.lit(30.0)) + F.col("max_drawdown") * 1.5
    mood = F.when(F.col("m.market_status") == "VOLATILE", 1.3).when(F.col("m.sentiment") == "bearish", 1.15).otherwise(1.0)
    out = out.withColumn("portfolio_risk_score", F.least(F.lit(100.0), round_even(
        base * mood * pick(W.PERSONA_MULTIPLIER, "persona", 1.0), 1)))
    limit = lambda i: pick({p: float(v[i]) for p, v in W.PERSONA_LIMITS.items()}, "persona", (40.0, 60.0, 80.0)[i])
    s = F.col("portfolio_risk_score")
    return out.withColumn("risk_level", F.when(s < limit(0), "low").when(s < limit(1), "medium")
                          .when(s < limit(2), "high").otherwise("critical"))


def risk_alerts(holdings: DataFrame, market: DataFrame, on: str | None = None, portfolios: DataFrame | None = None) -> DataFrame:
    """Alert and recommendation codes in rule order, and the values that alerts speak of: volatility index, size of the day's
    move and equity share, both in percent. ``portfolios`` adds a row for each portfolio without holdings."""
    s = risk_score(holdings, market, on)
    share, who, vix, move, level = (
        safe_div(F.col("equity_value") * 100, "total", 0.0), F.col("persona"), F.col("m.vix"), F.col("m.change_pct"),
        F.col("risk_level"))
    alerts = keep(
        F.when(F.col("m.market_status") == "VOLATILE", F.lit("high_market_volatility")),
        F.when(F.col("m.volume_spike"), F.lit("volume_spike")),
        F.when(vix > 20, F.lit("elevated_vix")),
        F.when(move > 2, F.lit("market_up_over_2pct")).when(move < -2, F.lit("market_down_over_2pct")),
        F.when((who == "conservative") & (share > 40), F.lit("equity_high_for_conservative")),
        F.when((who == "growth") & (share < 50), F.lit("equity_low_for_growth")),
        F.when(safe_div("largest_sector", "total", 0.0) > 0.5, F.lit("sector_over_half")),
    )
    is_ = lambda p: who == p
    tense = is_("conservative") & level.isin("high", "critical")
    advice = keep(
        F.when(tense, F.lit("raise_liquid_and_debt")),
        F.when(tense, F.lit("pause_equity_sips")),
        F.when(is_("conservative"), F.lit("keep_emergency_corpus")),
        F.when(is_("growth") & (F.col("m.sentiment") == "bearish"), F.lit("raise_equity_sips_in_dip")),
        F.when(is_("growth") & (level == "low"), F.lit("add_mid_small_cap")),
        F.when(is_("growth"), F.lit("stay_invested")),
        F.when(is_("balanced"), F.lit("rebalance_60_40")),
        F.when(is_("balanced") & (level == "high"), F.lit("shift_to_balanced_advantage")),
        F.when(is_("balanced"), F.lit("continue_stp")),
        F.when(is_("passive"), F.lit("continue_index_sips")),
        F.when(is_("passive"), F.lit("review_expense_ratios")),
        F.when(vix > 25, F.lit("avoid_lump_sum")),
        F.when(F.col("holdings") < 3, F.lit("diversify_categories")),
    )
    out = s.select(KEY, "portfolio_risk_score", "risk_level", alerts.alias("alerts"), advice.alias("recommendations"),
                   vix.alias("vix"), round_even(F.abs(move), 1).alias("move_pct"), round_even(share, 0).alias("equity_pct"))
    if portfolios is None:
        return out
    return portfolios.select(KEY).distinct().join(out, KEY, "left").select(
        KEY, default("portfolio_risk_score", 0.0).alias("portfolio_risk_score"), default("risk_level", "low").alias("risk_level"),
        F.coalesce("alerts", F.array(F.lit("no_portfolio_data"))).alias("alerts"),
        F.coalesce("recommendations", F.array(F.lit("add_funds"))).alias("recommendations"), "vix", "move_pct", "equity_pct")


def portfolio_health(holdings: DataFrame, market: DataFrame, on: str | None = None) -> DataFrame:
    """Health, overlap, concentration, SIP consistency and panic probability. All parts are hashed by portfolio, so the
    joins between them reuse that partitioning."""
    s = risk_score(holdings, market, on)
    panic = (
        F.col("m.vix") * 1.5
        + F.when(F.col("persona") == "conservative", 25.0).when(F.col("persona") == "balanced", 10.0).otherwise(0.0)
        + F.when(F.col("m.sentiment") == "bearish", 15.0).otherwise(0.0)
    )
    return (
        s.join(fund_overlap(holdings), KEY).join(sector_concentration(holdings), KEY)
        .select(
            KEY, "portfolio_risk_score",
            round_even(clamp(100 - F.col("portfolio_risk_score"), 0, 100), 1).alias("portfolio_health_score"),
            "fund_overlap_pct", "sector_concentration_pct",
            round_even(clamp(98.0 - F.col("m.vix") * 0.5, 50, 100), 1).alias("sip_consistency_score"),
            round_even(clamp(panic, 5, 95), 1).alias("panic_selling_probability"))
    )
