"""Derivation rules as column expressions: lead tiers, engagement, risk appetite, market state, fund profiles."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from . import words as W
from .scalars import as_col, clamp, default, hit_count, contains_any, minute_of_day, parse_amount, round_even, safe_div


def pick(mapping: dict, key, default_value=None) -> Column:
    """Small fixed map as a lookup expression, with a default for other keys."""
    expr = None
    for k, v in mapping.items():
        cond = as_col(key) == F.lit(k)
        expr = F.when(cond, F.lit(v)) if expr is None else expr.when(cond, F.lit(v))
    return expr.otherwise(F.lit(default_value))


# ---- leads ---------------------------------------------------------------------------------

def engagement_score(visits, time_spent, pages=None) -> Column:
    score = as_col(visits) * 0.3 + as_col(time_spent) * 0.0005
    return score if pages is None else score + as_col(pages) * 10


def engagement_tier(score, variant: str = "open") -> Column:
    """``open``: above 50 / 20, anything else (null too) Low. ``binned``: (..10], (10..30], (30..), null stays null."""
    s = as_col(score)
    if variant == "open":
        return F.when(s > 50, "High").when(s > 20, "Medium").otherwise("Low")
    return F.when(s <= 10, "Low").when(s <= 30, "Medium").when(s > 30, "High")


def profile_strength(activity, profile) -> Column:
    return (default(activity, 0.0) + default(profile, 0.0)) / 2


def engagement_velocity(pages, time_spent) -> Column:
    t = as_col(time_spent)
    return F.when(t > 0, as_col(pages) / t).otherwise(0.0)


def activity_score(visits, pages) -> Column:
    return as_col(visits) * as_col(pages)


def lead_age_bin(visits) -> Column:
    v = as_col(visits)
    return (
        F.when((v > -1) & (v <= 0), "New").when((v > 0) & (v <= 5), "Active")
        .when((v > 5) & (v <= 15), "Engaged").when(v > 15, "Hot")
    )


def lead_tier(prob, variant: str = "strict") -> Column:
    p = as_col(prob)
    if variant == "strict":
        return F.when(p > 0.85, "hot").when(p > 0.65, "warm").otherwise("cold")
    if variant == "inclusive":
        return F.when(p >= 0.85, "hot").when(p >= 0.65, "warm").otherwise("cold")
    if variant == "tier123":
        return F.when(p >= 0.8, "Tier 1: Hot").when(p >= 0.5, "Tier 2: Nurture").otherwise("Tier 3: Cold")
    raise ValueError(f"unknown tier variant {variant!r}")


def pitch_persona(time_spent) -> Column:
    t = default(time_spent, 0.0)
    return (
        F.when(t > 1500, "Aggressive Growth Chaser").when(t > 800, "Brand Loyalist")
        .otherwise("Conservative Wealth Preserver")
    )


def asset_class(time_spent) -> Column:
    return F.when(as_col(time_spent) > 1000, "Equity Scheme").otherwise("Debt Scheme")


# ---- investors -----------------------------------------------------------------------------

def debt_to_income(debt, income) -> Column:
    inc = as_col(income)
    return as_col(debt) / F.when(inc == 0, 1.0).otherwise(inc)


def risk_appetite(score, dti) -> Column:
    s, d = as_col(score), as_col(dti)
    return (
        F.when((s > 720) & (d < 1.5), "Aggressive (Equity)").when((s > 650) & (d < 2.5), "Moderate (Hybrid)")
        .otherwise("Conservative (Debt)")
    )


def rule_persona(growth, liquidity, trust, risk=None) -> Column:
    """With a risk column, growth counts only where that column is set and non-zero."""
    grows = as_col(growth) > 5
    if risk is not None:
        grows = grows & (default(risk, 0) != 0)
    names = list(W.RULE_PERSONA_RISK)
    return (
        F.when(grows, names[0]).when(as_col(liquidity) > 5, names[1]).when(as_col(trust) > 6, names[2])
        .otherwise(names[3])
    )


def persona_risk(persona) -> Column:
    return pick(W.RULE_PERSONA_RISK, persona)


def survey_average_persona(avg) -> Column:
    a = as_col(avg)
    return (
        F.when(a >= 4, "growth").when(a >= 3, "balanced").when(a >= 2, "passive").otherwise("conservative")
    )


def sip_future_value(monthly, rate_pct, years) -> Column:
    """Future value of a monthly instalment paid at the start of each month."""
    m, n, r = as_col(monthly), as_col(years) * 12, as_col(rate_pct) / 1200
    grown = F.pow(1 + r, n)
    return F.when(r == 0, m * n).otherwise(m * ((grown - 1) / F.nullif(r, F.lit(0.0))) * (1 + r))


# ---- market state --------------------------------------------------------------------------

def is_volatile(change, vix) -> Column:
    return (F.abs(as_col(change)) > 1.5) | (as_col(vix) > 25)


def market_sentiment(change) -> Column:
    c = as_col(change)
    return F.when(c > 1, "bullish").when(c < -1, "bearish").otherwise("neutral")


def market_open(ts_utc) -> Column:
    """Monday to Friday, 09:15 to 15:30 Indian time."""
    local = F.from_utc_timestamp(as_col(ts_utc), "Asia/Kolkata")
    minute = minute_of_day(local)
    return (F.weekday(local) < 5) & minute.between(9 * 60 + 15, 15 * 60 + 30)


def signal_label(score) -> Column:
    s = as_col(score)
    return F.when(s > 0.3, "Bullish").when(s < -0.3, "Bearish").otherwise("Neutral")


def call_light(is_open, signal) -> Column:
    o = as_col(is_open)
    return F.when(o & (as_col(signal) == "Bullish"), "green").when(o, "yellow").otherwise("red")


def sentiment_score(change) -> Column:
    """Percentage change to a score in [-100, 100]; steeper near zero, flat beyond 5 %."""
    c = as_col(change)
    size, sign = F.abs(c), F.when(c < 0, -1.0).otherwise(1.0)
    far = 85.0 + (F.least(size, F.lit(5.0)) - 1.5) * 4.2
    near = 40.0 + (size - 0.5) * 45.0
    raw = F.when(size > 1.5, sign * far).when(size > 0.5, sign * near).otherwise(c * 80.0)
    return clamp(round_even(raw, 1), -100, 100)


def sentiment_band(change) -> Column:
    c = as_col(change)
    return (
        F.when(c > 1.5, "Very Bullish").when(c > 0.5, "Bullish").when(c < -1.5, "Highly Bearish")
        .when(c < -0.5, "Bearish").otherwise("Neutral")
    )


def volatility_score(vix) -> Column:
    return clamp(round_even(as_col(vix) * 2.5, 1), 0, 100)


def risk_intensity(volatility, sentiment) -> Column:
    return clamp(round_even(as_col(volatility) * 0.6 + F.abs(as_col(sentiment)) * 0.4, 1), 0, 100)


# ---- funds ---------------------------------------------------------------------------------

def fund_group(category) -> Column:
    """First keyword group found in the category text; ``balanced`` when none is."""
    text = F.lower(default(category, ""))
    expr = F
    for group, keys in W.FUND_GROUPS:
        expr = expr.when(contains_any(text, keys), F.lit(group))
    return expr.otherwise("balanced")


def fund_rating(group, aum) -> Column:
    base = pick(W.GROUP_RATING, group, 3)
    return F.least(F.greatest(base + (as_col(aum) >= 5000).cast("int"), F.lit(3)), F.lit(5))


def fund_return(group, aum, nav, years: int) -> Column:
    slot, aum_weight, nav_weight = {1: (0, 1.0, 0.15), 3: (1, 0.8, 0.12), 5: (2, 0.6, 0.10)}[years]
    base = pick({g: r[slot] for g, r in W.GROUP_RETURNS.items()}, group, (12.0, 11.0, 10.0)[slot])
    bonus = F.when(as_col(aum) >= 1000, 0.5).otherwise(0.0)
    return round_even(base + bonus * aum_weight + clamp(as_col(nav) / 1000.0, 0, 2) * nav_weight, 1)


def fund_match(group) -> Column:
    return F.when(as_col(group).isin("balanced", "passive"), 0.45).otherwise(0.55)


def fund_risk_score(category, status, vix, sentiment) -> Column:
    factor = (
        F.when(as_col(status) == "VOLATILE", 1.3).when(as_col(vix) > 20, 1.2)
        .when(as_col(sentiment) == "bearish", 1.1).otherwise(1.0)
    )
    return F.least(F.lit(100.0), pick(W.CATEGORY_RISK, category, 50.0) * factor)


def persona_of_risk_text(text) -> Column:
    t = F.lower(default(text, ""))
    return (
        F.when(contains_any(t, ["aggressive", "equity", "growth"]), "growth")
        .when(contains_any(t, ["conservative", "debt", "liquid"]), "conservative")
        .when(contains_any(t, ["passive", "index"]), "passive").otherwise("balanced")
    )


# ---- signals -------------------------------------------------------------------------------

def lexicon_label(text, lexicon: str = "long") -> Column:
    pos, neg = (W.POSITIVE_LONG, W.NEGATIVE_LONG) if lexicon == "long" else (W.POSITIVE_SHORT, W.NEGATIVE_SHORT)
    t = F.lower(default(text, ""))
    p, n = hit_count(t, pos), hit_count(t, neg)
    return F.when(p > n, "positive").when(n > p, "negative").otherwise("neutral")


def lexicon_confidence(label, majority: float = 0.8) -> Column:
    return F.when(as_col(label) == "neutral", 0.5).otherwise(majority)


def normal_label(label, score, text=None) -> Column:
    """Model labels to Positive/Negative/Neutral; weak scores and blank text are Neutral."""
    name = pick({"POSITIVE": "Positive", "NEGATIVE": "Negative"}, label, "Neutral")
    weak = as_col(score) < 0.6
    if text is not None:
        weak = weak | (F.trim(default(text, "")) == "")
    return F.when(weak, "Neutral").otherwise(name)


def signal_score(sentiment, impact, confidence) -> Column:
    """Direction of a market signal weighted by its confidence, in [-1, 1]. Confidence that is no number is 0.5."""
    s, i = F.lower(default(sentiment, "neutral")), F.lower(default(impact, "neutral"))
    base = F.when(s.isin(W.SIGNAL_UP), 1.0).when(s.isin(W.SIGNAL_DOWN), -1.0).otherwise(0.0)
    push = F.when(i.isin(W.IMPACT_UP), 0.25).when(i.isin(W.IMPACT_DOWN), -0.25).otherwise(0.0)
    conf = F.coalesce(as_col(confidence).cast("string").try_cast("double"), F.lit(0.5))
    return clamp((base + push) * clamp(conf, 0.3, 1.0), -1, 1)
