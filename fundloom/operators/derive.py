"""Derived columns on whole tables, built from the rule expressions. Absent inputs make a step a no-op."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import rules as R, text as X, words as W
from ..functions.scalars import clean_currency, default, keep, round_even, safe_div


def _has(df: DataFrame, *cols: str) -> bool:
    return all(c in df.columns for c in cols)


def lead_features(df: DataFrame, visits="total_visits", time="time_spent", pages="page_views",
                  activity="activity", profile="profile") -> DataFrame:
    """Engagement score (with and without the pages term), tiers, velocity, activity, age bin, persona, asset class."""
    new = {}
    if _has(df, visits, time, pages):
        new["engagement_score"] = R.engagement_score(visits, time, pages)
        new["engagement_tier"] = R.engagement_tier(new["engagement_score"])
    if _has(df, visits, time):
        new["engagement_score_bi"] = R.engagement_score(visits, time)
        new["engagement_tier_bi"] = R.engagement_tier(new["engagement_score_bi"], "binned")
    if _has(df, activity, profile):
        new["profile_strength"] = R.profile_strength(activity, profile)
    if _has(df, pages, time):
        new["engagement_velocity"] = R.engagement_velocity(pages, time)
    if _has(df, visits, pages):
        new["activity_score"] = R.activity_score(visits, pages)
    if _has(df, visits):
        new["lead_age_bin"] = R.lead_age_bin(visits)
    if _has(df, time):
        new["pitch_persona"] = R.pitch_persona(time)
        new["asset_class"] = R.asset_class(time)
    return df.withColumns(new) if new else df


def risk_appetite(df: DataFrame) -> DataFrame:
    """Debt-to-income ratio and inferred risk profile from (maybe textual) income, debt and credit score."""
    out = df.withColumns({c: clean_currency(c) for c in ("yearly_income", "total_debt") if c in df.columns})
    out = out.withColumn("debt_to_income_ratio", R.debt_to_income("total_debt", "yearly_income"))
    return out.withColumn("inferred_risk_profile", R.risk_appetite("credit_score", "debt_to_income_ratio"))


def rule_persona(df: DataFrame) -> DataFrame:
    risk = "Risk" if "Risk" in df.columns else None
    return df.withColumn("persona", R.rule_persona("Growth", "Liquidity", "Trustworthiness", risk)).withColumn(
        "risk_tolerance", R.persona_risk("persona"))


def route_clusters(df: DataFrame, mapping: DataFrame | None = None, cluster: str = "cluster") -> DataFrame:
    """Fund type and distributor per cluster. The mapping is a table whose null cluster row is the default."""
    if mapping is None:
        mapping = df.sparkSession.createDataFrame(W.CLUSTER_ROUTES, f"{cluster} int, fund_type string, distributor string")
    known = mapping.filter(F.col(cluster).isNotNull())
    other = mapping.filter(F.col(cluster).isNull()).select(F.struct("fund_type", "distributor").alias("s")).limit(1)
    return (
        df.join(known, cluster, "left").withColumn("_other", other.scalar())
        .withColumns({c: F.coalesce(F.col(c), F.col(f"_other.{c}")) for c in ("fund_type", "distributor")})
        .drop("_other")
    )


def survey_persona(answers: DataFrame, key: str = "investor_id", answer: str = "answer") -> DataFrame:
    """Most frequent persona answer per investor; ties go to the earlier persona, no valid answer to the first."""
    counts = [F.count_if(F.col(answer) == p).alias(p) for p in W.SURVEY_ORDER]
    best = F.greatest(*[F.col(p) for p in W.SURVEY_ORDER])
    expr = F
    for p in W.SURVEY_ORDER:
        expr = expr.when(F.col(p) == best, F.lit(p))
    return answers.groupBy(key).agg(*counts).select(key, expr.alias("persona"))


def survey_persona_numeric(answers: DataFrame, key: str = "investor_id", value: str = "value") -> DataFrame:
    """Persona from the mean of 1..5 answers; a missing answer counts 3."""
    return answers.groupBy(key).agg(F.avg(default(F.col(value).cast("double"), 3.0)).alias("_avg")).select(
        key, R.survey_average_persona("_avg").alias("persona"))


def client_insights(df: DataFrame, n: int = 12, prob: str = "conversion_probability", key: str = "lead_id", name: str = "name") -> DataFrame:
    p = F.coalesce(F.col(prob), F.lit(0.5))
    out = df.select(
        F.col(key).alias("client_id"), default(name, "Client").alias("name") if name in df.columns else F.lit("Client").alias("name"), p.alias("probability"),
        round_even(1.0 - p, 2).alias("sip_drop_probability"), (p < 0.45).alias("inactive_flag"),
        round_even(0.1 + 0.5 * (1.0 - p), 2).alias("redemption_likelihood"),
        F.when(p < 0.5, "Decreasing due to Volatility").when(p < 0.85, "Stable").otherwise("Increasing")
        .alias("risk_appetite_change"),
        round_even(50.0 + p * 45.0, 1).alias("portfolio_health_score"),
        (round_even(1.0 - p, 2) > 0.60).alias("retention_alert"),
        F.when(p > 0.8, "Equity SIP Top-up").when(p > 0.6, "Tax Saving ELSS Plan")
        .otherwise("Liquid Safe Harbor Parking").alias("upsell_opportunity"),
    )
    return out.orderBy(F.desc("probability"), "client_id").limit(n)


def suitability(df: DataFrame, risk="risk_level", category="category", sentiment="sentiment") -> DataFrame:
    """Checks a recommended fund category against the client's risk level and the market's sentiment.

    ``reason`` is the code of what speaks against it, or null; ``alternatives`` are funds to offer instead.
    """
    cat, client, mood = F.lower(F.col(category)), F.lower(F.col(risk)), F.col(sentiment)
    rating, label = F, F
    for names, score, tag in W.SUITABILITY:
        rating, label = rating.when(cat.isin(names), score), label.when(cat.isin(names), F.lit(tag))
    rating, label = rating.otherwise(W.SUITABILITY_OTHER[0]), label.otherwise(W.SUITABILITY_OTHER[1])
    middle = client.isin("balanced", "moderate")
    *known, (_, other) = W.SUITABLE_FUNDS
    listed = lambda names: F.array(*[F.lit(n) for n in names])
    funds = F
    for levels, names in known:
        funds = funds.when(client.isin(levels), listed(names))
    funds = funds.otherwise(listed(other))
    clash = ((client == "conservative") & F.col("fund_risk_label").isin("high", "medium-high", "medium")) | (
        middle & (F.col("fund_risk_label") == "high"))
    alert = (mood == "bearish") & F.col("fund_risk_label").isin("high", "medium-high") & ~F.col("_clash")
    return (
        df.withColumn("fund_risk_rating", rating).withColumn("fund_risk_label", label)
        .withColumn("_clash", F.coalesce(clash, F.lit(False)))
        .withColumn("recommended", ~F.col("_clash"))
        .withColumn("mismatch_flag", F.col("_clash") | F.coalesce(alert, F.lit(False)))
        .withColumn("suggested_allocation", F.when(client == "conservative",
                    F.when(F.col("fund_risk_label") == "low", 15.0).otherwise(5.0)).when(middle, 25.0).otherwise(40.0))
        .withColumn("outlook", F.when(mood.isin("neutral", "bearish"), "Staggered Systematic Entry Recommended")
                    .otherwise("Lump-sum / Accelerated SIP Permitted"))
        .withColumn("reason", F.when(F.col("_clash") & (client == "conservative"), "too_volatile_for_conservative")
                    .when(F.col("_clash"), "high_risk_for_balanced").when(F.coalesce(alert, F.lit(False)), "bearish_market"))
        .withColumn("alternatives", funds)
        .drop("_clash")
    )


def market_scores(df: DataFrame, change="change_pct", vix="vix") -> DataFrame:
    return (
        df.withColumn("sentiment_label", R.sentiment_band(change))
        .withColumn("sentiment_score", R.sentiment_score(change))
        .withColumn("volatility_score", R.volatility_score(vix))
        .withColumn("risk_intensity_score", R.risk_intensity("volatility_score", "sentiment_score"))
    )


def market_flags(df: DataFrame, ts: str = "ts", change="change_pct", vix="vix") -> DataFrame:
    return (
        df.withColumn("is_volatile", R.is_volatile(change, vix))
        .withColumn("sentiment", R.market_sentiment(change))
        .withColumn("is_open", R.market_open(ts))
    )


def sentiment_signal(df: DataFrame, score: str = "score") -> DataFrame:
    out = df.withColumn("signal", R.signal_label(score))
    return out.withColumn("call_light", R.call_light("is_open", "signal")) if "is_open" in df.columns else out


def sip_projection(df: DataFrame, monthly="monthly", rate="rate", years="years") -> DataFrame:
    return (
        df.withColumn("future_value", R.sip_future_value(monthly, rate, years))
        .withColumn("invested", F.col(monthly) * F.col(years) * 12)
        .withColumn("gains", F.col("future_value") - F.col("invested"))
    )


def article_text(df: DataFrame, width: int = 1000, body="Body_Text", title="Title") -> DataFrame:
    full = X.article_body(body, title)
    return df.withColumn("text", full).withColumn("scoring_text", F.substring(full, 1, width))


def lexicon_sentiment(df: DataFrame, text_col: str, lexicon: str = "long", majority: float = 0.8) -> DataFrame:
    return df.withColumn("sentiment", R.lexicon_label(text_col, lexicon)).withColumn(
        "confidence", R.lexicon_confidence("sentiment", majority))


def normalize_sentiment(df: DataFrame, label: str, score: str, text: str | None = None) -> DataFrame:
    blank = F.lit(False) if text is None else F.trim(default(text, "")) == ""
    return df.withColumn("label", R.normal_label(label, score, text)).withColumn(
        "score", F.when(blank, 0.5).otherwise(round_even(score, 4)))


def fund_risk_rating(df: DataFrame, category="category", status="status", vix="vix", sentiment="sentiment") -> DataFrame:
    raw = R.fund_risk_score(category, status, vix, sentiment)
    return df.withColumn("fund_risk_score", round_even(raw, 1)).withColumn(
        "recommendation", F.when(raw < 75, "Suitable").otherwise("High Risk - Review"))


def fund_match_score(df: DataFrame, persona="persona", sentiment="sentiment") -> DataFrame:
    """How well each (fund, profile) row fits: persona, mood of the market and risk level, at most 99."""
    cat, risk, who, mood = F.col("category"), F.col("risk"), F.col(persona), F.col(sentiment)
    score = (
        F.lit(65)
        + F.when(F.array_contains("personas", who), 25).otherwise(0)
        + F.when(((mood == "bullish") & (cat == "equity")) | ((mood == "bearish") & (cat == "debt")), 7).otherwise(0)
        + F.when(((risk == "high") & (who == "growth")) | ((risk == "low") & (who == "conservative")), 5).otherwise(0)
    )
    return df.withColumn("match_score", F.least(score, F.lit(99)))


def route_utterances(chat: DataFrame, text_col: str = "text", forced: str | None = None) -> DataFrame:
    """Audience, intent and screen-question flag of each utterance. ``forced`` names a boolean column that makes the
    audience a distributor."""
    flag = None if forced is None else F.coalesce(F.col(forced), F.lit(False))
    return (
        chat.withColumn("utterance", X.utterance(text_col))
        .withColumn("audience", X.audience("utterance", flag))
        .withColumn("intent", X.intent(F.col("utterance")))
        .withColumn("asks_about_screen", X.asks_about_screen("utterance"))
    )


def keyword_hits(df: DataFrame, text_col: str, dictionary: dict[str, list[str]], name: str = "hits") -> DataFrame:
    """(label, keyword) pairs found as substrings, each once, without multiplying rows."""
    text = F.lower(default(text_col, ""))
    found = [F.when(text.contains(k), F.struct(F.lit(g).alias("label"), F.lit(k).alias("keyword")))
             for g, ks in dictionary.items() for k in ks]
    return df.withColumn(name, keep(*found))
