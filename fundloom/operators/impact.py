"""Market impact of groups of signals.

The words a group's text contains are kept as bits and combined with ``bit_or``: text is never gathered per group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import words as W
from ..functions.scalars import clamp, default, keep
from .joins import with_market
from .ordered import global_rank
from .topk import topk

TEXT_FIELDS = ("title", "headline", "category", "sentiment", "market_impact", "summary", "body", "content")
EXTRA = ["gdp", "earnings", "rate hike", "inflation", "oil", "crude", "increase", "spike"]
VOCABULARY = list(dict.fromkeys(
    [k for ks in W.SECTOR_KEYWORDS.values() for k in ks] + W.IMPACT_POSITIVE + W.IMPACT_NEGATIVE + EXTRA))
BITS = 60
WORDS_PER = [VOCABULARY[i:i + BITS] for i in range(0, len(VOCABULARY), BITS)]
PHRASES = [v for v in VOCABULARY if " " in v]


def _mask(test: str, words: list[str]) -> Column:
    """Bit i is set where ``test`` holds for word i. Written as SQL text: one parse instead of hundreds of calls."""
    return F.expr(" | ".join(f"CASE WHEN {test.format(w=w)} THEN {1 << i}L ELSE 0L END" for i, w in enumerate(words)))


def signal_text(signals: DataFrame) -> Column:
    """Lower-case, trimmed text fields joined by a space, blank ones left out."""
    parts = [F.nullif(F.trim(F.lower(F.col(c))), F.lit("")) for c in TEXT_FIELDS if c in signals.columns]
    return F.concat_ws(" ", *parts)


def group_words(signals: DataFrame, group: str, order: list[str]) -> DataFrame:
    """Per group: number of signals and the vocabulary bits of their texts joined in order.

    A phrase may also straddle two neighbouring texts; those are found by joining each text's ending with the
    beginning of the next one on its rank.
    """
    text = signals.select(group, *order, signal_text(signals).alias("text"))
    inside = text.groupBy(group).agg(F.count("*").alias("n"), *[
        F.bit_or(_mask("contains(text, '{w}')", ws)).alias(f"w{i}") for i, ws in enumerate(WORDS_PER)])
    ranked = global_rank(text.filter("text <> ''"), order, "pos", by=[group])
    ends = _mask("endswith(text, split_part('{w}', ' ', 1))", PHRASES)
    starts = _mask("startswith(text, split_part('{w}', ' ', 2))", PHRASES)
    left = ranked.select(group, (F.col("pos") + 1).alias("pos"), ends.alias("e")).filter("e <> 0")
    right = ranked.select(group, "pos", starts.alias("s")).filter("s <> 0")
    met = left.join(right, [group, "pos"]).groupBy(group).agg(F.bit_or(F.col("e").bitwiseAND(F.col("s"))).alias("met"))
    out = inside.join(met, group, "left").withColumn("met", default("met", 0))
    straddling = lambda i, ws: " | ".join([f"w{i}"] + [
        f"CASE WHEN met & {1 << PHRASES.index(w)}L <> 0 THEN {1 << ws.index(w)}L ELSE 0L END" for w in ws if w in PHRASES])
    return out.withColumns({f"w{i}": F.expr(straddling(i, ws)) for i, ws in enumerate(WORDS_PER)}).drop("met")


def has(word: str) -> str:
    """SQL test that the group's texts contain the word."""
    i, ws = next((i, ws) for i, ws in enumerate(WORDS_PER) if word in ws)
    return f"(w{i} & {1 << ws.index(word)}L <> 0)"


VIX = "coalesce(nullif(m.vix, 0D), 15D)"
BIAS = "CASE lower(coalesce(m.sentiment, 'neutral')) WHEN 'bearish' THEN -0.15D WHEN 'bullish' THEN 0.15D ELSE 0D END"


def _sector_score(sector: str) -> str:
    one = lambda cond, v: f"CASE WHEN {cond} THEN {v} ELSE 0D END"
    score = " + ".join(one(has(k), "0.35D") for k in W.SECTOR_KEYWORDS[sector])
    if sector in ("Banking", "Large Cap"):
        score += " + " + one(f"{has('gdp')} OR {has('earnings')}", "0.25D")
    if sector == "Debt":
        score += " - " + one(f"{has('rate hike')} OR {has('inflation')}", "0.5D")
    if sector == "Energy":
        oil = f"CASE WHEN {has('increase')} OR {has('spike')} THEN -0.35D ELSE 0.2D END"
        score += " + " + one(f"{has('oil')} OR {has('crude')}", oil)
    if sector in ("Mid Cap", "Large Cap", "IT"):
        score += f" + ({BIAS} - {one(VIX + ' > 20', '0.1D')})"
    else:
        score += f" + ({BIAS}) * 0.5D"
    return f"greatest(-1D, least(1D, {score}))"


def analysed(signals: DataFrame, market: DataFrame, group: str, order: list[str], on: str | None = None) -> DataFrame:
    """Per group: sentiment score, severity, confidence and the sector impacts as an array in sector order."""
    g = with_market(group_words(signals, group, order), market, on, "m")
    count = lambda ws: "(" + " + ".join(f"cast({has(w)} as int)" for w in ws) + ")"
    sectors = ", ".join(f"named_struct('ord', {i}, 'sector', '{n}', 'impact', {_sector_score(n)})" for i, n in enumerate(W.SECTOR_KEYWORDS))
    g = g.select(group, "n", F.expr(f"{VIX} AS vix"), F.coalesce("m.vix", F.lit(0.0)).alias("_given"), F.expr(f"{count(W.IMPACT_POSITIVE)} AS pos"),
                 F.expr(f"{count(W.IMPACT_NEGATIVE)} AS neg"), F.expr(f"array({sectors}) AS sectors"))
    g = g.withColumn("score", F.expr("(pos - neg) / greatest(1, pos + neg)"))
    vix, s = F.col("vix"), F.col("score")
    return g.select(
        group, "n", "score", "vix",
        F.when((s <= -0.6) | (vix >= 28), "critical").when((s <= -0.25) | (vix >= 22), "high")
        .when((s >= 0.45) & (vix <= 18), "positive").otherwise("moderate").alias("severity"),
        F.round(clamp(0.55 + F.least("n", F.lit(8)) * 0.04 + F.when(F.col("_given") != 0, 0.05).otherwise(0.0), 0.35, 0.95), 4)
        .alias("confidence"),
        "sectors")


def sector_impact(signals, market, group, order, on=None) -> DataFrame:
    a = analysed(signals, market, group, order, on)
    return a.select(group, F.inline("sectors")).select(group, "sector", F.round("impact", 3).alias("impact"))


def impact_severity(signals, market, group, order, on=None) -> DataFrame:
    return analysed(signals, market, group, order, on).select(group, "n", F.round("score", 4).alias("score"), "severity", "confidence")


def _signed(v: Column) -> Column:
    return F.concat(F.when(v >= 0, "+").otherwise(""), F.format_string("%.2f", v))


def impact_actions(signals, market, group, order, profiles: DataFrame | None = None, on=None) -> DataFrame:
    """Affected sectors, alerts, actions for the profile's risk text, and the three strongest sectors, per group."""
    a = analysed(signals, market, group, order, on)
    if profiles is not None:
        a = a.join(profiles.select(group, F.lower("risk_profile").alias("risk")), group, "left")
    else:
        a = a.withColumn("risk", F.lit("balanced"))
    a = a.withColumn("risk", default("risk", "balanced"))
    ranked = lambda key: F.array_sort(F.transform("sectors", lambda s: F.struct(
        key(s["impact"]).alias("k"), s["ord"].alias("ord"), s["sector"].alias("sector"), s["impact"].alias("impact"))))
    low, high, strong = ranked(lambda v: v), ranked(lambda v: -v), ranked(lambda v: -F.abs(v))
    bad = F.col("severity").isin("high", "critical")
    warn = F.transform(F.filter(F.slice(low, 1, 2), lambda s: s["impact"] <= -0.25),
                       lambda s: F.concat(F.lit("underperform:"), s["sector"]))
    best = high[0]
    risk = F.col("risk")
    return a.select(
        group, "severity", "confidence",
        F.transform(F.filter("sectors", lambda s: F.abs(s["impact"]) >= 0.25), lambda s: s["sector"]).alias("affected"),
        F.concat(keep(F.when(bad, F.lit("defensive_positioning")),
                      F.when(F.col("vix") >= 25, F.concat(F.lit("vix:"), F.format_string("%.1f", "vix")))), warn).alias("alerts"),
        keep(F.when(bad, F.lit("raise_debt_or_liquid")), F.when(bad, F.lit("stagger_equity")),
             F.when(risk.contains("conservative"), F.lit("prefer_large_cap_and_debt"))
             .when(risk.contains("aggressive") | risk.contains("growth"), F.lit("build_strong_sectors")),
             F.when(best["impact"] > 0.25, F.concat(F.lit("overweight:"), best["sector"]))).alias("actions"),
        F.transform(F.slice(strong, 1, 3), lambda s: F.concat(s["sector"], F.lit(" "), _signed(s["impact"]))).alias("strongest"),
    )


def impact_explain(signals, group, order, width: int = 140) -> DataFrame:
    """Headline and opening text per group: a text takes at least two characters, so ``width / 2`` of them
    suffice, each cut to ``width``."""
    t = signals.select(group, *order, F.substring(signal_text(signals), 1, width).alias("text")).filter("text <> ''")
    first = topk(t, [group], [F.col(o) for o in order], width // 2, rank="pos")
    blob = F.concat_ws(" ", F.transform(F.array_sort(F.collect_list(F.struct("pos", "text"))), lambda s: s["text"]))
    names = [F.nullif(F.col(c), F.lit("")) for c in ("title", "headline", "category") if c in signals.columns]
    head = signals.groupBy(group).agg(F.min_by(F.coalesce(*names, F.lit("Market signal")), F.struct(*order)).alias("headline"))
    return head.join(first.groupBy(group).agg(F.substring(blob, 1, width).alias("opening")), group, "left")


def live_alerts(signals, market, group, order, n: int = 10, on=None) -> DataFrame:
    """The first ``n`` impact alerts, with the volatility alert in front when VIX is above 24."""
    a = impact_actions(signals, market, group, order, on=on)
    a = with_market(a, market, on, "m")
    spike = F.when(F.col("m.vix") > 24, F.array(F.concat(F.lit("volatility_vix:"), F.format_string("%.1f", F.col("m.vix")))))
    return a.select(group, "severity", "confidence",
                    F.concat(F.coalesce(spike, F.array().cast("array<string>")), F.slice("alerts", 1, n)).alias("alerts"))
