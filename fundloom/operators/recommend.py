"""Fund catalogue and profile-based recommendations."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import rules as R, words as W
from ..functions.scalars import contains_any, default, launch_year, parse_amount, to_float0, tokens
from .quality import dedupe
from .topk import topk


def build_fund_catalog(schemes: DataFrame, order: list[str]) -> DataFrame:
    """One row per scheme name (the first in ``order``) with its group, risk, rating, personas and return profile."""
    named = schemes.withColumn("scheme_name", F.trim(default("scheme_name", ""))).filter("scheme_name <> ''")
    group = R.fund_group("scheme_category")
    return (
        dedupe(named, ["scheme_name"], order)
        .withColumn("aum", to_float0("average_aum_cr")).withColumn("nav", to_float0("nav"))
        .withColumn("category_group", group)
        .select(
            "scheme_code", "scheme_name", "amc",
            F.coalesce(F.nullif(F.trim("scheme_category"), F.lit("")), F.initcap("category_group")).alias("category"),
            "category_group", "nav", "aum", parse_amount("scheme_min_amt").alias("min_investment"),
            launch_year("launch_date").alias("launch_year"), R.pick(W.GROUP_RISK, "category_group", "medium").alias("risk"),
            R.fund_rating("category_group", "aum").alias("rating"), F.array("category_group").alias("personas"),
            *[R.fund_return("category_group", "aum", "nav", y).alias(f"r{y}") for y in (1, 3, 5)],
            R.fund_match("category_group").alias("match_score"))
        .withColumn("description", F.concat("scheme_name", F.lit(" from "), F.coalesce(F.trim("amc"), F.lit("the AMC")), F.lit(" · launched "), F.coalesce(F.col("launch_year").cast("string"), F.lit("unknown"))))
    )


BEST = [F.desc, F.desc, F.asc]


def _persona_fits(persona):
    """Groups a persona may hold, or funds of its risk classes; an unknown persona may hold everything."""
    p = persona
    expr = F
    for name, groups in W.PERSONA_GROUPS.items():
        risks = ["low"] if name == "conservative" else ["medium", "high"]
        expr = expr.when(p == name, F.col("category_group").isin(groups) | F.col("risk").isin(risks))
    return expr.otherwise(F.lit(True))


def _name_text():
    return F.concat_ws("\n", F.lower("scheme_name"), F.lower("category"), F.lower("amc"))


def catalog_view(catalog: DataFrame, persona: str | None = None, query: str | None = None, k: int = 100) -> DataFrame:
    """Funds a persona may hold that mention any query word of three letters or more, best first."""
    if persona:
        catalog = catalog.filter(_persona_fits(F.lit(persona.lower().strip())))
    words = [w for w in "".join(c if c.isascii() and c.isalnum() else " " for c in (query or "").lower()).split() if len(w) > 2]
    if words:
        catalog = catalog.filter(contains_any(_name_text(), words))
    return catalog.orderBy(F.desc("match_score"), F.desc("aum"), "scheme_code").limit(k)


def recommend_funds(profiles: DataFrame, catalog: DataFrame, key: str = "investor_id", k: int = 5) -> DataFrame:
    """Top ``k`` funds for every profile (key, risk_profile, goals, horizon, market_sentiment) with an allocation.

    A fund mentions a word when the word is one of its substrings, so the match is an equi-join on substrings. Only the
    best ``k`` funds of a (persona, word) can be among a profile's best ``k``, so each word is cut to ``k`` before it
    meets the profiles.
    """
    text = F.concat_ws(" ", *[F.nullif(F.lower(F.col(c).cast("string")), F.lit(""))
                              for c in ("risk_profile", "goals", "horizon", "market_sentiment") if c in profiles.columns])
    query = F.coalesce(F.nullif(F.trim(text), F.lit("")), F.lit("mutual funds recommended"))
    asked = profiles.select(key, R.persona_of_risk_text("risk_profile").alias("persona"),
                            F.array_distinct(tokens(query, 3)).alias("words"))
    asked = asked.withColumn("word", F.explode(F.when(F.size("words") > 0, F.col("words")).otherwise(F.array(F.lit("")))))
    wanted = asked.select("persona", "word").distinct()
    lengths = wanted.agg(F.collect_set(F.length("word")).alias("l")).scalar()
    cut = catalog.withColumn("_t", _name_text()).withColumn("_l", lengths).withColumn("_n", F.explode("_l")).withColumn(
        "word", F.explode(F.array_distinct(F.transform(
            F.sequence(F.lit(1), F.greatest(F.length("_t") - F.col("_n") + 1, F.lit(1))),
            lambda i: F.substring(F.col("_t"), i, F.col("_n"))))))
    cut = cut.drop("_t", "_l", "_n").dropDuplicates(["scheme_code", "word"])
    best = [F.desc("match_score"), F.desc("aum"), F.col("scheme_code")]
    per_word = topk(cut.join(wanted, "word").filter(_persona_fits(F.col("persona"))), ["persona", "word"], best, k)
    mine = asked.drop("words").join(per_word, ["persona", "word"]).dropDuplicates([key, "scheme_code"])
    ranked = topk(mine, [key], best, k, rank="rank")
    return ranked.select(
        key, "persona", "rank", "scheme_code", "scheme_name", "category", "risk", "aum", F.round("match_score", 4).alias("match_score"),
        F.greatest(F.lit(8), F.least(F.lit(40), 24 - (F.col("rank") - 1) * 4)).alias("recommended_allocation_pct"))


def bear_adjusted(matches: DataFrame, sentiment: str = "market_sentiment", category: str = "category") -> DataFrame:
    """Semantic matches with equity funds marked down in a bearish market."""
    bear = F.lower(F.col(sentiment)).contains("bear") & F.lower(F.col(category)).contains("equity")
    return matches.withColumn("match_score", F.round(
        F.col("match_score") * F.when(F.coalesce(bear, F.lit(False)), 0.75).otherwise(1.0), 4))
