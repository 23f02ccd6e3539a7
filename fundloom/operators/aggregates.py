"""Group and whole-table aggregates, histograms, pivots."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame, functions as F

from ..functions.rules import lead_tier
from ..functions.scalars import clean_currency, default, parse_investment_amount, round_even, safe_div, to_number
from .ordered import exact_quantiles
from .quality import numeric_columns


def client_spend(txns: DataFrame, key: str = "client_id", amount: str = "amount") -> DataFrame:
    return txns.filter(F.col(key).isNotNull()).groupBy(key).agg(
        F.sum(clean_currency(amount)).alias("behavior_spend_sum"),
        F.count(clean_currency(amount)).alias("behavior_spend_count"),
    )


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Count and share per non-null value."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count("*").alias("count"))
    whole = df.agg(F.count(col).alias("n")).scalar()
    return counts.withColumn("share", F.col("count") / whole)


def class_rate(df: DataFrame, label: str) -> DataFrame:
    return df.agg(F.count(label).alias("rows"), F.avg(F.col(label).cast("double")).alias("rate"))


def interaction_pairs(txns: DataFrame, user="user", item="item", amount="amount") -> DataFrame:
    """Distinct (user, item) with a positive total of the positive amounts; ids as text."""
    return (
        txns.withColumn(amount, to_number(amount, 0)).filter(F.col(amount) > 0)
        .groupBy(F.col(user).cast("string").alias("user"), F.col(item).cast("string").alias("item"))
        .agg(F.sum(amount).alias("_s")).filter("_s > 0").drop("_s")
    )


def pivot_interactions(pairs: DataFrame, items: list[str]) -> DataFrame:
    """0/1 matrix over a given small list of items.

    A user's row is aggregated as one bit per item, not as one value per item, and spread out afterwards.
    """
    slot = F.element_at(F.create_map(*[F.lit(x) for i, name in enumerate(items) for x in (name, i)]), F.col("item")) if items else F.lit(None).cast("int")
    words = (len(items) + 62) // 63
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("_slot") % 63)
    bits = [F.bit_or(F.when((F.col("_slot") >= 63 * w) & (F.col("_slot") < 63 * (w + 1)), bit)).alias(f"_w{w}") for w in range(words)]
    held = pairs.select("user", slot.alias("_slot")).groupBy("user")
    out = held.agg(*bits) if bits else pairs.select("user").distinct()
    return out.select("user", *[F.coalesce(F.getbit(F.col(f"_w{i // 63}"), F.lit(i % 63)).cast("int"), F.lit(0)).alias(name) for i, name in enumerate(items)])


def melt(df: DataFrame, ids: list[str], var: str = "year", value: str = "value") -> DataFrame:
    return df.unpivot(ids, [c for c in df.columns if c not in ids], var, value)


def pivot_indicators(long: DataFrame, names: list[str], index="year", series="series", value="value") -> DataFrame:
    return long.groupBy(index).pivot(series, names).agg(F.first(value))


def macro_tidy(wide: DataFrame, series: str, rename: dict[str, str]) -> DataFrame:
    """``YRnnnn`` columns to one row per year and one column per indicator."""
    long = melt(wide, [series]).withColumn("year", F.regexp_replace("year", "^YR", "").cast("int"))
    out = pivot_indicators(long, list(rename), series=series)
    return out.select("year", *[F.col(f"`{k}`").alias(v) for k, v in rename.items()])


def lead_overview(leads: DataFrame) -> DataFrame:
    prob = F.coalesce(F.col("conversion_probability"), F.lit(0.5))
    return leads.agg(
        F.count("*").alias("total_leads"), F.count_if(prob > 0.85).alias("hot_prospects"),
        F.round(F.coalesce(F.avg(prob), F.lit(0.0)), 4).alias("mean_conversion_probability"),
        F.coalesce(F.sum(parse_investment_amount("potential_investment")), F.lit(0.0)).alias("_value"),
        F.coalesce(F.avg(prob), F.lit(0.0)).alias("_mean"),
    ).select(
        "total_leads", "hot_prospects", "mean_conversion_probability",
        F.concat(F.bround(F.col("_mean") * 100, 0).cast("int").cast("string"), F.lit("%")).alias("conversion_rate"),
        F.round("_value", 2).alias("pipeline_value"),
    )


def recent_activity(leads: DataFrame, n: int = 5) -> DataFrame:
    """What happened to the best leads: their workflow state, or their score while still new."""
    prob = F.coalesce(F.col("conversion_probability"), F.lit(0.0))
    status = default("status", "New")
    pct = F.bround(F.coalesce(F.col("conversion_probability"), F.lit(0.5)) * 100, 0).cast("int").cast("string")
    text = F.when(status != "New", F.concat(F.lit("Lead state set to "), status)).otherwise(
        F.concat(F.lit("AI scored conversion at "), pct, F.lit("%")))
    return (
        leads.select("lead_id", default("name", "Unknown Lead").alias("name"), text.alias("activity"), prob.alias("_p"))
        .orderBy(F.desc("_p"), "lead_id").limit(n).drop("_p")
    )


def tier_summary(leads: DataFrame, prob: str = "conversion_probability") -> DataFrame:
    tier = lead_tier(prob)
    return leads.agg(
        F.count("*").alias("total"), F.lit(len(leads.columns)).alias("n_columns"),
        F.round(F.avg(prob), 4).alias("mean_probability"),
        *[F.count_if(tier == t).alias(t) for t in ("hot", "warm", "cold")],
    )


def tier_table(leads: DataFrame, prob: str = "conversion_probability") -> DataFrame:
    return leads.groupBy(lead_tier(prob).alias("tier")).agg(
        F.count("*").alias("leads"), F.round(F.avg(prob), 4).alias("mean_probability"))


def cluster_profiles(df: DataFrame, cluster: str, cols: list[str] | None = None) -> DataFrame:
    """Size, share in percent and mean of each numeric column per cluster."""
    cols = cols or [c for c in numeric_columns(df) if c != cluster]
    n = df.agg(F.count(cluster).alias("n")).scalar()
    return (
        df.filter(F.col(cluster).isNotNull()).groupBy(cluster)
        .agg(F.count("*").alias("size"), *[F.avg(c).alias(f"mean_{c}") for c in cols])
        .withColumn("pct_of_total", F.col("size") * 100.0 / n)
    )


def target_means(df: DataFrame, cat: str, label: str) -> DataFrame:
    return df.filter(F.col(cat).isNotNull()).groupBy(cat).agg(F.avg(F.col(label).cast("double")).alias("target_mean"))


def corr_matrix(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Pearson correlation of every pair, each over the rows where both are present, in one scan."""
    cols = cols or numeric_columns(df)
    pairs = list(combinations(cols, 2))
    one = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"c{i}")
                   for i, (a, b) in enumerate(pairs)], *[
        F.when(F.count(c) > 0, F.lit(1.0)).alias(f"d{i}") for i, c in enumerate(cols)])
    rows = [F.struct(F.lit(x).alias("a"), F.lit(y).alias("b"), F.col(f"c{i}").alias("corr"))
            for i, (a, b) in enumerate(pairs) for x, y in ((a, b), (b, a))]
    rows += [F.struct(F.lit(c).alias("a"), F.lit(c).alias("b"), F.col(f"d{i}").alias("corr"))
             for i, c in enumerate(cols)]
    return one.select(F.inline(F.array(*rows)))


def global_bounds(nav: DataFrame, col: str = "nav") -> DataFrame:
    v = to_number(col)
    return nav.agg(F.min(v).alias("min_value"), F.max(v).alias("max_value"))


def vocabulary_size(docs: DataFrame, text_col: str) -> DataFrame:
    """Exact number of distinct whitespace-separated tokens: distinct first, so no task holds the vocabulary."""
    words = docs.select(F.explode(F.split(default(text_col, ""), r"\s+")).alias("w")).filter("w <> ''")
    return words.groupBy("w").count().agg(F.count("*").alias("vocabulary"), F.coalesce(F.sum("count"), F.lit(0)).alias("tokens"))


def popular_items(pairs: DataFrame, k: int) -> DataFrame:
    return pairs.groupBy("item").agg(F.count("*").cast("double").alias("score")).orderBy(F.desc("score"), "item").limit(k)


def fallback_sector(name) -> F.Column:
    """Sector guessed from the fund name."""
    n = F.lower(default(name, ""))
    return (
        F.when(n.contains("liquid") | n.contains("debt"), "Treasury & Debt")
        .when(n.contains("nifty") | n.contains("index"), "Multi-Sector Index")
        .when(n.contains("magnum") | n.contains("midcap"), "Financials & Auto").otherwise("Technology & Energy")
    )


def sector_concentration(holdings: DataFrame, key: str = "portfolio") -> DataFrame:
    """Largest sector's share of a portfolio in percent, and whether it is more than half."""
    sector = F.coalesce(F.nullif(F.col("sector"), F.lit("")), fallback_sector("fund_name"))
    by_sector = holdings.groupBy(key, sector.alias("sector")).agg(F.sum("value").alias("v"))
    return by_sector.groupBy(key).agg(
        round_even(F.coalesce(safe_div(F.max("v") * 100, F.sum("v")), F.lit(0.0)), 1).alias("sector_concentration_pct"),
        F.coalesce(safe_div(F.max("v"), F.sum("v")) > 0.5, F.lit(False)).alias("concentrated"),
    )


def fund_overlap(holdings: DataFrame, key: str = "portfolio") -> DataFrame:
    cats = holdings.groupBy(key, F.lower(default("category", "")).alias("c")).agg(F.count("*").alias("n"))
    n, d = F.sum("n"), F.count("*")
    return cats.groupBy(key).agg(
        F.when(n > 1, round_even((1 - d / n) * 100, 1)).otherwise(0.0).alias("fund_overlap_pct"))


def portfolio_totals(holdings: DataFrame, key: str = "portfolio", value="value", gain="gain") -> DataFrame:
    inv, g = F.sum(value), F.sum(gain)
    return holdings.groupBy(key).agg(
        inv.alias("invested"), (inv + g).alias("current_value"), g.alias("gain"),
        F.coalesce(safe_div(g * 100, inv), F.lit(0.0)).alias("gain_pct"))


def units_value(units: DataFrame, navs: DataFrame, key="portfolio", fund="fund_id") -> DataFrame:
    """Units times NAV per portfolio; funds without a NAV are left out."""
    return units.join(navs, fund).groupBy(key).agg(F.sum(F.col("units") * F.col("nav")).alias("portfolio_value"))


def histogram(df: DataFrame, col: str, bins: int = 10) -> DataFrame:
    """Counts in equal-width bins, the last one closed on both sides; empty bins included."""
    span = df.agg(F.struct(F.min(col).cast("double").alias("lo"), F.max(col).cast("double").alias("hi")).alias("s"))
    width = (F.col("_s.hi") - F.col("_s.lo")) / bins
    slot = F.least(F.coalesce(F.floor(F.try_divide(F.col(col) - F.col("_s.lo"), width)), F.lit(0)), F.lit(bins - 1))
    counts = df.filter(F.col(col).isNotNull()).withColumn("_s", span.scalar()).groupBy(slot.cast("int").alias("bin")).count()
    grid = span.select(F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"), F.col("s").alias("_s"))
    return grid.join(counts, "bin", "left").select(
        "bin", (F.col("_s.lo") + F.col("bin") * width).alias("low"), (F.col("_s.lo") + (F.col("bin") + 1) * width).alias("high"),
        F.coalesce("count", F.lit(0)).alias("count"))


def box_stats(df: DataFrame, cols: list[str]) -> DataFrame:
    q = exact_quantiles(df, cols, [0.0, 0.25, 0.5, 0.75, 1.0])
    names = {0.0: "low", 0.25: "q1", 0.5: "median", 0.75: "q3", 1.0: "high"}
    return q.groupBy("column").agg(*[F.max(F.when(F.col("prob") == p, F.col("value"))).alias(n) for p, n in names.items()])


def equal_width_cut(df: DataFrame, col: str, k: int, name: str = "bin") -> DataFrame:
    """Right-closed equal-width bins over the observed range, the lowest value included in bin 0."""
    span = df.agg(F.struct(F.min(col).cast("double").alias("lo"), F.max(col).cast("double").alias("hi")).alias("s"))
    pos = F.try_divide(F.col(col) - F.col("_s.lo"), (F.col("_s.hi") - F.col("_s.lo")) / k)
    out = df.withColumn("_s", span.scalar())
    return out.withColumn(name, F.when(F.col(col).isNotNull(), F.least(F.greatest(
        F.ceil(F.coalesce(pos, F.lit(0.0))) - 1, F.lit(0)), F.lit(k - 1)).cast("int"))).drop("_s")


def nav_summary(nav: DataFrame, key="scheme", date="date") -> DataFrame:
    per = nav.groupBy(key).agg(F.count("*").alias("n"), F.min(date).alias("first"), F.max(date).alias("last"))
    return per.agg(F.count("*").alias("schemes"), F.sum("n").alias("total_rows"), F.min("first").alias("first_date"),
                   F.max("last").alias("latest_date"))


def nav_coverage(nav: DataFrame, key="scheme", date="date") -> DataFrame:
    """Rows per scheme and the share of calendar days in its span that have one."""
    days = F.datediff(F.max(date), F.min(date)) + 1
    return nav.groupBy(key).agg(F.count("*").alias("n_rows"), F.min(date).alias("first_date"), F.max(date).alias("last_date"),
                                F.round(F.count("*") / days, 4).alias("coverage"))


def request_metrics(log: DataFrame, ts: str, last: int = 100) -> DataFrame:
    """Requests, errors, and the mean latency of the newest ``last`` requests."""
    recent = log.orderBy(F.desc(ts[0] if isinstance(ts, list) else ts), *(ts[1:] if isinstance(ts, list) else [])).limit(last)
    mean = recent.agg(F.avg("latency").alias("m")).scalar()
    return log.agg(F.count("*").alias("total_requests"), F.count_if(~F.col("success")).alias("errors")).withColumn(
        "average_latency", F.coalesce(mean, F.lit(0.0)))
