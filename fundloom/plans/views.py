"""Stand-in views: the library's tables (leads, users, NAV, holdings, signals ...) built from the driver tables.

Each view exists twice, as a DataFrame builder and as SQL for the oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .registry import Tables

VIEW_SQL: dict[str, str] = {}
PARENTS: dict[str, list[str]] = {}


def needs(names: list[str]) -> list[str]:
    """The views and the views they build on, in order of definition."""
    out: list[str] = []
    for n in names:
        for p in [*needs(PARENTS.get(n, [])), n]:
            if p not in out:
                out.append(p)
    return out


def view(name: str, sql: str, parents: str = ""):
    VIEW_SQL[name] = sql
    PARENTS[name] = parents.split()
    return lambda fn: fn


@view("leads", """
SELECT CAST(c_custkey AS VARCHAR) AS lead_id, c_custkey, c_name AS name, n_name AS city, 'occ_' || (c_custkey % 7) AS occupation,
       c_mktsegment AS lead_source, 'sector_' || (c_nationkey % 6) AS industry, 'origin_' || (c_custkey % 3) AS lead_origin,
       r_name AS country, CASE c_custkey % 5 WHEN 0 THEN 'High' WHEN 1 THEN 'Low' WHEN 2 THEN 'Might be' ELSE NULL END AS lead_quality,
       coalesce(n, 0) AS total_visits,
       CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE round(coalesce(s, 0) / 1000, 5) END AS time_spent,
       round(a / 100000, 10) AS page_views,
       round((c_acctbal + 1000) / 11000, 6) AS conversion_probability,
       CASE WHEN (c_acctbal + 1000) / 11000 >= 0.5 THEN 1 ELSE 0 END AS converted,
       CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE CAST(c_custkey % 20 AS DOUBLE) END AS activity,
       CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE CAST(c_custkey % 17 AS DOUBLE) END AS profile,
       CASE c_custkey % 4 WHEN 0 THEN 'Contacted' WHEN 1 THEN 'Qualified' WHEN 2 THEN 'New' ELSE NULL END AS status,
       CASE c_custkey % 5 WHEN 0 THEN '₹' || (c_custkey % 90) || 'L' WHEN 1 THEN (c_custkey % 9) || '.5 Cr'
            WHEN 2 THEN (c_custkey % 90) || 'k' WHEN 3 THEN CAST(c_custkey AS VARCHAR) ELSE '' END AS potential_investment
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
LEFT JOIN (SELECT o_custkey, count(*) AS n, sum(o_totalprice) AS s, avg(o_totalprice) AS a FROM orders GROUP BY o_custkey) o
  ON o_custkey = c_custkey""")
def leads(t: Tables) -> DataFrame:
    per = t.orders.groupBy("o_custkey").agg(F.count("*").alias("n"), F.sum("o_totalprice").alias("s"), F.avg("o_totalprice").alias("a"))
    k, mod = F.col("c_custkey"), lambda m: F.col("c_custkey") % m
    prob = (F.col("c_acctbal") + 1000) / 11000
    base = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(
        t.region, F.col("n_regionkey") == F.col("r_regionkey")).join(per, F.col("o_custkey") == k, "left")
    return base.select(
        k.cast("string").alias("lead_id"), "c_custkey", F.col("c_name").alias("name"), F.col("n_name").alias("city"),
        F.concat(F.lit("occ_"), mod(7).cast("string")).alias("occupation"), F.col("c_mktsegment").alias("lead_source"),
        F.concat(F.lit("sector_"), (F.col("c_nationkey") % 6).cast("string")).alias("industry"),
        F.concat(F.lit("origin_"), mod(3).cast("string")).alias("lead_origin"), F.col("r_name").alias("country"),
        F.when(mod(5) == 0, "High").when(mod(5) == 1, "Low").when(mod(5) == 2, "Might be").alias("lead_quality"),
        F.coalesce("n", F.lit(0)).alias("total_visits"),
        F.when(mod(11) != 0, F.round(F.coalesce("s", F.lit(0.0)) / 1000, 5)).alias("time_spent"),
        F.round(F.col("a") / 100000, 10).alias("page_views"), F.round(prob, 6).alias("conversion_probability"),
        (prob >= 0.5).cast("int").alias("converted"), F.when(mod(5) != 0, mod(20).cast("double")).alias("activity"),
        F.when(mod(13) != 0, mod(17).cast("double")).alias("profile"),
        F.when(mod(4) == 0, "Contacted").when(mod(4) == 1, "Qualified").when(mod(4) == 2, "New").alias("status"),
        F.when(mod(5) == 0, F.concat(F.lit("₹"), mod(90).cast("string"), F.lit("L")))
        .when(mod(5) == 1, F.concat(mod(9).cast("string"), F.lit(".5 Cr"))).when(mod(5) == 2, F.concat(mod(90).cast("string"), F.lit("k")))
        .when(mod(5) == 3, k.cast("string")).otherwise("").alias("potential_investment"))


@view("users", """
SELECT c_custkey AS id, 20 + c_custkey % 60 AS current_age,
       CASE WHEN c_custkey % 13 = 0 THEN '$0' ELSE '$' || format('{:,}', CAST(floor(abs(c_acctbal) * 10) AS BIGINT)) END AS yearly_income,
       '$' || (c_custkey % 500 * 100) AS total_debt, 600 + c_custkey % 250 AS credit_score FROM customer""")
def users(t: Tables) -> DataFrame:
    k = F.col("c_custkey")
    return t.customer.select(
        k.alias("id"), (20 + k % 60).alias("current_age"),
        F.when(k % 13 == 0, F.lit("$0")).otherwise(F.concat(F.lit("$"), F.format_number(F.floor(F.abs("c_acctbal") * 10), 0))).alias("yearly_income"),
        F.concat(F.lit("$"), (k % 500 * 100).cast("string")).alias("total_debt"), (600 + k % 250).alias("credit_score"))


@view("txns", "SELECT o_custkey AS client_id, '$' || CAST(o_totalprice AS VARCHAR) AS amount FROM orders")
def txns(t: Tables) -> DataFrame:
    return t.orders.select(F.col("o_custkey").alias("client_id"), F.concat(F.lit("$"), F.col("o_totalprice").cast("string")).alias("amount"))


@view("pairs", """
SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS "user", p_brand || '/' || p_type AS item
FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey WHERE l_extendedprice > 0""")
def interactions(t: Tables) -> DataFrame:
    return t.orders.join(t.lineitem, F.col("l_orderkey") == F.col("o_orderkey")).join(t.part, F.col("p_partkey") == F.col("l_partkey")).select(
        F.col("o_custkey").alias("user"), F.concat_ws("/", "p_brand", "p_type").alias("item"), F.col("l_extendedprice").alias("amount"))


FUND_CATEGORY = {"ECONOMY": "Liquid Fund", "LARGE": "Index Fund", "MEDIUM": "Hybrid Fund", "PROMO": "Mid Cap Fund", "SMALL": "Small Cap Fund"}


@view("schemes", """
SELECT p_partkey AS scheme_code, p_name || ' ' || (p_partkey % 7) AS scheme_name, p_brand AS amc,
       CASE p_type WHEN 'ECONOMY' THEN 'Liquid Fund' WHEN 'LARGE' THEN 'Index Fund' WHEN 'MEDIUM' THEN 'Hybrid Fund'
            WHEN 'PROMO' THEN 'Mid Cap Fund' WHEN 'SMALL' THEN 'Small Cap Fund' ELSE 'Other' END AS scheme_category,
       CAST(p_retailprice AS VARCHAR) AS nav,
       CASE WHEN p_partkey % 10 = 0 THEN '-' ELSE CAST(coalesce(cnt, 0) * 150 AS VARCHAR) END AS average_aum_cr,
       CASE WHEN p_partkey % 9 = 0 THEN NULL ELSE (1990 + p_partkey % 30) || '-01-01' END AS launch_date,
       'Rs. ' || (p_partkey % 50) || ',000 min' AS scheme_min_amt
FROM part LEFT JOIN (SELECT l_partkey, count(*) AS cnt FROM lineitem GROUP BY l_partkey) ON l_partkey = p_partkey""")
def schemes(t: Tables) -> DataFrame:
    k = F.col("p_partkey")
    cat = F
    for name, value in FUND_CATEGORY.items():
        cat = cat.when(F.col("p_type") == name, F.lit(value))
    used = t.lineitem.groupBy("l_partkey").agg(F.count("*").alias("cnt"))
    return t.part.join(used, F.col("l_partkey") == k, "left").select(
        k.alias("scheme_code"), F.concat_ws(" ", "p_name", (k % 7).cast("string")).alias("scheme_name"), F.col("p_brand").alias("amc"),
        cat.otherwise("Other").alias("scheme_category"), F.col("p_retailprice").cast("string").alias("nav"),
        F.when(k % 10 == 0, F.lit("-")).otherwise((F.coalesce("cnt", F.lit(0)) * 150).cast("string")).alias("average_aum_cr"),
        F.when(k % 9 != 0, F.concat((1990 + k % 30).cast("string"), F.lit("-01-01"))).alias("launch_date"),
        F.concat(F.lit("Rs. "), (k % 50).cast("string"), F.lit(",000 min")).alias("scheme_min_amt"))


@view("catalog", """
SELECT scheme_code, scheme_name, amc, scheme_category AS category, g AS category_group, nav, aum, min_investment, launch_year,
       CASE g WHEN 'conservative' THEN 'low' WHEN 'growth' THEN 'high' ELSE 'medium' END AS risk,
       least(greatest(CASE g WHEN 'growth' THEN 5 ELSE 4 END + CASE WHEN aum >= 5000 THEN 1 ELSE 0 END, 3), 5) AS rating,
       round_even(CASE g WHEN 'conservative' THEN 6.6 WHEN 'passive' THEN 11.8 WHEN 'balanced' THEN 15.4 ELSE 24.8 END + b + nb * 0.15, 1) AS r1,
       round_even(CASE g WHEN 'conservative' THEN 6.2 WHEN 'passive' THEN 13.2 WHEN 'balanced' THEN 14.3 ELSE 19.5 END + b * 0.8 + nb * 0.12, 1) AS r3,
       round_even(CASE g WHEN 'conservative' THEN 5.8 WHEN 'passive' THEN 12.6 WHEN 'balanced' THEN 13.5 ELSE 17.2 END + b * 0.6 + nb * 0.1, 1) AS r5,
       CASE WHEN g IN ('balanced', 'passive') THEN 0.45::DOUBLE ELSE 0.55::DOUBLE END AS match_score,
       scheme_name || ' from ' || coalesce(trim(amc), 'the AMC') || ' · launched ' || coalesce(CAST(launch_year AS VARCHAR), 'unknown') AS description
FROM (SELECT *, CASE WHEN aum >= 1000 THEN 0.5::DOUBLE ELSE 0::DOUBLE END AS b, least(greatest(nav / 1000, 0), 2) AS nb FROM (
  SELECT scheme_code, scheme_name, amc, scheme_category, CAST(nav AS DOUBLE) AS nav,
         CASE WHEN average_aum_cr = '-' THEN 0 ELSE CAST(average_aum_cr AS DOUBLE) END AS aum,
         CAST(regexp_extract(replace(scheme_min_amt, ',', ''), '[0-9.]+', 0) AS VARCHAR) AS amt,
         coalesce(TRY_CAST(regexp_extract(replace(scheme_min_amt, ',', ''), '[0-9.]+', 0) AS DOUBLE), 0) AS min_investment,
         CAST(substr(launch_date, 1, 4) AS INTEGER) AS launch_year,
         CASE WHEN regexp_matches(lower(scheme_category), 'liquid|overnight|money market|short duration|ultra short|corporate bond|gilt') THEN 'conservative'
              WHEN regexp_matches(lower(scheme_category), 'index|nifty|etf|passive') THEN 'passive'
              WHEN regexp_matches(lower(scheme_category), 'balanced|hybrid|multi asset|dynamic asset') THEN 'balanced'
              WHEN regexp_matches(lower(scheme_category), 'mid cap|small cap|sectoral|thematic|flexi|large & mid') THEN 'growth'
              ELSE 'balanced' END AS g,
         row_number() OVER (PARTITION BY scheme_name ORDER BY scheme_code) AS rn FROM schemes) WHERE rn = 1)""", "schemes")
def catalog(t: Tables) -> DataFrame:
    from ..operators.recommend import build_fund_catalog
    return build_fund_catalog(schemes(t), ["scheme_code"])


@view("nav", """
SELECT l_suppkey AS scheme, CAST(l_shipdate AS DATE) AS date, max(sqrt(l_extendedprice / l_quantity)) AS nav
FROM lineitem GROUP BY 1, 2""")
def nav(t: Tables, deal=lambda df, key, date: df) -> DataFrame:
    """``deal`` may spread the raw rows by scheme before they are grouped, so that no other shuffle is needed."""
    raw = t.lineitem.select(F.col("l_suppkey").alias("scheme"), F.to_date("l_shipdate").alias("date"), "l_extendedprice", "l_quantity")
    return deal(raw, "scheme", "date").groupBy("scheme", "date").agg(F.max(F.sqrt(F.col("l_extendedprice") / F.col("l_quantity"))).alias("nav"))


@view("bench", "SELECT CAST(l_shipdate AS DATE) AS date, max(sqrt(l_extendedprice / l_quantity)) AS close FROM lineitem GROUP BY 1")
def bench(t: Tables) -> DataFrame:
    return t.lineitem.groupBy(F.to_date("l_shipdate").alias("date")).agg(
        F.max(F.sqrt(F.col("l_extendedprice") / F.col("l_quantity"))).alias("close"))


@view("holdings", """
SELECT o_custkey AS portfolio, l_partkey AS fund_id, p_name AS fund_name,
       CASE p_type WHEN 'ECONOMY' THEN 'debt' WHEN 'LARGE' THEN 'index' WHEN 'MEDIUM' THEN 'hybrid' WHEN 'PROMO' THEN 'mid_cap'
            WHEN 'SMALL' THEN 'small_cap' ELSE CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE 'equity' END END AS category,
       CASE WHEN p_partkey % 6 = 0 THEN NULL ELSE p_brand END AS sector, l_extendedprice AS value,
       round(100 * (l_discount + 0.0), 4) AS returns, round(l_extendedprice * (l_discount + 0.0), 4) AS gain,
       CASE o_custkey % 4 WHEN 0 THEN 'growth' WHEN 1 THEN 'conservative' WHEN 2 THEN 'balanced' ELSE 'passive' END AS persona
FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey""")
def holdings(t: Tables) -> DataFrame:
    cat = F
    for name, value in {"ECONOMY": "debt", "LARGE": "index", "MEDIUM": "hybrid", "PROMO": "mid_cap", "SMALL": "small_cap"}.items():
        cat = cat.when(F.col("p_type") == name, F.lit(value))
    k, p = F.col("o_custkey"), F.col("p_partkey")
    disc = F.col("l_discount") + 0.0
    return t.orders.join(t.lineitem, F.col("l_orderkey") == F.col("o_orderkey")).join(t.part, p == F.col("l_partkey")).select(
        k.alias("portfolio"), F.col("l_partkey").alias("fund_id"), F.col("p_name").alias("fund_name"),
        cat.otherwise(F.when(p % 3 != 0, F.lit("equity"))).alias("category"), F.when(p % 6 != 0, F.col("p_brand")).alias("sector"),
        F.col("l_extendedprice").alias("value"), F.round(disc * 100, 4).alias("returns"),
        F.round(F.col("l_extendedprice") * disc, 4).alias("gain"),
        F.when(k % 4 == 0, "growth").when(k % 4 == 1, "conservative").when(k % 4 == 2, "balanced").otherwise("passive").alias("persona"))


@view("market", """
SELECT snap, ts, vix, change_pct, CASE WHEN abs(change_pct) > 1.5 OR vix > 25 THEN 'VOLATILE' ELSE 'OPEN' END AS market_status,
       CASE WHEN change_pct > 1 THEN 'bullish' WHEN change_pct < -1 THEN 'bearish' ELSE 'neutral' END AS sentiment, volume_spike
FROM (SELECT event_id AS snap, ts, (event_id * 7 % 250) / 10.0::DOUBLE + 10 + (event_id % 97 + 1) / 10007.0::DOUBLE AS vix,
             (event_id * 13 % 81 - 40) / 10.0::DOUBLE + (event_id % 89 + 1) / 10007.0::DOUBLE AS change_pct, event_type = 'error' AS volume_spike FROM events)""")
def market(t: Tables) -> DataFrame:
    from ..functions.rules import is_volatile, market_sentiment
    e = F.col("event_id")
    out = t.events.select(e.alias("snap"), "ts", ((e * 7 % 250) / 10.0 + 10 + (e % 97 + 1) / 10007.0).alias("vix"), ((e * 13 % 81 - 40) / 10.0 + (e % 89 + 1) / 10007.0).alias("change_pct"),
                          (F.col("event_type") == "error").alias("volume_spike"))
    return out.withColumn("market_status", F.when(is_volatile("change_pct", "vix"), "VOLATILE").otherwise("OPEN")).withColumn(
        "sentiment", market_sentiment("change_pct"))


@view("pmarket", """
SELECT c_custkey AS portfolio, vix, change_pct, market_status, sentiment, volume_spike FROM customer JOIN market ON snap = c_custkey""", "market")
def portfolio_market(t: Tables) -> DataFrame:
    """A snapshot for every portfolio, so all market states are covered."""
    m = market(t)
    return t.customer.join(m, F.col("snap") == F.col("c_custkey")).select(
        F.col("c_custkey").alias("portfolio"), "vix", "change_pct", "market_status", "sentiment", "volume_spike")


@view("signals", """
SELECT event_id, ts, user_id, 'signal ' || (event_id % 50) || ' of ' || (event_id // 100) AS title, event_type AS source,
       CASE WHEN event_type IN ('purchase', 'signup') THEN 'positive' WHEN event_type = 'error' THEN 'negative' ELSE 'neutral' END AS sentiment,
       CASE event_id % 5 WHEN 0 THEN 'bearish' WHEN 1 THEN 'bullish' ELSE NULL END AS market_impact,
       CASE WHEN event_id % 7 = 0 THEN 'n/a' ELSE CAST(event_id % 100 AS VARCHAR) END AS conf_text,
       CASE WHEN event_id % 7 = 0 THEN 0.5::DOUBLE ELSE (event_id % 100) / 97.0::DOUBLE END AS confidence, props FROM events""")
def signals(t: Tables) -> DataFrame:
    e, kind = F.col("event_id"), F.col("event_type")
    return t.events.select(
        "event_id", "ts", "user_id", F.concat(F.lit("signal "), (e % 50).cast("string"), F.lit(" of "), F.floor(e / 100).cast("string")).alias("title"),
        kind.alias("source"), F.when(kind.isin("purchase", "signup"), "positive").when(kind == "error", "negative").otherwise("neutral").alias("sentiment"),
        F.when(e % 5 == 0, "bearish").when(e % 5 == 1, "bullish").alias("market_impact"),
        F.when(e % 7 == 0, F.lit("n/a")).otherwise((e % 100).cast("string")).alias("conf_text"),
        F.when(e % 7 == 0, 0.5).otherwise((e % 100) / 97.0).alias("confidence"), "props")


HEADLINES = [
    "RBI holds repo as GDP growth stays strong", "Crude oil spike lifts diesel and petrol", "Inflation fears grow, bond yield up",
    "Tech earnings beat on software demand", "Markets quiet at the", "rate", "hike expected by banks", "China steel and aluminum surge",
    "Rural consumption weak, FMCG slowdown", "Mid cap broadening on domestic growth",
]


@view("desk", f"""
SELECT event_id, user_id % 200 AS desk, ts, list_extract([{", ".join(f"'{h}'" for h in HEADLINES)}], CAST(event_id * 31 % {len(HEADLINES)} + 1 AS BIGINT)) AS title,
       event_type AS category FROM events""")
def desk(t: Tables) -> DataFrame:
    """Headlines per desk, for impact analysis."""
    return t.events.select("event_id", (F.col("user_id") % 200).alias("desk"), "ts", F.element_at(
        F.array(*[F.lit(h) for h in HEADLINES]), (F.col("event_id") * 31 % len(HEADLINES) + 1).cast("int")).alias("title"), F.col("event_type").alias("category"))


@view("dmarket", "SELECT desk, vix, sentiment FROM (SELECT DISTINCT user_id % 200 AS desk FROM events) JOIN market ON snap = desk", "market")
def desk_market(t: Tables) -> DataFrame:
    d = t.events.select((F.col("user_id") % 200).alias("desk")).distinct()
    return d.join(market(t), F.col("snap") == F.col("desk")).select("desk", "vix", "sentiment")


@view("traits", """
SELECT c_custkey AS investor_id, CAST(c_custkey % 7 + 1 AS DOUBLE) AS ProfManage, CAST(c_nationkey % 7 + 1 AS DOUBLE) AS Diversification,
       round((c_acctbal + 1000) / 1571.5, 4) AS Affordability, CAST(coalesce(n, 0) % 8 AS DOUBLE) AS Liquidity,
       CAST(c_custkey * 3 % 8 AS DOUBLE) AS Growth, CAST(c_custkey * 5 % 9 AS DOUBLE) AS Trustworthiness,
       CASE WHEN c_custkey % 29 = 0 THEN NULL ELSE round(a / 60000, 9) END AS Technology
FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n, avg(o_totalprice) AS a FROM orders GROUP BY 1) ON o_custkey = c_custkey""")
def traits(t: Tables) -> DataFrame:
    per = t.orders.groupBy("o_custkey").agg(F.count("*").alias("n"), F.avg("o_totalprice").alias("a"))
    k = F.col("c_custkey")
    return t.customer.join(per, F.col("o_custkey") == k, "left").select(
        k.alias("investor_id"), (k % 7 + 1).cast("double").alias("ProfManage"), (F.col("c_nationkey") % 7 + 1).cast("double").alias("Diversification"),
        F.round((F.col("c_acctbal") + 1000) / 1571.5, 4).alias("Affordability"), (F.coalesce("n", F.lit(0)) % 8).cast("double").alias("Liquidity"),
        (k * 3 % 8).cast("double").alias("Growth"), (k * 5 % 9).cast("double").alias("Trustworthiness"),
        F.when(k % 29 != 0, F.round(F.col("a") / 60000, 9)).alias("Technology"))


@view("chat", "SELECT conv_id, turn, text FROM conversations WHERE role = 'user'")
def chat(t: Tables) -> DataFrame:
    return t.conversations.filter("role = 'user'").select("conv_id", "turn", "text")


@view("answers", """
SELECT l_orderkey AS investor_id, list_extract(['growth', 'conservative', 'balanced', 'passive', 'unsure'], CAST((l_partkey + l_linenumber) % 5 + 1 AS BIGINT)) AS answer,
       CASE WHEN l_partkey % 6 = 0 THEN NULL ELSE CAST(l_suppkey % 5 + 1 AS DOUBLE) END AS value FROM lineitem""")
def answers(t: Tables) -> DataFrame:
    return t.lineitem.select(
        F.col("l_orderkey").alias("investor_id"),
        F.element_at(F.array(*[F.lit(v) for v in ("growth", "conservative", "balanced", "passive", "unsure")]),
                     ((F.col("l_partkey") + F.col("l_linenumber")) % 5 + 1).cast("int")).alias("answer"),
        F.when(F.col("l_partkey") % 6 != 0, (F.col("l_suppkey") % 5 + 1).cast("double")).alias("value"))


@view("lead_events", """
SELECT CASE WHEN event_id % 17 = 0 THEN NULL ELSE CAST(event_id AS VARCHAR) END AS lead_id, 'city_' || (user_id % 20) AS "City",
       event_type AS "Occupation", CASE WHEN event_id % 23 = 0 THEN NULL ELSE CAST(event_id % 7 - 1 AS DOUBLE) END AS total_visits,
       (event_id % 101) / 100.0::DOUBLE - 0.01 AS "Conversion_Probability", strftime(ts, '%Y-%m-%d %H:%M:%S') AS "timestamp" FROM events""")
def lead_events(t: Tables) -> DataFrame:
    e = F.col("event_id")
    return t.events.select(
        F.when(e % 17 != 0, e.cast("string")).alias("lead_id"), F.concat(F.lit("city_"), (F.col("user_id") % 20).cast("string")).alias("City"),
        F.col("event_type").alias("Occupation"), F.when(e % 23 != 0, (e % 7 - 1).cast("double")).alias("total_visits"),
        ((e % 101) / 100.0 - 0.01).alias("Conversion_Probability"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("timestamp"))
