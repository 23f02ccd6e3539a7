"""Data quality, profiling and group aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregates as A, features as E, quality as Q, timeseries as TS, topk as K
from . import etl, views as V
from .registry import query

PROFILED = ["total_visits", "time_spent", "page_views", "activity", "profile", "status", "lead_quality"]


@query(" UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS nulls, round((count(*) - count({c})) * 100.0::DOUBLE / count(*), 4) AS pct FROM leads" for c in PROFILED), "leads")
def null_profile(t):
    return Q.null_profile(V.leads(t).select(*PROFILED))


@query("""SELECT CAST(sum(n) AS BIGINT) AS total_rows, CAST(sum(n - 1) AS BIGINT) AS duplicate_rows, count(*) AS unique_rows, round(sum(n - 1) * 100.0::DOUBLE / sum(n), 4) AS duplicate_pct
FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_suppkey, l_linenumber, l_returnflag)""")
def duplicate_stats(t):
    return Q.duplicate_stats(t.lineitem.select("l_suppkey", "l_linenumber", "l_returnflag"))


@query("""SELECT DISTINCT l_suppkey, l_linenumber, l_returnflag FROM lineitem""")
def distinct_rows(t):
    return Q.dedupe(t.lineitem.select("l_suppkey", "l_linenumber", "l_returnflag"))


@query("""SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders) WHERE rn = 1""")
def first_per_key(t):
    return Q.dedupe(t.orders.select("o_custkey", "o_orderkey", "o_totalprice"), ["o_custkey"], [-F.col("o_totalprice"), "o_orderkey"])


@query("""SELECT DISTINCT event_type, user_id % 10 AS shard FROM events""")
def hash_dedupe(t):
    return Q.dedupe_by_hash(t.events.select("event_type", (F.col("user_id") % 10).alias("shard")))


COUNTED = ["l_orderkey", "l_partkey", "l_suppkey", "l_shipdate", "l_returnflag"]


@query(" UNION ALL ".join(f"""SELECT '{c}' AS "column", count(DISTINCT {c}) AS "unique", true AS in_bound FROM lineitem""" for c in COUNTED))
def approx_uniques(t):
    """The estimate of each column beside the count: within three standard errors."""
    exact = t.lineitem.agg(*[F.count_distinct(c).alias(c) for c in COUNTED])
    exact = exact.select(F.expr(f"stack({len(COUNTED)}, {', '.join(f'{chr(39)}{c}{chr(39)}, {c}' for c in COUNTED)}) as (column, unique)"))
    found = Q.approx_uniques(t.lineitem, COUNTED, 0.05).join(exact, "column")
    return found.select("column", "unique", (F.abs(F.col("approx_unique") - F.col("unique")) <= 3 * 0.05 * F.col("unique")).alias("in_bound"))


DESCRIBED = ["o_orderkey", "o_custkey", "o_totalprice"]


@query(" UNION ALL ".join(f"""
SELECT '{c}' AS "column", count({c}) AS count, count(DISTINCT {c}) AS "unique", (SELECT max(n) FROM (SELECT count(*) AS n FROM orders GROUP BY {c})) AS freq,
 round((SELECT CAST(v AS DOUBLE) FROM (SELECT {c} AS v, count(*) AS n FROM orders WHERE {c} IS NOT NULL GROUP BY 1) WHERE n = (SELECT max(n) FROM (SELECT count(*) AS n FROM orders GROUP BY {c})) ORDER BY CAST(v AS VARCHAR) LIMIT 1), 4) AS top,
 round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, CAST(min({c}) AS DOUBLE) AS min, round(quantile_cont({c}, 0.25), 4) AS p25,
 round(quantile_cont({c}, 0.5), 4) AS p50, round(quantile_cont({c}, 0.75), 4) AS p75, CAST(max({c}) AS DOUBLE) AS max FROM orders""" for c in DESCRIBED))
def describe_columns(t):
    """All numeric columns; of values that come equally often the first as text."""
    d = Q.describe_all(t.orders, DESCRIBED)
    return d.select("column", "count", "unique", "freq", F.round(F.col("top").cast("double"), 4).alias("top"), *[F.round(c, 4).alias(c) for c in ("mean", "std")], "min",
                    *[F.round(c, 4).alias(c) for c in ("p25", "p50", "p75")], "max")


@query("""SELECT 'o_orderstatus' AS "column", CAST(sum(n) AS BIGINT) AS count, count(*) AS "unique", min(o_orderstatus) FILTER (n = m) AS top, max(n) AS freq
FROM (SELECT o_orderstatus, count(*) AS n, max(count(*)) OVER () AS m FROM orders GROUP BY 1)""")
def describe_text(t):
    return Q.describe_all(t.orders.select("o_orderstatus"))


@query("""SELECT l_orderkey, l_linenumber, l_extendedprice < q1 - 1.5 * (q3 - q1) OR l_extendedprice > q3 + 1.5 * (q3 - q1) AS is_outlier
FROM lineitem, (SELECT quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.75) AS q3 FROM lineitem)""")
def iqr_outliers(t):
    return Q.iqr_outliers(t.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice"), "l_extendedprice", exact=True).drop("l_extendedprice")


@query("""SELECT count(*) AS n, true AS low_in_bound, true AS high_in_bound, true AS flags_follow FROM events""")
def iqr_outliers_approx(t):
    """The approximate quartiles miss by at most a hundredth of the rows, and every flag follows from them."""
    flagged = Q.iqr_outliers(t.events, "value").withColumn("q", t.events.agg(F.percentile_approx("value", [0.25, 0.75], 100)).scalar())
    q, v, reach = F.col("q"), F.col("value"), (F.col("q")[1] - F.col("q")[0]) * 1.5
    near = lambda i, p: (F.count_if(v < q[i]) <= (p + 0.01) * F.count(v)) & (F.count_if(v <= q[i]) >= (p - 0.01) * F.count(v))
    follows = F.col("is_outlier") == F.coalesce((v < q[0] - reach) | (v > q[1] + reach), F.lit(False))
    return flagged.agg(F.count("*").alias("n"), near(0, 0.25).alias("low_in_bound"), near(1, 0.75).alias("high_in_bound"), F.min(follows).alias("flags_follow"))


@query("""SELECT lead_id, round(coalesce(time_spent, (SELECT avg(time_spent) FROM leads)), 6) AS time_spent, round(coalesce(activity, (SELECT avg(activity) FROM leads)), 4) AS activity,
 coalesce(lead_quality, 'Unknown') AS lead_quality FROM leads""", "leads")
def impute_mean(t):
    df = Q.impute(Q.impute(V.leads(t), "mean", ["time_spent", "activity", "absent"]), "const", ["lead_quality"], "Unknown")
    return df.select("lead_id", F.round("time_spent", 6).alias("time_spent"), F.round("activity", 4).alias("activity"), "lead_quality")


@query("""SELECT lead_id, total_visits, coalesce(page_views, 0) AS page_views, activity FROM leads""", "leads")
def impute_zero_prefix(t):
    return Q.impute_zero_by_prefix(V.leads(t)).select("lead_id", "total_visits", "page_views", "activity")


@query("""SELECT lead_id, coalesce(lead_quality, (SELECT lead_quality FROM leads WHERE lead_quality IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS lead_quality FROM leads""", "leads")
def impute_mode(t):
    return Q.impute(V.leads(t), "mode", ["lead_quality"]).select("lead_id", "lead_quality")


@query("""SELECT lead_id, round(coalesce(time_spent, (SELECT quantile_cont(time_spent, 0.5) FROM leads)), 6) AS time_spent,
 coalesce(activity, (SELECT quantile_cont(activity, 0.5) FROM leads)) AS activity FROM leads""", "leads")
def impute_median(t):
    return Q.impute(V.leads(t), "median", ["time_spent", "activity"]).select("lead_id", F.round("time_spent", 6).alias("time_spent"), "activity")


@query("""SELECT lead_id, round(CASE WHEN time_spent > q THEN q ELSE time_spent END, 6) AS time_spent FROM leads, (SELECT quantile_cont(time_spent, 0.99) AS q FROM leads)""", "leads")
def winsorize(t):
    return Q.winsorize(V.leads(t), "time_spent").select("lead_id", F.round("time_spent", 6).alias("time_spent"))


@query("""SELECT lead_quality, count(*) AS count, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM leads WHERE lead_quality IS NOT NULL GROUP BY 1""", "leads")
def value_counts(t):
    return A.value_counts(V.leads(t), "lead_quality").withColumn("share", F.round("share", 6))


@query("""SELECT count(converted) AS rows, round(avg(converted), 6) AS rate FROM leads""", "leads")
def class_rate(t):
    return A.class_rate(V.leads(t), "converted").withColumn("rate", F.round("rate", 6))


@query("""SELECT p AS o_orderpriority, CAST(y AS INTEGER) AS year, n FROM (SELECT o_orderpriority AS p, year(o_orderdate) AS y, count(*) AS n FROM orders GROUP BY 1, 2)""")
def melted_macro(t):
    wide = t.orders.withColumn("year", F.year("o_orderdate")).groupBy("o_orderpriority").pivot("year").agg(F.count(F.lit(1)))
    long = A.melt(wide, ["o_orderpriority"], value="n").filter("n is not null")
    return long.withColumn("year", F.col("year").cast("int"))


@query("""SELECT CAST(y AS INTEGER) AS year, CAST(count(*) FILTER (o_orderpriority = '1-URGENT') AS BIGINT) AS urgent, CAST(count(*) FILTER (o_orderpriority = '5-LOW') AS BIGINT) AS low
FROM (SELECT *, year(o_orderdate) AS y FROM orders) GROUP BY 1""")
def macro_tidy(t):
    wide = t.orders.withColumn("y", F.year("o_orderdate")).groupBy(F.col("o_orderpriority").alias("series")).pivot("y").agg(F.count(F.lit(1)))
    wide = wide.select("series", *[F.coalesce(F.col(y), F.lit(0)).alias(f"YR{y}") for y in wide.columns[1:]])
    return A.macro_tidy(wide, "series", {"1-URGENT": "urgent", "5-LOW": "low"}).filter("urgent + low > 0")


CLUSTERED = ["Affordability", "Liquidity", "Growth"]


@query("""SELECT g AS cluster, count(*) AS size, round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (), 4) AS pct_of_total, """ +
       ", ".join(f"round(avg({c}), 4) AS \"mean_{c}\"" for c in CLUSTERED) + " FROM (SELECT *, investor_id % 4 AS g FROM traits) GROUP BY 1", "traits")
def cluster_profiles(t):
    p = A.cluster_profiles(V.traits(t).withColumn("cluster", F.col("investor_id") % 4), "cluster", CLUSTERED)
    return p.select("cluster", "size", F.round("pct_of_total", 4).alias("pct_of_total"), *[F.round(f"mean_{c}", 4).alias(f"mean_{c}") for c in CLUSTERED])


@query("""SELECT lead_source, round(avg(converted), 6) AS target_mean FROM leads GROUP BY 1""", "leads")
def target_means(t):
    return A.target_means(V.leads(t), "lead_source", "converted").withColumn("target_mean", F.round("target_mean", 6))


CORR = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _corr_sql(a, b):
    if a == b:
        return f"SELECT '{a}' AS a, '{a}' AS b, 1.0::DOUBLE AS corr"
    return f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 8) AS corr FROM lineitem"


@query(" UNION ALL ".join(_corr_sql(a, b) for a in CORR for b in CORR))
def corr_matrix(t):
    return A.corr_matrix(t.lineitem, CORR).withColumn("corr", F.round("corr", 8))


@query("SELECT min(nav) AS min_value, max(nav) AS max_value FROM nav", "nav")
def global_bounds(t):
    return A.global_bounds(V.nav(t))


@query(r"""SELECT count(DISTINCT w) AS vocabulary, count(*) AS tokens FROM (SELECT unnest(regexp_split_to_array(text, '\s+')) AS w FROM documents) WHERE w <> ''""")
def vocabulary_size(t):
    return A.vocabulary_size(t.documents, "text")


@query("""SELECT item, CAST(count(*) AS DOUBLE) AS score FROM pairs GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""", "pairs")
def popular_items(t):
    return A.popular_items(A.interaction_pairs(V.interactions(t)), 10)


@query("""SELECT u."user", i.item, CAST(p.item IS NOT NULL AS INTEGER) AS bought FROM (SELECT DISTINCT "user" FROM pairs) u
CROSS JOIN (SELECT DISTINCT p_brand || '/' || p_type AS item FROM part) i LEFT JOIN pairs p ON p."user" = u."user" AND p.item = i.item""", "pairs")
def pivot_interactions(t):
    """The whole 0/1 matrix over the catalogue's items, one row per cell."""
    items = sorted(r[0] for r in t.part.select(F.concat_ws("/", "p_brand", "p_type")).distinct().collect())
    wide = A.pivot_interactions(A.interaction_pairs(V.interactions(t)), items)
    return wide.unpivot(["user"], [f"`{i}`" for i in items], "item", "bought")



@query("""SELECT portfolio, round_even(round(max(v) * 100 / sum(v), 9), 1) AS sector_concentration_pct, max(v) / sum(v) > 0.5 AS concentrated FROM (
 SELECT portfolio, coalesce(nullif(sector, ''), CASE WHEN fund_name LIKE '%liquid%' OR fund_name LIKE '%debt%' THEN 'Treasury & Debt' WHEN fund_name LIKE '%nifty%' OR fund_name LIKE '%index%' THEN 'Multi-Sector Index'
   WHEN fund_name LIKE '%magnum%' OR fund_name LIKE '%midcap%' THEN 'Financials & Auto' ELSE 'Technology & Energy' END) AS s, sum(value) AS v FROM holdings GROUP BY 1, 2) GROUP BY 1""", "holdings")
def sector_concentration(t):
    return A.sector_concentration(V.holdings(t))


@query("""SELECT portfolio, CASE WHEN count(*) > 1 THEN round_even(round((1 - count(DISTINCT lower(coalesce(category, ''))) / count(*)) * 100, 9), 1) ELSE 0.0::DOUBLE END AS fund_overlap_pct FROM holdings GROUP BY 1""", "holdings")
def fund_overlap(t):
    return A.fund_overlap(V.holdings(t))


@query("""SELECT portfolio, round(sum(value), 2) AS invested, round(sum(value) + sum(gain), 4) AS current_value, round(sum(gain), 4) AS gain, round(sum(gain) * 100 / sum(value), 4) AS gain_pct FROM holdings GROUP BY 1""", "holdings")
def portfolio_totals(t):
    p = A.portfolio_totals(V.holdings(t))
    return p.select("portfolio", F.round("invested", 2).alias("invested"), *[F.round(c, 4).alias(c) for c in ("current_value", "gain")], F.round("gain_pct", 4).alias("gain_pct"))


@query("""SELECT o_custkey AS portfolio, round(sum(l_quantity * p_retailprice), 2) AS portfolio_value FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey GROUP BY 1""")
def units_value(t):
    units = t.orders.join(t.lineitem, F.col("l_orderkey") == F.col("o_orderkey")).select(F.col("o_custkey").alias("portfolio"), F.col("l_partkey").alias("fund_id"), F.col("l_quantity").alias("units"))
    navs = t.part.select(F.col("p_partkey").alias("fund_id"), F.col("p_retailprice").alias("nav"))
    return A.units_value(units, navs).withColumn("portfolio_value", F.round("portfolio_value", 2))


@query("""SELECT CAST(b AS INTEGER) AS bin, round(lo + b * w, 6) AS low, round(lo + (b + 1) * w, 6) AS high, (SELECT count(*) FROM orders WHERE least(CAST(floor((o_totalprice - lo) / w) AS INTEGER), 9) = b) AS count
FROM (SELECT min(o_totalprice) AS lo, (max(o_totalprice) - min(o_totalprice)) / 10 AS w FROM orders), (SELECT unnest(range(10)) AS b)""")
def histogram(t):
    return A.histogram(t.orders, "o_totalprice", 10).select("bin", F.round("low", 6).alias("low"), F.round("high", 6).alias("high"), "count")


@query(" UNION ALL ".join(f"""SELECT '{c}' AS "column", min({c}) AS low, round(quantile_cont({c}, 0.25), 4) AS q1, round(quantile_cont({c}, 0.5), 4) AS median, round(quantile_cont({c}, 0.75), 4) AS q3, max({c}) AS high FROM lineitem""" for c in ("l_quantity", "l_extendedprice")))
def box_stats(t):
    b = A.box_stats(t.lineitem, ["l_quantity", "l_extendedprice"])
    return b.select("column", "low", *[F.round(c, 4).alias(c) for c in ("q1", "median", "q3")], "high")


@query("""SELECT investor_id, CAST(greatest(ceil((Affordability - lo) / w) - 1, 0) AS INTEGER) AS bin FROM traits, (SELECT min(Affordability) AS lo, (max(Affordability) - min(Affordability)) / 4 AS w FROM traits)""", "traits")
def equal_width_bins(t):
    return A.equal_width_cut(V.traits(t), "Affordability", 4).select("investor_id", "bin")


@query("""SELECT count(DISTINCT scheme) AS schemes, count(*) AS total_rows, min(date) AS first_date, max(date) AS latest_date FROM nav""", "nav")
def nav_summary(t):
    return A.nav_summary(V.nav(t))


@query("""SELECT scheme, count(*) AS n_rows, min(date) AS first_date, max(date) AS last_date, round(count(*) / (date_diff('day', min(date), max(date)) + 1), 4) AS coverage FROM nav GROUP BY 1""", "nav")
def nav_coverage(t):
    return A.nav_coverage(V.nav(t))


@query("""SELECT count(*) AS total_requests, count(*) FILTER (event_type = 'error') AS errors, round((SELECT avg(value) FROM (SELECT value FROM events ORDER BY ts DESC, event_id DESC LIMIT 100)), 6) AS average_latency FROM events""")
def request_metrics(t):
    log = t.events.select("ts", F.col("event_id"), F.col("value").alias("latency"), (F.col("event_type") != "error").alias("success"))
    return A.request_metrics(log, ["ts", F.desc("event_id")]).withColumn("average_latency", F.round("average_latency", 6))


@query("""SELECT user_id % 20 AS city, date_trunc('day', ts) AS day, count(*) AS n FROM events GROUP BY 1, 2""")
def daily_activity(t):
    return t.events.groupBy((F.col("user_id") % 20).alias("city"), F.date_trunc("day", "ts").alias("day")).agg(F.count("*").alias("n"))


@query("""SELECT CAST(sum(n) AS BIGINT) AS total_rows, CAST(sum(n - 1) AS BIGINT) AS duplicate_rows, count(*) AS unique_rows, round(sum(n - 1) * 100.0::DOUBLE / sum(n), 4) AS duplicate_pct FROM (SELECT count(*) AS n FROM documents GROUP BY text, lang)""")
def audit_duplicates(t):
    return Q.audit(t.documents.select("text", "lang"))["duplicates"]


@query("""SELECT * FROM (SELECT 'lead_quality' AS "column", count(*) - count(lead_quality) AS nulls, round((count(*) - count(lead_quality)) * 100.0::DOUBLE / count(*), 4) AS pct FROM leads
UNION ALL SELECT 'time_spent', count(*) - count(time_spent), round((count(*) - count(time_spent)) * 100.0::DOUBLE / count(*), 4) FROM leads
UNION ALL SELECT 'city', count(*) - count(city), round((count(*) - count(city)) * 100.0::DOUBLE / count(*), 4) FROM leads)""", "leads")
def audit_missing(t):
    return Q.audit(V.leads(t).select("lead_quality", "time_spent", "city"))["missing"]


@query("""SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem UNION SELECT DISTINCT o_orderstatus, o_orderstatus FROM orders""")
def union_distinct(t):
    a = t.lineitem.select("l_returnflag", "l_linestatus")
    b = t.orders.select(F.col("o_orderstatus").alias("l_returnflag"), F.col("o_orderstatus").alias("l_linestatus"))
    return K.union_distinct(a, b)


@query("""SELECT s_suppkey AS id, s_name AS name, NULL::VARCHAR AS segment FROM supplier UNION ALL SELECT c_custkey, c_name, c_mktsegment FROM customer""")
def union_all_feeds(t):
    a = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    return K.union_all(a, t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")))


@query("""SELECT DISTINCT l_partkey FROM lineitem WHERE l_quantity >= 45 AND l_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity <= 3)""")
def except_seen(t):
    a = t.lineitem.filter("l_quantity >= 45").select("l_partkey")
    return K.except_keys(a, t.lineitem.filter("l_quantity <= 3").select("l_partkey"), ["l_partkey"])
