"""Readers, writers and streams, fed with files Spark writes from the driver tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import models as M
from ..sources import files, sinks
from ..sources.scratch import checkpoint_dir
from ..streaming import drift, streams, upsert
from . import etl, views as V
from .registry import query


def scratch(t, name: str) -> str:
    """A new folder in the shared scratch space."""
    return f"{checkpoint_dir(t.spark)}/fundloom-{name}-{uuid.uuid4().hex}"


ONCE = {"availableNow": True}


@query("""SELECT l_suppkey % 10 AS shard, count(*) AS n, CAST(sum(l_linenumber) AS BIGINT) AS lines FROM lineitem GROUP BY 1""")
def csv_tree(t):
    out = scratch(t, "csv")
    t.lineitem.select((F.col("l_suppkey") % 10).alias("shard"), "l_returnflag", "l_linenumber").write.partitionBy("l_returnflag").option("header", True).csv(out)
    return files.read_csv_tree(t.spark, out, "shard long, l_linenumber int").groupBy("shard").agg(F.count("*").alias("n"), F.sum("l_linenumber").alias("lines"))


@query("""SELECT CASE WHEN event_id % 11 = 0 THEN 'bad' ELSE 'good' END AS kind, count(*) AS n FROM events GROUP BY 1""")
def csv_quarantine(t):
    out = scratch(t, "quarantine")
    t.events.select(F.when(F.col("event_id") % 11 == 0, "not a number").otherwise(F.col("event_id").cast("string")).alias("event_id"), "event_type").write.option("header", True).csv(out)
    from pyspark.sql import types as T
    good, bad = files.read_csv_quarantine(t.spark, out, T.StructType().add("event_id", "long").add("event_type", "string"))
    return good.select(F.lit("good").alias("kind"), "event_type").unionByName(bad.select(F.lit("bad").alias("kind"), "event_type")).groupBy("kind").agg(F.count("*").alias("n"))


@query("""SELECT c_mktsegment AS entity, count(*) AS n, round(max(c_acctbal), 2) AS top FROM customer GROUP BY 1""")
def entity_folders(t):
    """One folder per entity, keyed by the path."""
    out = scratch(t, "entity")
    t.customer.select("c_mktsegment", "c_acctbal").write.partitionBy("c_mktsegment").option("header", True).csv(out)
    df = files.add_source_path(files.read_csv_tree(t.spark, out, "c_acctbal double"))
    return df.groupBy(F.regexp_extract("_source_file", "c_mktsegment=([^/]*)/", 1).alias("entity")).agg(F.count("*").alias("n"), F.max("c_acctbal").alias("top"))


@query("""SELECT CASE WHEN n_nationkey < 5 THEN 'Unknown' ELSE 'Zone ' || (n_nationkey // 5) END AS "Category", count(*) AS schemes, count(v) AS with_nav, CAST(sum(v) AS DOUBLE) AS nav FROM (SELECT n_nationkey, CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE s_suppkey END AS v FROM nation JOIN supplier ON s_nationkey = n_nationkey) GROUP BY 1""")
def nav_text(t):
    """Semicolon snapshots, one file per nation: a category line (none for the first ones), a header, fund lines, blanks."""
    out = scratch(t, "navtext")
    s = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    line = F.concat_ws(";", F.col("s_suppkey").cast("string"), F.lit("A"), F.lit("B"), F.col("s_name"), F.when(F.col("s_suppkey") % 4 == 0, "N.A.").otherwise(F.col("s_suppkey").cast("string")), F.lit("01-Jan-2024"))
    doc = s.groupBy("n_nationkey").agg(F.array_join(F.array_sort(F.collect_list(line)), "\n\n").alias("body"))
    head = F.when(F.col("n_nationkey") < 5, "").otherwise(F.concat(F.lit("Zone "), F.floor(F.col("n_nationkey") / 5).cast("string")))
    doc.select(F.concat_ws("\n", head, F.lit("Scheme Code;a;b;c;d;e"), "body").alias("value"), "n_nationkey").repartition("n_nationkey").write.partitionBy("n_nationkey").option("lineSep", "\n").text(out)
    return files.parse_nav_text(t.spark, out).groupBy("Category").agg(F.count("*").alias("schemes"), F.count("Net_Asset_Value").alias("with_nav"), F.sum("Net_Asset_Value").alias("nav"))


@query("""SELECT title, link, CASE WHEN page_id % 3 = 0 THEN '' ELSE 'summary ' || page_id END AS summary, md5(link) AS article_id FROM (SELECT page_id, 'Page ' || page_id AS title, CASE WHEN page_id % 4 = 0 THEN '' ELSE 'http://x.example/' || page_id END AS link FROM pages)""")
def rss_feed(t):
    out = scratch(t, "rss")
    k = F.col("page_id").cast("string")
    t.pages.select(F.concat(F.lit("Page "), k).alias("title"), F.when(F.col("page_id") % 4 != 0, F.concat(F.lit("http://x.example/"), k)).alias("link"),
                   F.when(F.col("page_id") % 3 != 0, F.concat(F.lit("summary "), k)).alias("description")).write.format("xml").option("rootTag", "channel").option("rowTag", "item").save(out)
    return files.rss_items(t.spark, out, "demo").select("title", "link", "summary", "article_id")


@query("""SELECT event_type, count(*) AS n FROM events GROUP BY 1""")
def json_lines(t):
    out = scratch(t, "jsonl")
    half = F.col("event_id") % 2 == 0
    sinks.append_jsonl(t.events.filter(half), out)
    sinks.append_jsonl(t.events.filter(~half), out)
    return t.spark.read.schema("event_id long, event_type string").json(out).groupBy("event_type").agg(F.count("*").alias("n"))


@query("""SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1""")
def partitioned_parquet(t):
    out = scratch(t, "parquet")
    sinks.write_parquet(t.orders, out, ["o_orderstatus"])
    return files.read_parquet_dir(t.spark, out).filter("o_orderstatus <> 'P'").groupBy("o_orderstatus").agg(F.count("*").alias("n"))


@query("""SELECT event_id, value FROM events ORDER BY ts DESC, event_id LIMIT 40""")
def latest_parts(t):
    out = scratch(t, "live")
    t.events.select(F.col("event_id").alias(" Event_ID"), "ts", F.col("value").cast("string").alias("Value")).write.parquet(out)
    return files.latest_rows(t.spark, out, "ts", 40, ["value"], ["event_id"]).select("event_id", "value")


@query("""SELECT data_type, files FROM (SELECT 'structured' AS data_type, CAST(1 AS BIGINT) AS files UNION ALL SELECT 'velocity', CAST(count(DISTINCT event_type) AS BIGINT) FROM events UNION ALL SELECT 'TOTAL', CAST(1 + count(DISTINCT event_type) AS BIGINT) FROM events)""")
def dataset_inventory(t):
    out = scratch(t, "inventory")
    t.region.coalesce(1).write.csv(f"{out}/structured/region")
    t.events.repartition("event_type").write.partitionBy("event_type").csv(f"{out}/velocity")
    return files.dataset_inventory(t.spark, out).select("data_type", "files")


@query("""SELECT count(DISTINCT event_type) AS copies FROM events""")
def duplicate_files(t):
    """The same line in one folder per event type."""
    out = scratch(t, "dups")
    t.events.select("event_type").distinct().withColumn("value", F.lit("same line")).repartition("event_type").write.partitionBy("event_type").text(out)
    return files.duplicate_files(t.spark, out).select("copies")


@query("""SELECT converted, count(*) AS n, CAST(sum(total_visits) AS BIGINT) AS visits FROM (SELECT DISTINCT converted, total_visits, lead_origin FROM leads) GROUP BY 1""", "leads")
def lead_etl(t):
    src, out = scratch(t, "leads-raw"), scratch(t, "leads-clean")
    V.leads(t).select(F.col("total_visits").alias("Total Visits"), F.col("lead_origin").alias("Lead Origin"), F.col("converted").alias("Converted")).write.option("header", True).csv(src)
    etl.lead_etl(t.spark, src, out, schema="`Total Visits` long, `Lead Origin` string, Converted int")
    return t.spark.read.parquet(out).groupBy("converted").agg(F.count("*").alias("n"), F.sum("total_visits").alias("visits"))


@query("""SELECT count(*) AS n, round(avg(coalesce(v, (SELECT avg(CASE WHEN l_partkey % 5 = 0 THEN NULL ELSE l_tax END) FROM lineitem WHERE l_partkey % 7 <> 0))), 8) AS mean_volume FROM (SELECT CASE WHEN l_partkey % 5 = 0 THEN NULL ELSE l_tax END AS v FROM lineitem WHERE l_partkey % 7 <> 0)""")
def intraday_etl(t):
    src, out = scratch(t, "bars-raw"), scratch(t, "bars-clean")
    k = F.col("l_partkey")
    t.lineitem.select(F.when(k % 7 != 0, F.col("l_extendedprice")).alias("Open"), F.col("l_quantity").alias("Close"), F.when(k % 5 != 0, F.col("l_tax")).alias("Volume")).write.option("header", True).csv(src)
    etl.intraday_etl(t.spark, src, out, schema="Open double, Close double, Volume double")
    return t.spark.read.parquet(out).agg(F.count("*").alias("n"), F.round(F.avg("volume"), 8).alias("mean_volume"))


@query("""SELECT event_type AS sentiment, count(DISTINCT user_id) AS n FROM events GROUP BY 1""")
def sentiment_etl(t):
    src, out = scratch(t, "texts-raw"), scratch(t, "texts-clean")
    t.events.select(F.concat(F.lit("user "), F.col("user_id").cast("string")).alias("Sentence"), F.col("event_type").alias("Sentiment")).write.option("header", True).csv(src)
    etl.sentiment_etl(t.spark, src, out, "Sentence string, Sentiment string")
    return t.spark.read.parquet(out).groupBy("sentiment").agg(F.count("*").alias("n"))


TIERED = "CASE WHEN conversion_probability >= 0.8 THEN 'Tier 1: Hot' WHEN conversion_probability >= 0.5 THEN 'Tier 2: Nurture' ELSE 'Tier 3: Cold' END"


@query(f"""WITH s AS (SELECT total_visits * 0.3::DOUBLE + time_spent * 0.0005::DOUBLE AS e FROM leads)
SELECT 'distributor_dashboard' AS export, {TIERED} AS part, count(*) AS n FROM leads GROUP BY 2
UNION ALL SELECT 'leads_for_bi', CASE WHEN e <= 10 THEN 'Low' WHEN e <= 30 THEN 'Medium' WHEN e > 30 THEN 'High' END, count(*) FROM s GROUP BY 2
UNION ALL SELECT 'investor_dashboard', 'all', count(*) FROM traits UNION ALL SELECT 'sentiment_for_bi', CAST(quality AS VARCHAR), count(*) FROM labels GROUP BY 2
UNION ALL SELECT 'summary_metrics', 'total_leads', count(*) FROM leads UNION ALL SELECT 'summary_metrics', 'converted_leads', CAST(sum(converted) AS BIGINT) FROM leads
UNION ALL SELECT 'summary_metrics', 'total_investors', count(*) FROM traits UNION ALL SELECT 'summary_metrics', 'total_texts', count(*) FROM labels""", "leads traits")
def bi_exports(t):
    """All five exports, read back and counted by what they say."""
    out = scratch(t, "bi")
    etl.bi_exports(V.leads(t), V.traits(t), t.labels, out)
    back = lambda name: t.spark.read.option("header", True).csv(f"{out}/{name}")
    count = lambda df, name, part: df.groupBy(part.alias("part")).agg(F.count("*").alias("n")).select(F.lit(name).alias("export"), "part", "n")
    made = count(back("distributor_dashboard"), "distributor_dashboard", F.col("lead_tier")).union(
        count(back("leads_for_bi"), "leads_for_bi", F.col("engagement_tier"))).union(count(back("investor_dashboard"), "investor_dashboard", F.lit("all"))).union(
        count(back("sentiment_for_bi"), "sentiment_for_bi", F.col("quality")))
    long = back("summary_metrics/csv").filter("metric <> 'mean_conversion_probability'").select(F.lit("summary_metrics").alias("export"), F.col("metric").alias("part"), F.col("value").cast("double").cast("long").alias("n"))
    return made.union(long)


# ---- more readers --------------------------------------------------------------------------

def _grouped_text(t, name: str, rows, group: str, line, head: str = "", tail: str = "", sep: str = "\n") -> str:
    """One text file per group of a few rows."""
    out = scratch(t, name)
    body = rows.groupBy(group).agg(F.array_join(F.array_sort(F.collect_list(line)), sep).alias("b"))
    body.select(F.concat(F.lit(head), "b", F.lit(tail)).alias("value"), group).repartition(group).write.partitionBy(group).option("lineSep", "\n").text(out)
    return out


@query("""SELECT c_mktsegment AS segment, count(*) AS n, round(sum(c_acctbal), 2) AS balance FROM customer GROUP BY 1""")
def json_documents(t):
    """JSON documents over many lines, one array of at most fifty objects a file."""
    c = t.customer.withColumn("shard", F.floor(F.col("c_custkey") / 50))
    line = F.concat(F.lit('  {\n    "id": '), F.col("c_custkey").cast("string"), F.lit(',\n    "segment": "'), "c_mktsegment", F.lit('",\n    "balance": '), F.col("c_acctbal").cast("string"), F.lit("\n  }"))
    out = _grouped_text(t, "jsondocs", c, "shard", line, "[\n", "\n]\n", ",\n")
    return files.read_json_docs(t.spark, out, "id long, segment string, balance double").groupBy("segment").agg(F.count("*").alias("n"), F.round(F.sum("balance"), 2).alias("balance"))


@query("""SELECT 'scheme ' || (o_custkey % 12) AS scheme, count(*) AS n, min(CAST(o_orderdate AS DATE)) AS first_day, round(max(o_totalprice), 2) AS top FROM orders GROUP BY 1""")
def entity_dir(t):
    """One history file per entity, keyed by its name."""
    raw, out = scratch(t, "entity-raw"), scratch(t, "entity-dir")
    t.orders.select((F.col("o_custkey") % 12).alias("k"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("Date"), F.col("o_totalprice").alias(" Close ")).repartition("k").write.partitionBy("k").option("header", True).csv(raw)
    hadoop = t.spark._jvm.org.apache.hadoop.fs
    fs = hadoop.Path(raw).getFileSystem(t.spark._jsc.hadoopConfiguration())
    fs.mkdirs(hadoop.Path(out))
    for k in range(12):
        for i, part in enumerate(fs.globStatus(hadoop.Path(f"{raw}/k={k}/part-*")) or []):
            fs.rename(part.getPath(), hadoop.Path(f"{out}/scheme {k}{'_history' if k % 2 else ''}.csv" if i == 0 else f"{out}/more-{k}-{i}.csv"))
    df = files.read_entity_dir(t.spark, out, "scheme", "Date string, Close double")
    return df.groupBy("scheme").agg(F.count("*").alias("n"), F.min("date").alias("first_day"), F.round(F.max("close"), 2).alias("top"))


@query("""SELECT k AS source, count(*) AS n, CAST(sum(c_custkey) AS BIGINT) AS total FROM customer, (SELECT unnest(['clean', 'empty clean', 'no clean']) AS k) GROUP BY 1""")
def prefer_clean(t):
    """The cleaned table where it has rows, else the raw file: all three cases."""
    csv, full, empty = scratch(t, "raw-csv"), scratch(t, "clean"), scratch(t, "clean-empty")
    rows = t.customer.select(F.col("c_custkey").alias("Cust Key"))
    rows.write.option("header", True).csv(csv)
    clean = rows.toDF("cust_key")
    clean.write.parquet(full)
    clean.limit(0).write.parquet(empty)
    out = None
    for name, path in (("clean", full), ("empty clean", empty), ("no clean", f"{full}-absent")):
        one = files.read_prefer_clean(t.spark, path, csv).agg(F.count("*").alias("n"), F.sum(F.col("cust_key").cast("long")).alias("total")).select(F.lit(name).alias("source"), "n", "total")
        out = one if out is None else out.union(one)
    return out


@query("""SELECT date_trunc('month', CAST(o_orderdate AS DATE))::DATE AS month, count(*) AS n, count(*) FILTER (o_orderkey % 2 = 1) AS with_volume, round(sum(o_totalprice), 2) AS closed FROM orders GROUP BY 1""")
def merged_history(t):
    """Two exports of one history: padded headers, other dates, and a column that only one of them has."""
    old, new = scratch(t, "history-old"), scratch(t, "history-new")
    o = t.orders.withColumn("day", F.to_date("o_orderdate"))
    o.filter("o_orderkey % 2 = 0").select(F.date_format("day", "dd-MMM-yyyy").alias("Date "), F.col("o_totalprice").alias(" Close")).write.option("header", True).csv(old)
    o.filter("o_orderkey % 2 = 1").select(F.date_format("day", "yyyy-MM-dd").alias(" Date"), F.col("o_totalprice").alias("Close"), F.lit(1).alias("Volume")).write.option("header", True).csv(new)
    h = files.merge_history(t.spark, [old, new])
    return h.groupBy(F.trunc("Date", "month").alias("month")).agg(F.count("*").alias("n"), F.count("Volume").alias("with_volume"), F.round(F.sum("Close"), 2).alias("closed"))


@query("""SELECT lead_id, CAST(conversion_probability >= 0.65 AS INTEGER) AS pred_label, conversion_probability AS pred_proba FROM leads""", "leads")
def batch_function_scores(t):
    """A user's own model over Arrow batches; the schema is the input's with two fields more."""
    lead = V.leads(t).select("lead_id", "conversion_probability")
    scored = M.score_with_function(lead, lambda p: p["conversion_probability"], 0.65)
    if [f.name for f in scored.schema] != [f.name for f in M.with_prediction_fields(lead.schema)]:
        raise ValueError("scoring changed the schema")
    return scored.select("lead_id", "pred_label", "pred_proba")


# ---- streams -------------------------------------------------------------------------------

def lead_inbox(t) -> str:
    out = scratch(t, "inbox")
    V.lead_events(t).write.json(out)
    return out


@query("""SELECT "City", count(*) AS leads FROM lead_events WHERE lead_id IS NOT NULL AND total_visits >= 0 AND "Conversion_Probability" >= 0 GROUP BY 1""", "lead_events")
def stream_quality(t):
    out = scratch(t, "valid")
    streams.append_parquet(streams.quality_stream(streams.lead_stream(t.spark, lead_inbox(t))), out, scratch(t, "ck"), **ONCE).awaitTermination()
    return t.spark.read.parquet(out).groupBy("City").agg(F.count("*").alias("leads"))


@query("""SELECT "City", count(*) AS leads FROM lead_events WHERE NOT coalesce(lead_id IS NOT NULL AND total_visits >= 0 AND "Conversion_Probability" >= 0, false) GROUP BY 1""", "lead_events")
def stream_rejected(t):
    out = scratch(t, "rejected")
    streams.append_parquet(streams.rejected_stream(streams.lead_stream(t.spark, lead_inbox(t))), out, scratch(t, "ck"), **ONCE).awaitTermination()
    return t.spark.read.parquet(out).groupBy("City").agg(F.count("*").alias("leads"))


WINDOWS = """ok AS (SELECT "City", lead_id, "Conversion_Probability" AS p, CAST("timestamp" AS TIMESTAMP) AS ts FROM lead_events WHERE lead_id IS NOT NULL AND total_visits >= 0 AND "Conversion_Probability" >= 0),
wi AS (SELECT "City", p, lead_id, time_bucket(INTERVAL 30 SECOND, ts) - to_seconds(30 * k) AS window_start FROM ok, (SELECT unnest([0, 1]) AS k)),
ag AS (SELECT window_start, window_start + INTERVAL 1 MINUTE AS window_end, "City", round(avg(p), 6) AS avg_lead_score, count(lead_id) AS lead_count FROM wi GROUP BY 1, 2, 3)"""


def _flat(df):
    # the oracle's times carry no zone
    return df.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), F.col("window_end").cast("timestamp_ntz").alias("window_end"), "City",
                     F.round("avg_lead_score", 6).alias("avg_lead_score"), "lead_count")


@query(f"WITH {WINDOWS} SELECT * FROM ag", "lead_events")
def city_windows(t):
    m = streams.city_metrics(streams.quality_stream(V.lead_events(t)), watermark=None)
    return _flat(m.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "City", "avg_lead_score", "lead_count"))


@query(f"WITH {WINDOWS} SELECT * FROM ag WHERE window_end <= (SELECT max(ts) FROM ok) - INTERVAL 10 MINUTE", "lead_events")
def stream_city_windows(t):
    """Windows the watermark has closed, as the file sink has them."""
    out = scratch(t, "windows")
    m = streams.city_metrics(streams.quality_stream(streams.lead_stream(t.spark, lead_inbox(t))))
    streams.metrics_sink(m, out, scratch(t, "ck"), **ONCE).awaitTermination()
    return _flat(t.spark.read.schema("window_start timestamp, window_end timestamp, City string, avg_lead_score double, lead_count long").json(out))


@query("""SELECT time_bucket(INTERVAL 1 HOUR, CAST("timestamp" AS TIMESTAMP)) AS window_start, "City", count(lead_id) AS lead_count FROM lead_events GROUP BY 1, 2""", "lead_events")
def tumbling_windows(t):
    m = streams.city_metrics(V.lead_events(t), "1 hour", None, None)
    return m.select(F.col("window.start").cast("timestamp_ntz").alias("window_start"), "City", "lead_count")


@query("""SELECT "City", arg_max(lead_id, "timestamp" || lead_id) AS lead_id, 'New' AS status FROM lead_events WHERE lead_id IS NOT NULL GROUP BY 1""", "lead_events")
def stream_upsert(t):
    table = scratch(t, "upsert")
    inbox = streams.lead_stream(t.spark, lead_inbox(t)).filter("lead_id is not null").select("City", "lead_id", "timestamp")
    upsert.foreach_batch_upsert(inbox, "City", table, scratch(t, "ck"), [F.concat("timestamp", "lead_id")], 32, **ONCE).awaitTermination()
    return upsert.read_table(t.spark, table).select("City", "lead_id", "status")


@query("""SELECT count(DISTINCT title || source) AS unique_signals FROM signals""", "signals")
def stream_dedupe(t):
    src, out = scratch(t, "signals"), scratch(t, "unique")
    V.signals(t).select(F.col("ts").cast("timestamp").alias("ts"), "title", "source").write.parquet(src)
    s = t.spark.readStream.schema("ts timestamp, title string, source string").parquet(src)
    streams.append_parquet(streams.dedupe_stream(s, ["title", "source"], "ts", "1 day"), out, scratch(t, "ck"), **ONCE).awaitTermination()
    return t.spark.read.parquet(out).agg(F.count("*").alias("unique_signals"))


DRIFT = """sc AS (SELECT event_id, ts, source, sha1(title || '||' || source || '|' || sentiment || '|' || coalesce(market_impact, '') || '|') AS sig,
 greatest(-1, least(1, (CASE sentiment WHEN 'positive' THEN 1 WHEN 'negative' THEN -1 ELSE 0 END + CASE market_impact WHEN 'bullish' THEN 0.25::DOUBLE WHEN 'bearish' THEN -0.25::DOUBLE ELSE 0 END) * greatest(0.3::DOUBLE, least(confidence, 1)))) AS d FROM signals),
un AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source, sig ORDER BY ts) AS rn FROM sc) WHERE rn = 1),
la AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY ts DESC, sig DESC) AS r FROM un) WHERE r <= 50)"""


@query(f"""WITH {DRIFT} SELECT source, count(*) AS samples, round(avg(d), 4) AS mean_score, round(avg(CASE WHEN d < 0 THEN 1.0::DOUBLE ELSE 0 END), 4) AS negative_ratio,
 count(*) >= 12 AND (avg(d) <= -0.2 OR avg(CASE WHEN d < 0 THEN 1.0::DOUBLE ELSE 0 END) >= 0.6) AS drift_detected FROM la GROUP BY 1""", "signals")
def stream_drift(t):
    src, out = scratch(t, "signals"), scratch(t, "drift")
    V.signals(t).select(F.col("ts").cast("timestamp").alias("ts"), "title", "source", "sentiment", "market_impact", "confidence").write.parquet(src)
    s = t.spark.readStream.schema("ts timestamp, title string, source string, sentiment string, market_impact string, confidence double").parquet(src)
    drift.drift_sink(s, scratch(t, "drift-state"), out, scratch(t, "ck"), **ONCE).awaitTermination()
    return drift.read_status(t.spark, out).select("source", "samples", "mean_score", "negative_ratio", "drift_detected")


@query("""SELECT snap AS "index", vix FROM market""", "market")
def stream_market(t):
    """CSV inbox to Parquet."""
    inbox, out = scratch(t, "csv-inbox"), scratch(t, "market")
    m = V.market(t)
    m.select(F.col("snap").cast("string").alias("Index"), F.col("vix").alias("Last_Price")).write.option("header", True).csv(inbox)
    streams.market_stream(t.spark, inbox, out, scratch(t, "ck"), "`Index` string, Last_Price double", **ONCE).awaitTermination()
    return t.spark.read.parquet(out).select(F.col("index").cast("bigint").alias("index"), F.col("last_price").alias("vix"))


@query("""SELECT event_id FROM signals ORDER BY ts DESC, event_id DESC LIMIT 20""", "signals")
def latest_signals(t):
    return streams.latest_signals(V.signals(t), "ts", 20, ties=[F.desc("event_id")]).select("event_id")


@query()
def stream_scoring(t):
    """The lead model on arriving rows."""
    inbox, out = scratch(t, "leads"), scratch(t, "scored")
    num, cat = ["total_visits", "time_spent"], ["lead_source"]
    lead = V.leads(t).select("lead_id", "total_visits", "time_spent", "lead_source", "converted")
    model = M.fit_lead_model(lead, num, cat)
    lead.drop("converted").write.parquet(inbox)
    s = t.spark.readStream.schema(lead.drop("converted").schema).parquet(inbox)
    streams.append_parquet(M.score_leads(s, model, 0.5, num, cat), out, scratch(t, "ck"), **ONCE).awaitTermination()
    return t.spark.read.parquet(out).select("lead_id", "pred_label", "pred_proba")


VALID = """lead_id IS NOT NULL AND total_visits >= 0 AND "Conversion_Probability" >= 0"""


@query(f"""SELECT "City", count(*) AS leads, round(avg("Conversion_Probability"), 6) AS mean FROM lead_events WHERE {VALID} GROUP BY 1""", "lead_events")
def stream_complete(t):
    """Running totals per city, all of them after each batch."""
    name = f"complete_{uuid.uuid4().hex}"
    totals = streams.quality_stream(streams.lead_stream(t.spark, lead_inbox(t))).groupBy("City").agg(F.count("*").alias("leads"), F.round(F.avg("Conversion_Probability"), 6).alias("mean"))
    streams.to_memory(totals, name, "complete", **ONCE).awaitTermination()
    return t.spark.table(name)


def _cycles(t, parts: int, run):
    """Files that arrive in ``parts`` lots, with a run of the stream after each."""
    inbox = scratch(t, "cycles")
    for i in range(parts):
        V.lead_events(t).filter(F.pmod(F.xxhash64("timestamp", "City"), F.lit(parts)) == i).write.mode("append").json(inbox)
        run(i, streams.lead_stream(t.spark, inbox))


@query(f"""SELECT "City", count(*) AS leads FROM lead_events WHERE {VALID} GROUP BY 1""", "lead_events")
def stream_resume(t):
    """A stream that stops and goes on from its checkpoint when more files are there: each row once."""
    out, mark = scratch(t, "resumed"), scratch(t, "ck")
    _cycles(t, 3, lambda i, s: streams.append_parquet(streams.quality_stream(s), out, mark, **ONCE).awaitTermination())
    return t.spark.read.parquet(out).groupBy("City").agg(F.count("*").alias("leads"))


@query(f"""SELECT (SELECT count(*) FROM lead_events WHERE {VALID}) AS leads, 3 AS cycles, true AS each_cycle_added""", "lead_events")
def stream_cycles(t):
    """A poll per cycle: what each adds to the sink's table, and all of them together."""
    out, mark, seen = scratch(t, "polled"), scratch(t, "ck"), []

    def poll(i, s):
        streams.append_json(streams.quality_stream(s), out, mark, **ONCE).awaitTermination()
        seen.append(t.spark.read.schema("lead_id string").json(out).count())
    _cycles(t, 3, poll)
    grew = all(a < b for a, b in zip([0, *seen], seen))
    return t.spark.read.schema("lead_id string").json(out).agg(F.count("*").alias("leads"), F.lit(len(seen)).alias("cycles"), F.lit(grew).alias("each_cycle_added"))
