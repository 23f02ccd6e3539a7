"""Text, vectors, hashes, JSON, chat routing, evaluation metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import rules as R, text as X, words as W
from ..functions.scalars import any_in, bad_json, clean_text, contains_any, first_n, row_md5, signature, squash_ws, tokens
from ..functions.vectors import cosine, dot, norm
from ..operators import derive as D, evaluation as EV, search as S
from ..sources import files, topics
from . import views as V
from .registry import query

POS_L, NEG_L, POS_S, NEG_S = map(str, (W.POSITIVE_LONG, W.NEGATIVE_LONG, W.POSITIVE_SHORT, W.NEGATIVE_SHORT))


def lex(p, n, text="lower(text)"):
    a, b = (f"len(list_filter({w}, lambda w: contains({text}, w)))" for w in (p, n))
    return f"CASE WHEN {a} > {b} THEN 'positive' WHEN {b} > {a} THEN 'negative' ELSE 'neutral' END"


@query(f"""SELECT doc_id, sentiment, CASE WHEN sentiment = 'neutral' THEN 0.5::DOUBLE ELSE 0.8::DOUBLE END AS confidence, short FROM (SELECT doc_id, {lex(POS_L, NEG_L)} AS sentiment, {lex(POS_S, NEG_S)} AS short FROM documents)""")
def lexicon_sentiment(t):
    d = D.lexicon_sentiment(t.documents, "text").withColumn("short", R.lexicon_label("text", "short"))
    return d.select("doc_id", "sentiment", "confidence", "short")


@query(f"""SELECT source, sentiment, count(*) AS articles FROM (SELECT 'src' || (doc_id % 7) AS source, {lex(POS_S, NEG_S, "lower(CASE WHEN doc_id % 5 = 0 THEN 'weak ' || lang ELSE text END)")} AS sentiment FROM documents) GROUP BY 1, 2""")
def news_signals(t):
    from ..streaming.streams import news_signals as ns
    k = F.col("doc_id")
    art = t.documents.select(F.concat(F.lit("src"), (k % 7).cast("string")).alias("Source"), F.col("lang").alias("Category"), F.concat(F.lit("weak "), "lang").alias("Title"),
                             F.lit("").alias("Published_Date"), F.when(k % 5 == 0, "").otherwise(F.col("text")).alias("Body_Text"))
    return ns(art).groupBy("source", "sentiment").agg(F.count("*").alias("articles"))


@query("""SELECT event_id, CASE WHEN event_id % 6 = 0 OR s < 0.6 THEN 'Neutral' WHEN event_type = 'click' THEN 'Positive' WHEN event_type = 'error' THEN 'Negative' ELSE 'Neutral' END AS label,
 CASE WHEN event_id % 6 = 0 THEN 0.5::DOUBLE ELSE s END AS score FROM (SELECT *, (event_id % 100) / 100.0::DOUBLE AS s FROM events)""")
def normalized_sentiment(t):
    e = t.events.select("event_id", F.when(F.col("event_type") == "click", "POSITIVE").when(F.col("event_type") == "error", "NEGATIVE").otherwise("other").alias("raw"),
                        ((F.col("event_id") % 100) / 100.0).alias("p"), F.when(F.col("event_id") % 6 == 0, " ").otherwise("text").alias("txt"))
    return D.normalize_sentiment(e, "raw", "p", "txt").select("event_id", "label", "score")


@query("""SELECT doc_id, length(x) AS full_chars, length(substr(x, 1, 1000)) AS scoring_chars FROM (SELECT doc_id, coalesce(nullif(CASE WHEN doc_id % 4 = 0 THEN '' ELSE text END, ''), nullif(lang, ''), '') AS x FROM documents)""")
def article_text(t):
    a = t.documents.select("doc_id", F.when(F.col("doc_id") % 4 == 0, "").otherwise(F.col("text")).alias("Body_Text"), F.col("lang").alias("Title"))
    return D.article_text(a).select("doc_id", F.length("text").alias("full_chars"), F.length("scoring_text").alias("scoring_chars"))


CLEAN = r"""trim(regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>', ' ', 'g'), '(?s)<!--.*?-->', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g'),
 '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&'), '[ \t\n\v\f\r]+', ' ', 'g'))"""


@query(f"SELECT page_id, length(c) AS chars, md5(c) AS digest FROM (SELECT page_id, {CLEAN} AS c FROM pages)")
def clean_html(t):
    c = t.pages.select("page_id", X.clean_html("html").alias("c"))
    return c.select("page_id", F.length("c").alias("chars"), F.md5("c").alias("digest"))


@query(f"""SELECT "Source", "Category", count(*) AS articles, CAST(sum(length(c)) AS BIGINT) AS body_chars FROM (SELECT CASE WHEN url LIKE '%moneycontrol%' THEN 'Moneycontrol' ELSE 'Economic Times' END AS "Source",
 CASE WHEN url LIKE '%mutual%' THEN 'Mutual Funds' ELSE 'Markets_Business' END AS "Category", c FROM (SELECT CASE WHEN page_id % 2 = 0 THEN 'https://moneycontrol.example/' WHEN page_id % 3 = 0 THEN 'https://x.example/mutual/' ELSE '' END || url AS url, {CLEAN} AS c FROM pages)) GROUP BY 1, 2""")
def shaped_articles(t):
    k = F.col("page_id")
    p = t.pages.select(F.concat(F.when(k % 2 == 0, "https://moneycontrol.example/").when(k % 3 == 0, "https://x.example/mutual/").otherwise(""), "url").alias("url"), F.col("html").alias("body"), F.col("url").alias("title"))
    return files.shape_articles(p).groupBy("Source", "Category").agg(F.count("*").alias("articles"), F.sum(F.length("Body_Text")).alias("body_chars"))


# ---- search --------------------------------------------------------------------------------

GRAMS = r"""tk AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}') AS w FROM documents),
gr AS (SELECT doc_id, unnest(list_concat(w, CASE WHEN len(w) > 1 THEN list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) ELSE [] END)) AS term FROM tk),
tf AS (SELECT doc_id, term, count(*) AS tf FROM gr GROUP BY 1, 2),
idf AS (SELECT term, ln((1 + (SELECT count(*) FROM documents)) / (1 + count(*))) + 1 AS idf FROM tf GROUP BY 1{having}),
raw AS (SELECT doc_id, term, tf * idf AS r FROM tf JOIN idf USING (term)),
wt AS (SELECT doc_id, term, r / sqrt(sum(r * r) OVER (PARTITION BY doc_id)) AS weight FROM raw)"""


@query("WITH " + GRAMS.replace("{having}", " HAVING count(*) >= 2") + " SELECT doc_id, count(*) AS terms, round(max(weight), 6) AS top_weight, round(sum(weight * weight), 6) AS length FROM wt GROUP BY 1")
def tfidf_weights(t):
    w = S.tfidf(t.documents, "doc_id", "text", bigrams=True, min_df=2)
    return w.groupBy("doc_id").agg(F.count("*").alias("terms"), F.round(F.max("weight"), 6).alias("top_weight"), F.round(F.sum(F.col("weight") * F.col("weight")), 6).alias("length"))


@query("WITH " + GRAMS.replace("{having}", "") + r""", qt AS (SELECT item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}') AS w FROM benchmark),
qg AS (SELECT item_id, unnest(list_concat(w, CASE WHEN len(w) > 1 THEN list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) ELSE [] END)) AS term FROM qt),
qr AS (SELECT item_id, term, count(*) * any_value(idf) AS r FROM qg JOIN idf USING (term) GROUP BY 1, 2),
qw AS (SELECT item_id, term, r / sqrt(sum(r * r) OVER (PARTITION BY item_id)) AS weight FROM qr),
sc AS (SELECT item_id, doc_id, round(sum(wt.weight * qw.weight) * 100, 2) AS match_score FROM qw JOIN wt USING (term) GROUP BY 1, 2)
SELECT item_id, doc_id, match_score, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY match_score DESC, doc_id) AS rank FROM sc WHERE match_score > 0) WHERE rank <= 5""")
def tfidf_search(t):
    return S.tfidf_search(t.benchmark, t.documents, "item_id", "text", "doc_id", "text", 5).select("item_id", "doc_id", "match_score", "rank")


@query("""SELECT query_vec_id, vec_id, CAST(rank AS INTEGER) AS rank, round(s, 4) AS match_score FROM (SELECT q.vec_id AS query_vec_id, c.vec_id, s, row_number() OVER (PARTITION BY q.vec_id ORDER BY round(s, 12) DESC, c.vec_id) AS rank
 FROM (SELECT q.vec_id, q.embedding::DOUBLE[] AS qe FROM embeddings q) q, LATERAL (SELECT c.vec_id, list_cosine_similarity(qe, c.embedding::DOUBLE[]) AS s FROM embeddings c) c) WHERE rank <= 5""")
def cosine_topk(t):
    """Every vector asked against all vectors."""
    return S.cosine_topk(t.embeddings, t.embeddings, "vec_id", "vec_id")


@query("""SELECT vec_id, round(sqrt(list_dot_product(e, e)), 6) AS norm, round(list_dot_product(e, list_reverse(e)), 6) AS dot, round(list_cosine_similarity(e, list_reverse(e)), 6) AS cosine FROM (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings)""")
def vector_arithmetic(t):
    e = t.embeddings.withColumn("r", F.reverse("embedding"))
    return e.select("vec_id", F.round(norm("embedding"), 6).alias("norm"), F.round(dot("embedding", "r"), 6).alias("dot"), F.round(cosine("embedding", "r"), 6).alias("cosine"))


# ---- chat ----------------------------------------------------------------------------------

INV, DIS, SCREEN = map(str, (W.INVESTOR_TERMS, W.DISTRIBUTOR_TERMS, W.SCREEN_TERMS))
TOPICS = ["sip and tax", "my lead has an objection", "sebi compliance", "explain the chart", "best fund for retirement", "buy now or lumpsum", "portfolio rebalance", ""]


def routed_sql():
    whens = " ".join("WHEN " + " OR ".join(f"contains(u, '{w}')" for w in ws) + f" THEN '{n}'" for n, ws in W.INTENTS)
    n = lambda ws: f"len(list_filter({ws}, lambda w: contains(u, w)))"
    return f"""ut AS (SELECT conv_id, turn, trim(regexp_replace(lower(list_extract({TOPICS}, CAST((conv_id + turn) % 8 + 1 AS BIGINT)) || ' ' || text), '[ \\t\\n\\v\\f\\r]+', ' ', 'g')) AS u FROM chat),
ro AS (SELECT conv_id, turn, u, CASE WHEN conv_id % 10 = 0 THEN 'distributor' WHEN {n(DIS)} > {n(INV)} THEN 'distributor' WHEN {n(INV)} > {n(DIS)} THEN 'investor' ELSE 'both' END AS audience,
 CASE {whens} ELSE 'general' END AS intent, {n(SCREEN)} > 0 AS asks_about_screen FROM ut)"""


def routed(t):
    topic = F.element_at(F.array(*[F.lit(x) for x in TOPICS]), ((F.col("conv_id") + F.col("turn")) % 8 + 1).cast("int"))
    c = V.chat(t).withColumn("text", F.concat_ws(" ", topic, "text")).withColumn("has_lead", F.col("conv_id") % 10 == 0)
    return D.route_utterances(c, "text", "has_lead")


@query(f"WITH {routed_sql()} SELECT conv_id, turn, audience, intent, asks_about_screen FROM ro", "chat")
def routed_utterances(t):
    return routed(t).select("conv_id", "turn", "audience", "intent", "asks_about_screen")


WORDS_OF = r"regexp_extract_all(lower({0}), '[\p{{L}}\p{{N}}_]{{2,}}')"
WITH_PAIRS = "unnest(list_concat(w, CASE WHEN len(w) > 1 THEN list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) ELSE [] END))"


@query(f"""WITH {routed_sql()}, kb AS (SELECT 'item ' || item_id AS title, CASE item_id % 3 WHEN 0 THEN 'both' WHEN 1 THEN 'investor' ELSE 'distributor' END AS aud, {WORDS_OF.format('text')} AS w FROM benchmark),
kg AS (SELECT title, term, count(*) AS tf FROM (SELECT title, {WITH_PAIRS} AS term FROM kb) GROUP BY 1, 2),
idf AS (SELECT term, ln((1 + (SELECT count(*) FROM kb)) / (1 + count(*))) + 1 AS idf FROM kg GROUP BY 1),
kw AS (SELECT title, term, r / sqrt(sum(r * r) OVER (PARTITION BY title)) AS weight FROM (SELECT title, term, tf * idf AS r FROM kg JOIN idf USING (term))),
us AS (SELECT conv_id || '-' || turn AS cid, audience, intent, u, {WORDS_OF.format('u')} AS w FROM ro),
ug AS (SELECT cid, term, count(*) * any_value(idf) AS r FROM (SELECT cid, {WITH_PAIRS} AS term FROM us) JOIN idf USING (term) GROUP BY 1, 2),
uw AS (SELECT cid, term, r / sqrt(sum(r * r) OVER (PARTITION BY cid)) AS weight FROM ug),
sc AS (SELECT cid, kb.title, kb.aud, sum(uw.weight * kw.weight) AS score FROM uw JOIN kw USING (term) JOIN kb USING (title) JOIN us USING (cid)
 WHERE us.audience = 'both' OR kb.aud = 'both' OR kb.aud = us.audience GROUP BY 1, 2, 3),
be AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY cid ORDER BY round(score, 9) DESC, title) AS rn FROM sc) WHERE rn = 1),
fi AS (SELECT us.cid, min(kb.title) AS title FROM us JOIN kb ON us.audience = 'both' OR kb.aud = 'both' OR kb.aud = us.audience GROUP BY 1),
al AS (SELECT us.*, coalesce(be.title, fi.title) AS best, coalesce(be.score, 0) AS base FROM us LEFT JOIN be USING (cid) LEFT JOIN fi USING (cid)),
hi AS (SELECT al.*, kb.aud, len(list_filter(kb.w[1:3], lambda x: contains(al.u, x))) AS hits FROM al LEFT JOIN kb ON kb.title = al.best),
bo AS (SELECT *, CASE WHEN hits > 0 THEN least(1, base + 0.04::DOUBLE * hits) ELSE base END AS s FROM hi),
we AS (SELECT *, best IS NULL OR intent = 'general' AND s < 0.12::DOUBLE AS weak FROM bo),
fo AS (SELECT *, CASE WHEN weak THEN (SELECT title FROM kb WHERE title = 'item 0') ELSE best END AS topic, CASE WHEN weak THEN (SELECT aud FROM kb WHERE title = 'item 0') ELSE aud END AS of_topic FROM we)
SELECT cid, audience, intent, topic AS matched_topic, round(least(least(0.97::DOUBLE, 0.42::DOUBLE + s * 2) + CASE WHEN audience <> 'both' AND of_topic = audience THEN 0.05::DOUBLE ELSE 0 END, 0.97::DOUBLE), 2) AS confidence FROM fo""", "chat")
def knowledge_retrieval(t):
    """Best knowledge item per utterance; the knowledge base is derived from the benchmark passages."""
    k = F.col("item_id")
    kb = t.benchmark.select(F.concat(F.lit("item "), k.cast("string")).alias("title"), F.when(k % 3 == 0, "both").when(k % 3 == 1, "investor").otherwise("distributor").alias("audience"),
                            F.slice(X.terms("text"), 1, 3).alias("tags"), "text")
    chat = routed(t).withColumn("cid", F.concat_ws("-", "conv_id", "turn"))
    return S.kb_retrieve(chat, kb, "cid", "utterance", "item 0").select("cid", "audience", "intent", "matched_topic", "confidence")


# ---- scalar families -----------------------------------------------------------------------

@query(r"""SELECT doc_id, length(trim(regexp_replace(lower(text), '[ \t\n\v\f\r]+', ' ', 'g'))) AS clean_chars, contains(lower(text), 'tion') OR contains(lower(text), 'zz') AS hit,
 len(list_filter(regexp_split_to_array(lower(text), '[^a-z0-9]+'), lambda w: length(w) >= 3)) AS words, md5(CAST(doc_id AS VARCHAR) || '_' || lang) AS digest FROM documents""")
def text_functions(t):
    return t.documents.select("doc_id", F.length(clean_text("text")).alias("clean_chars"), contains_any(F.lower("text"), ["tion", "zz"]).alias("hit"),
                              F.size(tokens("text", 3)).alias("words"), row_md5(["doc_id", "lang"]).alias("digest"))


@query("""SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events WHERE event_id % 9 <> 0""")
def json_parsing(t):
    e = t.events.withColumn("value", F.when(F.col("event_id") % 9 == 0, "{broken").otherwise(F.to_json(F.struct("event_id", F.from_json("props", "k long").alias("p")))))
    d = topics.decode(e.select("value"), "event_id long, p struct<k: long>")
    return d.select("event_id", F.col("p.k").alias("k"))


@query("""SELECT count(*) AS broken FROM events WHERE event_id % 9 = 0""")
def json_quarantine(t):
    e = t.events.select(F.when(F.col("event_id") % 9 == 0, "{broken").otherwise(F.col("props")).alias("value"))
    return topics.undecodable(e).agg(F.count("*").alias("broken"))


@query("""SELECT event_id, 'NIFTY ' || (event_id % 5) AS "Market", vix * 100 AS "Last_Price", CASE WHEN event_id % 8 = 0 THEN NULL ELSE change_pct END AS "Pct_Change" FROM events JOIN market ON snap = event_id
UNION ALL SELECT event_id, 'BANK', 1.0::DOUBLE, 2.5::DOUBLE FROM events""", "market")
def market_state_rows(t):
    m = V.market(t)
    row = lambda name, last, pct: F.struct(name.alias("market"), F.lit("Open").alias("marketStatus"), F.lit("d").alias("tradeDate"), F.col("snap").cast("string").alias("index"),
                                           last.cast("string").alias("last"), F.lit("0").alias("variation"), pct.cast("string").alias("percentChange"))
    doc = F.to_json(F.struct(F.array(row(F.concat(F.lit("NIFTY "), (F.col("snap") % 5).cast("string")), F.col("vix") * 100, F.when(F.col("snap") % 8 == 0, "-").otherwise(F.col("change_pct").cast("string"))),
                                     row(F.lit("BANK"), F.lit(1.0), F.lit(2.5))).alias("marketState")))
    out = files.flatten_market_state(m.select("ts", doc.alias("j")), "j", "ts")
    return out.select(F.col("Index").cast("bigint").alias("event_id"), "Market", "Last_Price", "Pct_Change")


@query("""SELECT event_id, isodow(ts) - 1 AS weekday, hour(ts) * 60 + minute(ts) AS minute_of_day, CAST(ts AS DATE) AS day FROM events""")
def date_functions(t):
    from ..functions.scalars import epoch_ts, minute_of_day, parse_date, parse_ts
    e = t.events.withColumn("txt", F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).withColumn("dmy", F.date_format("ts", "dd-MMM-yyyy"))
    back = epoch_ts(F.unix_millis(F.col("ts").cast("timestamp")), "ms")
    return e.select("event_id", F.weekday(parse_ts("txt")).cast("bigint").alias("weekday"), minute_of_day(back).cast("bigint").alias("minute_of_day"), parse_date("dmy").alias("day"))


@query("""SELECT o_custkey, max(CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 0 END) = 1 AS urgent, array_to_string(list(DISTINCT o_orderstatus ORDER BY o_orderstatus)[1:2], ',') AS first_two FROM orders GROUP BY 1""")
def array_functions(t):
    a = t.orders.groupBy("o_custkey").agg(F.collect_set("o_orderpriority").alias("p"), F.array_sort(F.collect_set("o_orderstatus")).alias("s"))
    return a.select("o_custkey", any_in("p", ["1-URGENT", "2-HIGH"]).alias("urgent"), F.array_join(first_n("s", 2), ",").alias("first_two"))


# ---- evaluation ----------------------------------------------------------------------------

SCORED = "sx AS (SELECT lead_id, p, CASE WHEN p >= 0.5 THEN 1 ELSE 0 END AS pred, CASE WHEN (c_custkey * 7919 % 100) / 100.0 < p THEN 1 ELSE 0 END AS y FROM (SELECT *, round(conversion_probability, 2) AS p FROM leads))"


def scored(t):
    v = V.leads(t).select("lead_id", "c_custkey", F.round("conversion_probability", 2).alias("p"))
    return v.select("lead_id", "p", (F.col("p") >= 0.5).cast("int").alias("pred"), ((F.col("c_custkey") * 7919 % 100) / 100.0 < F.col("p")).cast("int").alias("y"))


@query(f"""WITH {SCORED}, c AS (SELECT cls, count(*) FILTER (y = cls AND pred = cls) AS tp, count(*) FILTER (y = cls) AS s, count(*) FILTER (pred = cls) AS k FROM sx, (VALUES (0), (1)) v(cls) GROUP BY 1),
m AS (SELECT CAST(cls AS VARCHAR) AS class, tp, s, tp / k AS p, tp / s AS r, 2.0::DOUBLE * tp / (k + s) AS f FROM c)
SELECT class, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1, s AS support FROM m
UNION ALL SELECT 'accuracy', round(sum(tp) / sum(s), 6), round(sum(tp) / sum(s), 6), round(sum(tp) / sum(s), 6), CAST(sum(s) AS BIGINT) FROM m
UNION ALL SELECT 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6), CAST(sum(s) AS BIGINT) FROM m
UNION ALL SELECT 'weighted avg', round(sum(p * s) / sum(s), 6), round(sum(r * s) / sum(s), 6), round(sum(f * s) / sum(s), 6), CAST(sum(s) AS BIGINT) FROM m""", "leads")
def classification_report(t):
    r = EV.classification_report(scored(t), "y", "pred")
    return r.select("class", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")], "support")


@query(f"""WITH {SCORED}, r AS (SELECT y, (rank() OVER (ORDER BY p) + rank() OVER (ORDER BY p) + count(*) OVER (PARTITION BY p) - 1) / 2.0::DOUBLE AS rk FROM sx)
SELECT round((sum(rk) FILTER (y = 1) - count(*) FILTER (y = 1) * (count(*) FILTER (y = 1) + 1) / 2) / (count(*) FILTER (y = 1) * count(*) FILTER (y = 0)), 8) AS roc_auc FROM r""", "leads")
def roc_auc(t):
    return EV.roc_auc(scored(t), "y", "p").withColumn("roc_auc", F.round("roc_auc", 8))


CURVE = """cu AS (SELECT p, sum(y) AS dp, sum(sum(y)) OVER (ORDER BY p DESC) AS tp, sum(count(*) - sum(y)) OVER (ORDER BY p DESC) AS fp FROM sx GROUP BY 1)"""


@query(f"""WITH {SCORED}, {CURVE} SELECT round(sum(dp * tp / (tp + fp)) / max(tp), 8) AS average_precision FROM cu""", "leads")
def average_precision(t):
    return EV.average_precision(scored(t), "y", "p").withColumn("average_precision", F.round("average_precision", 8))


@query(f"""WITH {SCORED}, {CURVE} SELECT p AS threshold, round(fp / max(fp) OVER (), 8) AS fpr, round(tp / max(tp) OVER (), 8) AS tpr FROM cu""", "leads")
def roc_curve(t):
    c = EV.roc_curve(scored(t), "y", "p").filter(F.col("threshold") < float("inf"))
    return c.select("threshold", F.round("fpr", 8).alias("fpr"), F.round("tpr", 8).alias("tpr"))


TH = """th AS (SELECT k, t, count(*) FILTER (p >= t AND y = 1) AS tp, count(*) FILTER (p >= t) AS called, count(*) FILTER (y = 1) AS pos FROM sx, (SELECT k, round(0.25::DOUBLE + 0.02::DOUBLE * k, 2) AS t FROM (SELECT unnest(range(29)) AS k)) GROUP BY 1, 2),
tf AS (SELECT k, t, tp / called AS pr, tp / pos AS rc, 2.0::DOUBLE * tp / (called + pos) AS f1 FROM th)"""


@query(f"WITH {SCORED}, {TH} SELECT t AS threshold, round(pr, 8) AS precision, round(rc, 8) AS recall, round(f1, 8) AS f1 FROM tf", "leads")
def threshold_curve(t):
    c = EV.threshold_curve(scored(t), "y", "p")
    return c.select("threshold", *[F.round(x, 8).alias(x) for x in ("precision", "recall", "f1")])


@query(f"WITH {SCORED}, {TH} SELECT t AS threshold, round(pr, 8) AS precision, round(rc, 8) AS recall, round(f1, 8) AS f1 FROM tf ORDER BY f1 DESC, k LIMIT 1", "leads")
def threshold_search(t):
    c = EV.threshold_search(scored(t), "y", "p")
    return c.select("threshold", *[F.round(x, 8).alias(x) for x in ("precision", "recall", "f1")])


REG = "SELECT avg(pow(l_extendedprice - yh, 2)) AS mse, avg(abs(l_extendedprice - yh)) AS mae, var_pop(l_extendedprice) AS v FROM (SELECT l_extendedprice, l_quantity * 1000.5 AS yh FROM lineitem)"


@query(f"SELECT round(mse, 2) AS mse, round(sqrt(mse), 4) AS rmse, round(mae, 4) AS mae, round(1 - mse / v, 8) AS r2 FROM ({REG})")
def regression_metrics(t):
    r = EV.regression_metrics(t.lineitem.select("l_extendedprice", (F.col("l_quantity") * 1000.5).alias("yh")), "l_extendedprice", "yh")
    return r.select(F.round("mse", 2).alias("mse"), F.round("rmse", 4).alias("rmse"), F.round("mae", 4).alias("mae"), F.round("r2", 8).alias("r2"))


@query(f"""WITH {SCORED} SELECT 'lead' AS model, 'rate' AS metric, round(avg(y), 8) AS value FROM sx UNION ALL SELECT 'price', 'mse', round(mse, 2) FROM ({REG}) UNION ALL SELECT 'price', 'mae', round(mae, 4) FROM ({REG})""", "leads")
def metrics_manifest(t):
    a = EV.metrics_long(scored(t).agg(F.round(F.avg("y"), 8).alias("rate")), "lead")
    r = EV.regression_metrics(t.lineitem.select("l_extendedprice", (F.col("l_quantity") * 1000.5).alias("yh")), "l_extendedprice", "yh")
    b = EV.metrics_long(r.select(F.round("mse", 2).alias("mse"), F.round("mae", 4).alias("mae")), "price")
    return EV.metrics_manifest(a, b)
