import json
import uuid

import pytest
from pyspark.sql import functions as F, types as T

from fundloom.plans import etl
from fundloom.sources import files, sinks, topics
from fundloom.streaming import drift, streams, upsert

ONCE = {"availableNow": True}


def lead(i, city="Pune", visits=1.0, prob=0.5, ts="2024-01-01 10:00:00", **kw):
    return {"lead_id": f"L{i}" if i is not None else None, "City": city, "total_visits": visits, "Conversion_Probability": prob, "timestamp": ts, **kw}


def drop(folder, rows):
    folder.mkdir(exist_ok=True)
    (folder / f"{uuid.uuid4().hex}.json").write_text("\n".join(json.dumps(r) for r in rows))


def test_quarantine(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.csv").write_text("id,amount\n1,2.5\nbad,3\n2,oops\n")
    good, bad = files.read_csv_quarantine(spark, str(tmp_path), T.StructType().add("id", "integer").add("amount", "double"))
    assert [tuple(r) for r in good.collect()] == [(1, 2.5)]
    assert sorted(r["_corrupt_record"] for r in bad.collect()) == ["2,oops", "bad,3"]


def test_entity_folder(spark, tmp_path):
    (tmp_path / "100_history.csv").write_text(" Date , NAV\n05-03-2024,1.5\n")
    (tmp_path / "101.csv").write_text(" Date , NAV\n06-03-2024,2.5\n")
    df = files.read_entity_dir(spark, str(tmp_path), "scheme")
    assert sorted((r["scheme"], str(r["date"]), float(r["nav"])) for r in df.collect()) == [("100", "2024-03-05", 1.5), ("101", "2024-03-06", 2.5)]


def test_prefer_clean(spark, tmp_path):
    (tmp_path / "raw.csv").write_text("Total Visits\n1\n")
    assert files.read_prefer_clean(spark, str(tmp_path / "none"), str(tmp_path / "raw.csv")).columns == ["total_visits"]
    spark.range(1).write.parquet(str(tmp_path / "clean"))
    assert files.read_prefer_clean(spark, str(tmp_path / "clean"), str(tmp_path / "raw.csv")).columns == ["id"]
    with pytest.raises(FileNotFoundError):
        files.read_prefer_clean(spark, str(tmp_path / "no"), str(tmp_path / "nope"))


def test_merge_history(spark, tmp_path):
    for n, day in (("a", "02-Jan-2024"), ("b", "01-Jan-2024")):
        (tmp_path / n).mkdir()
        (tmp_path / n / "x.csv").write_text(f"Date ,Close\n{day},5\n")
    df = files.merge_history(spark, [str(tmp_path / "a"), str(tmp_path / "b")])
    assert [str(r["Date"]) for r in df.collect()] == ["2024-01-01", "2024-01-02"]


def test_nav_text(spark, tmp_path):
    (tmp_path / "n.txt").write_text("Scheme Code;a;b;c;d;e\n9;x;y;Early;1.5;01-Jan-2024\n\nDebt Funds\n1;x;y;One;N.A.;01-Jan-2024\n2;x\nEquity Funds\n3;x;y; Three ;7;02-Jan-2024\n")
    got = sorted((r["Scheme_Code"], r["Category"], r["Scheme_Name"], r["Net_Asset_Value"]) for r in files.parse_nav_text(spark, str(tmp_path)).collect())
    assert got == [("1", "Debt Funds", "One", None), ("3", "Equity Funds", "Three", 7.0), ("9", "Unknown", "Early", 1.5)]


def test_json_docs_and_rss(spark, tmp_path):
    (tmp_path / "j").mkdir()
    (tmp_path / "j" / "d.json").write_text('{\n "a": 1\n}')
    assert files.read_json_docs(spark, str(tmp_path / "j")).first()["a"] == 1
    (tmp_path / "feed.xml").write_text("<rss><channel><item><title>T</title><link>http://l</link></item></channel></rss>")
    r = files.rss_items(spark, str(tmp_path / "feed.xml"), summary_width=200).first()
    assert (r["source"], r["title"], r["summary"], r["published"]) == ("feed", "T", "", "")


def test_inventory_reads_no_content(spark, tmp_path):
    (tmp_path / "raw" / "d").mkdir(parents=True)
    (tmp_path / "raw" / "d" / "a.txt").write_text("x" * 1000)
    (tmp_path / "raw" / "d" / "b.txt").write_text("x" * 1000)
    got = {r["data_type"]: (r["files"], r["dirs"], r["bytes"]) for r in files.dataset_inventory(spark, str(tmp_path)).collect()}
    assert got == {"raw": (2, 1, 2000), "TOTAL": (2, 1, 2000)}
    d = files.duplicate_files(spark, str(tmp_path)).first()
    assert (d["copies"], d["redundant_bytes"]) == (2, 1000)


def test_sinks(spark, tmp_path):
    df = spark.range(10).withColumn("p", F.col("id") % 2)
    sinks.write_parquet(df, str(tmp_path / "pq"), ["p"])
    sinks.write_parquet(df, str(tmp_path / "pq"), ["p"])
    assert spark.read.parquet(str(tmp_path / "pq")).count() == 10
    sinks.write_csv(df, str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 10
    sinks.write_kpis(df.agg(F.count("*").alias("n")), str(tmp_path / "kpi"))
    assert spark.read.json(str(tmp_path / "kpi" / "json")).first()["value"] == "10"


def test_topic_round_trip(spark):
    df = spark.createDataFrame([("x", 1), ("y", None)], "a string, b int")
    back = topics.decode(topics.encode(df, "a"), "a string, b int")
    assert sorted(map(tuple, back.collect()), key=str) == [("x", 1), ("y", None)]


def test_article_names(spark):
    df = spark.createDataFrame([("https://moneycontrol.x/mutual", "<b>NAV: up & up!</b>", "<p>Body</p>")], "url string, title string, body string")
    r = files.shape_articles(df).first()
    assert (r["Source"], r["Category"], r["file_name"], r["Body_Text"]) == ("Moneycontrol", "Mutual Funds", "Moneycontrol_Mutual Funds_NAV_up__up", "Body")


def test_lead_etl(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("Total Visits,Converted,City\n1,0,X\n1,0,X\n,1,\n")
    prof = {r["column"]: r["nulls"] for r in etl.lead_etl(spark, str(tmp_path / "in"), str(tmp_path / "out")).collect()}
    assert prof == {"total_visits": 0, "city": 1, "converted": 0}
    assert (tmp_path / "out" / "converted=1").exists()


# ---- streams -------------------------------------------------------------------------------

def test_restart_reads_only_new_files(spark, tmp_path):
    inbox, out, ck = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ck")
    run = lambda: streams.append_parquet(streams.quality_stream(streams.lead_stream(spark, str(inbox))), out, ck, **ONCE).awaitTermination()
    drop(inbox, [lead(1), lead(2, visits=-1.0)])
    run()
    drop(inbox, [lead(3), lead(None)])
    run()
    assert sorted(r["lead_id"] for r in spark.read.parquet(out).collect()) == ["L1", "L3"]


def test_stream_equals_batch_and_late_rows_are_dropped(spark, tmp_path):
    inbox, ck = tmp_path / "in", str(tmp_path / "ck")
    inbox.mkdir()
    early = [lead(i, ts=f"2024-01-01 10:{i:02d}:10", prob=0.1 * (i % 7)) for i in range(30)]
    m = streams.city_metrics(streams.lead_stream(spark, str(inbox)), "1 minute", "30 seconds", "5 minutes")
    run = lambda: streams.metrics_sink(m, str(tmp_path / "out"), ck, **ONCE).awaitTermination()
    drop(inbox, early)
    run()
    drop(inbox, [lead(99, ts="2024-01-01 10:00:10"), lead(100, ts="2024-01-01 12:00:00")])
    run()
    got = {(r["window_start"], r["City"]): r["lead_count"] for r in spark.read.json(str(tmp_path / "out")).collect()}
    batch = streams.city_metrics(spark.createDataFrame(early, streams.LEAD_SCHEMA), watermark=None)
    assert sum(got.values()) == sum(r["lead_count"] for r in batch.collect()) == 60


def test_complete_mode_memory_sink(spark, tmp_path):
    drop(tmp_path / "in", [lead(1), lead(2, city="Goa")])
    q = streams.to_memory(streams.city_metrics(streams.lead_stream(spark, str(tmp_path / "in")), "1 minute", None), "city_now", **ONCE)
    q.awaitTermination()
    assert spark.table("city_now").count() == 2


def test_upsert_is_idempotent(spark, tmp_path):
    table = str(tmp_path / "t")
    schema = "lead_id string, status string, t int"
    a = spark.createDataFrame([("1", "New", 1), ("1", "Hot", 2), ("2", None, 1), (None, "x", 1)], schema)
    b = spark.createDataFrame([("1", "Won", 3)], schema)
    for batch, i in ((a, 0), (b, 1), (b, 1), (a, 0)):
        upsert.merge_batch(batch, i, table, "lead_id", ["t"], 8)
    got = {r["lead_id"]: (r["status"], r["notes"]) for r in upsert.read_table(spark, table).collect()}
    assert got == {"1": ("Won", ""), "2": ("New", "")}


def test_upsert_stream_over_batches(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    s = streams.lead_stream(spark, str(inbox), 1).select("lead_id", "City", "timestamp")
    run = lambda: upsert.foreach_batch_upsert(s, "lead_id", str(tmp_path / "t"), str(tmp_path / "ck"), ["timestamp"], 8, **ONCE).awaitTermination()
    drop(inbox, [lead(1, "A"), lead(2, "B")])
    run()
    drop(inbox, [lead(1, "C", ts="2024-01-02 10:00:00")])
    run()
    assert {r["lead_id"]: r["City"] for r in upsert.read_table(spark, str(tmp_path / "t")).collect()} == {"L1": "C", "L2": "B"}


def test_upsert_survives_a_reset_and_rewrites_only_touched_buckets(spark, tmp_path):
    table = str(tmp_path / "t")
    rows = lambda *r: spark.createDataFrame(list(r), "lead_id string, n int")
    upsert.merge_batch(rows(*[(f"k{i}", 0) for i in range(200)]), 0, table, "lead_id", ["n"], 32, source="a")
    before = upsert._manifest(spark, table)["buckets"]
    upsert.merge_batch(rows(("k1", 1)), 1, table, "lead_id", ["n"], 32, source="a")
    after = upsert._manifest(spark, table)["buckets"]
    assert sum(before[b] != after[b] for b in before) == 1
    # a checkpoint that was reset counts from 0 again, under another id
    upsert.merge_batch(rows(("new", 2)), 0, table, "lead_id", ["n"], 32, source="b")
    for _ in range(2):
        upsert.merge_batch(rows(("k1", 9)), 0, table, "lead_id", ["n"], 32, source="a")
    got = {r["lead_id"]: r["n"] for r in upsert.read_table(spark, table).collect()}
    assert len(got) == 201 and got["k1"] == 1 and got["new"] == 2 and got["k0"] == 0
    for i in range(1, 6):
        upsert.merge_batch(rows(("k2", i)), i, table, "lead_id", ["n"], 32, source="b")
    assert upsert.read_table(spark, table).filter("lead_id = 'k2'").first()["n"] == 5
    assert len(upsert._marks(spark, table)) == 2


def test_two_writers_of_one_version_lose_nothing(spark, tmp_path, monkeypatch):
    table = str(tmp_path / "t")
    rows = lambda *r: spark.createDataFrame(list(r), "lead_id string, n int")
    upsert.merge_batch(rows(("a", 0)), 0, table, "lead_id", ["n"], 4, source="x")
    real, other = upsert._commit, []

    def late(session, path, after):
        if not other:
            # another writer takes the version first
            other.append(after["version"])
            upsert.merge_batch(rows(("b", 7), ("a", 5)), 0, table, "lead_id", ["n"], 4, source="y")
        return real(session, path, after)
    monkeypatch.setattr(upsert, "_commit", late)
    upsert.merge_batch(rows(("c", 1), ("a", 9)), 1, table, "lead_id", ["n"], 4, source="x")
    assert {r["lead_id"]: r["n"] for r in upsert.read_table(spark, table).collect()} == {"a": 9, "b": 7, "c": 1}
    assert upsert._manifest(spark, table)["version"] == 2 and upsert._manifest(spark, table)["seen"] == {"x": 1, "y": 0}


def test_a_mark_that_was_not_finished_does_not_count(spark, tmp_path):
    table = str(tmp_path / "t")
    rows = lambda *r: spark.createDataFrame(list(r), "lead_id string, n int")
    upsert.merge_batch(rows(("a", 0)), 0, table, "lead_id", ["n"], 4)
    (tmp_path / "t" / "_versions" / f"{1:012d}").write_text('{"version": 1, "cou')
    assert upsert.read_table(spark, table).count() == 1
    upsert.merge_batch(rows(("b", 1)), 1, table, "lead_id", ["n"], 4)
    assert upsert.read_table(spark, table).count() == 2 and upsert._manifest(spark, table)["version"] == 2


def test_a_table_that_has_grown_gets_more_buckets(spark, tmp_path):
    table = str(tmp_path / "t")
    rows = spark.range(300).selectExpr("cast(id as string) as lead_id", "cast(id as int) as n")
    upsert.merge_batch(rows, 0, table, "lead_id", ["n"], 3)
    upsert.rebucket(spark, table, "lead_id", 12)
    assert len(upsert._manifest(spark, table)["buckets"]) == 12 and upsert.read_table(spark, table).count() == 300
    upsert.merge_batch(spark.createDataFrame([("5", 77)], "lead_id string, n int"), 1, table, "lead_id", ["n"], 3)
    assert upsert.read_table(spark, table).filter("lead_id = '5'").first()["n"] == 77 and upsert.read_table(spark, table).count() == 300


def test_drift_stream_keeps_state(spark, tmp_path):
    inbox, out = tmp_path / "in", str(tmp_path / "out")
    schema = "ts timestamp, title string, source string, sentiment string, confidence double"

    def feed(lo, hi, mood):
        drop(inbox, [{"ts": f"2024-01-01T10:{i:02d}:00Z", "title": f"t{i}", "source": "s", "sentiment": mood, "confidence": 1.0} for i in range(lo, hi)])
        s = spark.readStream.schema(schema).json(str(inbox))
        drift.drift_sink(s, str(tmp_path / "state"), out, str(tmp_path / "ck"), **ONCE).awaitTermination()

    feed(0, 11, "negative")
    feed(11, 14, "negative")
    feed(14, 30, "negative")
    got = [(r["samples"], r["drift_detected"], r["retrain_requested"]) for r in drift.read_status(spark, out).orderBy("samples").collect()]
    # no drift below 12 samples; one request, the next one waits for the cooldown
    assert got == [(11, False, False), (14, True, True), (30, True, False)]


def test_stream_dedupe(spark, tmp_path):
    inbox, out, ck = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ck")
    inbox.mkdir()
    s = spark.readStream.schema("ts timestamp, title string").json(str(inbox))
    run = lambda: streams.append_json(streams.dedupe_stream(s, ["title"], "ts", "1 hour"), out, ck, **ONCE).awaitTermination()
    drop(inbox, [{"ts": "2024-01-01T10:00:00Z", "title": "a"}, {"ts": "2024-01-01T10:01:00Z", "title": "a"}])
    run()
    drop(inbox, [{"ts": "2024-01-01T10:20:00Z", "title": "a"}, {"ts": "2024-01-01T10:21:00Z", "title": "b"}])
    run()
    assert sorted(r["title"] for r in spark.read.json(out).collect()) == ["a", "b"]


def test_news_signals(spark):
    df = spark.createDataFrame([("S", "C", "Strong profit", "d", ""), ("S", "C", "T", "d", "weak loss")], "Source string, Category string, Title string, Published_Date string, Body_Text string")
    assert [(r["sentiment"], r["confidence"]) for r in streams.news_signals(df).collect()] == [("positive", 0.8), ("negative", 0.8)]
