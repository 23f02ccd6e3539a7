"""Files and folders to DataFrames."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from ..functions.scalars import parse_date, row_md5
from ..functions.text import clean_html
from ..operators.quality import normalize_columns

CORRUPT = "_corrupt_record"


def read_csv_tree(spark: SparkSession, path: str, schema=None, **opts) -> DataFrame:
    """All CSV files below a folder. With a schema there is no inference pass over the data."""
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE").option("recursiveFileLookup", True).options(**opts)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def read_csv_quarantine(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(good, bad) rows; bad ones keep their text in ``_corrupt_record``."""
    full = schema if CORRUPT in schema.names else T.StructType([*schema.fields]).add(CORRUPT, T.StringType())
    df = read_csv_tree(spark, path, full, columnNameOfCorruptRecord=CORRUPT)
    # every column is read either way: with pruned columns Spark would not look at the cells that make a row bad
    whole = F.length(F.concat_ws("", *[F.col(f"`{c}`").cast("string") for c in df.columns if c != CORRUPT])) >= 0
    bad = F.col(CORRUPT).isNotNull()
    return df.filter(whole & ~bad).drop(CORRUPT), df.filter(whole & bad)


def read_json_docs(spark: SparkSession, path: str, schema=None) -> DataFrame:
    reader = spark.read.option("multiLine", True).option("mode", "PERMISSIVE").option("recursiveFileLookup", True)
    return (reader.schema(schema) if schema is not None else reader).json(path)


def read_parquet_dir(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def add_source_path(df: DataFrame, name: str = "_source_file") -> DataFrame:
    """Path of the file each row came from; call it right after reading."""
    try:
        return df.select("*", F.col("_metadata.file_path").alias(name))
    except Exception:  # sources without file metadata
        return df.withColumn(name, F.input_file_name())


def read_entity_dir(spark: SparkSession, path: str, key: str, schema=None, date_col: str = "date") -> DataFrame:
    """One file per entity to one table; the key is the file stem without a ``_history`` ending. A single read, not one
    job per file."""
    raw = read_csv_tree(spark, path, schema)
    # file names come as in a URL
    name = F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))
    stem = F.regexp_extract(name, r"^(.*?)(_history)?\.csv$", 1)
    df = raw.select(stem.alias(key), *[F.col(f"`{c}`").alias(c.strip().lower()) for c in raw.columns])
    if date_col in df.columns and not isinstance(df.schema[date_col].dataType, (T.DateType, T.TimestampType)):
        df = df.withColumn(date_col, parse_date(date_col))
    return df


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def read_prefer_clean(spark: SparkSession, parquet: str, csv: str) -> DataFrame:
    """The cleaned Parquet when it is there and has rows, else the raw CSV with normalised names."""
    if path_exists(spark, parquet):
        df = spark.read.parquet(parquet)
        if not df.isEmpty():
            return df
    if path_exists(spark, csv):
        return normalize_columns(read_csv_tree(spark, csv), "strict")
    raise FileNotFoundError(f"neither {parquet} nor {csv}")


def merge_history(spark: SparkSession, paths: str | list[str], date_col: str = "Date") -> DataFrame:
    """Same-shape CSV files as one table, header blanks stripped, dates parsed, rows sorted by date."""
    parts = []
    for p in [paths] if isinstance(paths, str) else paths:
        raw = spark.read.option("header", True).option("inferSchema", True).option("recursiveFileLookup", True).csv(p)
        part = raw.toDF(*[c.strip() for c in raw.columns])
        # parts may write dates in different ways
        parts.append(part.withColumn(date_col, F.col(date_col).cast("string")) if date_col in part.columns else part)
    df = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return df.withColumn(date_col, parse_date(date_col)).orderBy(date_col)


def parse_nav_text(spark: SparkSession, path: str) -> DataFrame:
    """Semicolon NAV snapshots: a line without ``;`` names the category of the lines after it.

    Line order only exists within a file, so each snapshot is one row until it is split; many snapshots run in parallel.
    """
    lines = (
        spark.read.option("wholetext", True).option("recursiveFileLookup", True).text(path)
        .select(F.col("_metadata.file_path").alias("_source_file"), F.posexplode(F.split("value", "\r?\n")).alias("line", "text"))
        .withColumn("text", F.trim("text")).filter("text <> ''")
    )
    header = ~F.col("text").contains(";")
    w = Window.partitionBy("_source_file").orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    parts = F.col("p")
    cell = lambda i: F.trim(parts[i])
    rows = (
        lines.withColumn("category", F.coalesce(F.last(F.when(header, F.col("text")), ignorenulls=True).over(w), F.lit("Unknown")))
        .filter(~header).withColumn("p", F.split("text", ";"))
        .filter((parts[0] != "Scheme Code") & (F.size("p") >= 6))
        .select(F.col("category").alias("Category"), cell(0).alias("Scheme_Code"), cell(1).alias("ISIN_Div_Payout"),
                cell(2).alias("ISIN_Div_Reinvestment"), cell(3).alias("Scheme_Name"),
                cell(4).try_cast("double").alias("Net_Asset_Value"), cell(5).alias("Date"), "_source_file")
    )
    return rows.withColumn("md5_hash", row_md5(["Scheme_Code", "Net_Asset_Value", "Date"]))


MARKET_STATE = ("struct<marketState: array<struct<market:string, marketStatus:string, tradeDate:string, `index`:string, "
                "last:string, variation:string, percentChange:string>>>")


def flatten_market_state(df: DataFrame, json_col: str, ts: str | None = None) -> DataFrame:
    """Nested market-state JSON to one row per market; text that is not JSON gives none."""
    at = F.col(ts) if ts else F.current_timestamp()
    out = df.select(at.alias("Timestamp"), F.from_json(json_col, MARKET_STATE).alias("j")).select("Timestamp", F.inline("j.marketState"))
    num = lambda c: F.col(c).try_cast("double")
    return out.select(
        "Timestamp", F.col("market").alias("Market"), F.col("marketStatus").alias("Status"), F.col("index").alias("Index"),
        num("last").alias("Last_Price"), num("variation").alias("Variation"), num("percentChange").alias("Pct_Change"),
        F.col("tradeDate").alias("Trade_Date"))


RSS_SCHEMA = "title string, link string, pubDate string, description string"


def rss_items(spark: SparkSession, path: str, source: str | None = None, summary_width: int | None = None) -> DataFrame:
    """Feed items with an id from the link; missing fields are empty."""
    raw = spark.read.format("xml").option("rowTag", "item").schema(RSS_SCHEMA).load(path)
    raw = raw.select("*", F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)\.[^.]*$", 1).alias("_stem"))
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    summary = text("description") if summary_width is None else F.substring(text("description"), 1, summary_width)
    return raw.select(
        F.current_timestamp().alias("timestamp"), (F.lit(source) if source else F.col("_stem")).alias("source"), text("title").alias("title"),
        text("link").alias("link"), text("pubDate").alias("published"), summary.alias("summary"), F.md5(text("link")).alias("article_id"))


def shape_articles(df: DataFrame, url="url", title="title", link="link", published="published", body="body") -> DataFrame:
    """Article records: source and category from the URL, clean title and body, and a safe file name."""
    have = lambda c: F.col(c) if c in df.columns else F.lit("")
    u = have(url)
    out = df.select(
        "*", F.when(u.contains("moneycontrol"), "Moneycontrol").otherwise("Economic Times").alias("Source"),
        F.when(u.contains("mutual"), "Mutual Funds").otherwise("Markets_Business").alias("Category"),
        clean_html(have(title)).alias("Title_"), F.coalesce(have(link), F.lit("")).alias("Link_"),
        F.coalesce(have(published), F.lit("")).alias("Published_Date"), clean_html(have(body)).alias("Body_Text"))
    safe = F.replace(F.trim(F.substring(F.regexp_replace("Title_", r"(?U)[^\w\s-]", ""), 1, 50)), F.lit(" "), F.lit("_"))
    stem = F.coalesce(F.nullif(safe, F.lit("")), F.concat(F.lit("article_"), F.substring(F.md5(F.coalesce(u, F.lit(""))), 1, 8)))
    return out.select(
        "Source", "Category", F.col("Title_").alias("Title"), F.col("Link_").alias("Link"), "Published_Date", "Body_Text",
        F.concat_ws("_", "Source", "Category", stem).alias("file_name"))


def dataset_inventory(spark: SparkSession, root: str) -> DataFrame:
    """Files, directories holding files and megabytes per top-level folder, and a total row. File contents are not read."""
    base = root.rstrip("/")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(base).select("path", "length")
    rel = F.regexp_replace("path", "^.*?" + base.split("://")[-1].replace(".", r"\.") + "/", "")
    files = files.select(F.split(rel, "/")[0].alias("data_type"), F.regexp_replace("path", "/[^/]*$", "").alias("dir"), "length")
    per_dir = files.groupBy("data_type", "dir").agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))
    out = per_dir.groupBy("data_type").agg(F.sum("files").alias("files"), F.count("*").alias("dirs"), F.sum("bytes").alias("bytes"))
    total = out.agg(F.lit("TOTAL").alias("data_type"), F.sum("files").alias("files"), F.sum("dirs").alias("dirs"), F.sum("bytes").alias("bytes"))
    return out.unionByName(total).withColumn("size_mb", F.round(F.col("bytes") / (1024 * 1024), 4)).withColumn(
        "size_gb", F.round(F.col("bytes") / (1024 ** 3), 6))


def duplicate_files(spark: SparkSession, root: str) -> DataFrame:
    """Groups of files with the same content: copies and redundant bytes. Only files whose length another has are read."""
    f = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    # lengths come from the listing; equalities on the length reach the scan, which then opens no other file
    sizes = [r[0] for r in f.groupBy("length").agg(F.count("*").alias("n")).filter("n > 1").orderBy(F.desc("n"), "length").limit(501).collect()]
    alike = f.filter(reduce(lambda a, b: a | b, [F.col("length") == n for n in sizes], F.lit(False))) if len(sizes) <= 500 else f
    hashed = alike.select("length", F.md5("content").alias("content_md5"), "path")
    return hashed.groupBy("length", "content_md5").agg(F.count("*").alias("copies"), F.min("path").alias("first_path")).filter(
        "copies > 1").withColumn("redundant_bytes", (F.col("copies") - 1) * F.col("length"))


def latest_rows(spark: SparkSession, path: str, ts_col: str, n: int, numeric: list[str] = (), ties: list[str] = ()) -> DataFrame:
    """Newest ``n`` rows of a live output, names lower-cased and stripped, listed columns as numbers."""
    raw = spark.read.parquet(path)
    df = raw.toDF(*[c.strip().lower() for c in raw.columns])
    df = df.withColumns({c: F.col(c).try_cast("double") for c in numeric if c in df.columns}) if numeric else df
    return df.orderBy(F.desc(ts_col), *ties).limit(n)
