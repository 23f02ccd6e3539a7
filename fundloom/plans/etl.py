"""Batch jobs from raw files to cleaned tables and exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import rules as R
from ..functions.words import TRAITS
from ..operators import aggregates as A, derive as D, features as E, filters as X, joins as J, quality as Q
from ..sources import files, sinks

OHLCV = ["open", "high", "low", "close", "volume"]


def clean_leads(raw: DataFrame, sample: float | None = None) -> DataFrame:
    df = raw if sample is None else X.sample(raw, sample)
    return Q.impute_zero_by_prefix(Q.dedupe(Q.normalize_columns(df)))


def lead_etl(spark: SparkSession, src: str, out: str, sample: float | None = None, schema=None) -> DataFrame:
    """Raw lead CSVs to Parquet partitioned by ``converted``; returns the null profile of what was written."""
    df = clean_leads(files.read_csv_tree(spark, src, schema), sample)
    parts = ["converted"] if "converted" in df.columns else None
    sinks.write_parquet(df, out, parts)
    return Q.null_profile(spark.read.parquet(out), sort=True)


def clean_bars(raw: DataFrame, sample: float | None = None) -> DataFrame:
    df = Q.normalize_columns(raw if sample is None else X.sample(raw, sample))
    return Q.impute(X.drop_bad_bars(df), "mean", [c for c in OHLCV if c in df.columns])


def intraday_etl(spark: SparkSession, src: str, out: str, sample: float | None = None, schema=None) -> None:
    sinks.write_parquet(clean_bars(files.read_csv_tree(spark, src, schema), sample), out)


def clean_texts(raw: DataFrame) -> DataFrame:
    return Q.dedupe(Q.normalize_columns(raw))


def sentiment_etl(spark: SparkSession, src: str, out: str, schema=None) -> None:
    sinks.write_parquet(clean_texts(files.read_csv_tree(spark, src, schema)), out)


def investor_features(users: DataFrame, txns: DataFrame) -> DataFrame:
    """Spend per client joined to the users, with ratio and inferred risk profile."""
    out = D.risk_appetite(J.investor_profiles(users, A.client_spend(txns)))
    return out.select("id", "current_age", "yearly_income", "total_debt", "debt_to_income_ratio", "credit_score",
                      "behavior_spend_sum", "behavior_spend_count", "inferred_risk_profile")


def lead_preprocess(df: DataFrame, key: str, visits="total_visits", time="time_spent", pages="page_views", label="converted",
                    onehot=("lead_origin", "country"), quality="lead_quality", source="lead_source") -> DataFrame:
    """Deduplicate, cap visits, impute by neighbours, derive, encode: in this order, as each step uses the one before."""
    out = Q.winsorize(Q.dedupe(df), visits)
    out = E.knn_impute(out, key, [c for c in (visits, time, pages) if c in df.columns])
    out = out.withColumns({"engagement_velocity": R.engagement_velocity(pages, time),
                           "activity_score": R.activity_score(visits, pages), "lead_age_bin": R.lead_age_bin(visits)})
    for c in onehot:
        if c in out.columns:
            out = E.dummies(out, c).drop(c)
    if quality in out.columns:
        out = E.label_encode(out, quality)
    if source in out.columns and label in out.columns:
        out = E.target_encode(out, source, label)
    return out


def distributor_view(leads: DataFrame) -> DataFrame:
    return leads.select("lead_id", "lead_origin", "lead_source", "time_spent", "converted", "conversion_probability",
                        R.lead_tier("conversion_probability", "tier123").alias("lead_tier"), R.asset_class("time_spent").alias("recommended_asset_class"))


def investor_view(traits: DataFrame) -> DataFrame:
    return D.rule_persona(traits)


def leads_for_bi(leads: DataFrame) -> DataFrame:
    score = R.engagement_score("total_visits", "time_spent")
    return leads.withColumn("engagement_score", score).withColumn("engagement_tier", R.engagement_tier("engagement_score", "binned"))


def kpis(leads: DataFrame, investors: DataFrame, texts: DataFrame) -> DataFrame:
    count = lambda df: df.agg(F.count("*").alias("n")).scalar()
    return leads.agg(F.count("*").alias("total_leads"), F.round(F.avg("conversion_probability"), 4).alias("mean_conversion_probability"),
                     F.sum("converted").alias("converted_leads")).select(
        "*", count(investors).alias("total_investors"), count(texts).alias("total_texts"))


def bi_exports(leads: DataFrame, investors: DataFrame, texts: DataFrame, out: str) -> None:
    """All BI extracts as CSV folders and the KPI table as JSON and CSV."""
    sinks.write_csv(distributor_view(leads), f"{out}/distributor_dashboard")
    sinks.write_csv(investor_view(investors), f"{out}/investor_dashboard")
    sinks.write_csv(leads_for_bi(leads), f"{out}/leads_for_bi")
    sinks.write_csv(texts, f"{out}/sentiment_for_bi")
    sinks.write_kpis(kpis(leads, investors, texts), f"{out}/summary_metrics")
