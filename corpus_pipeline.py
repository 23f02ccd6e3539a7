"""A corpus from raw documents to packed sequences: five stages, each one operator of ``fundloom.llm``.

Every stage takes (spark, docs, sf_dir), works on all rows of ``docs`` and returns a frame that is written as Parquet
and read again as the next stage's ``docs``. All but the last return the columns of ``documents``.

Every stage takes nulls in any column, empty and very long texts, repeated rows, empty tables and more columns of any name:
a null text counts as empty, a row without a doc_id is a document like any other, an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fundloom.llm import mixing, neardup, packing, pii, quality
from fundloom.llm.common import saved
from fundloom.session import tune


def _ready(spark: SparkSession) -> SparkSession:
    """Rows of whole texts are large, so a batch holds few of them."""
    tune(spark).conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return spark


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier: documents that score below the threshold go; repeated rows and all empty texts share a score."""
    return quality.keep_good(docs, _ready(spark).read.parquet(f"{sf_dir}/labels.parquet"), threshold=0.3)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """MinHash near-duplicates: one document of each group stays, the one with the smallest doc_id; empty texts and rows without a doc_id are in no group."""
    _ready(spark)
    return neardup.keep_one(docs, width=5, percent=80)


def redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data: spans are replaced by their kind; n_chars follows the new text; all rows stay, null texts stay null."""
    _ready(spark)
    return pii.redact(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing to target weights: a sample whose tokens have the target shares; unknown and null names count as other, repeated rows share their fate."""
    _ready(spark)
    return mixing.mix(docs, keep=0.9, details=False)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packing: every remaining document cut into pieces that fill windows of 2048 tokens, with the pieces' ids; an empty text is its end id."""
    _ready(spark)
    return packing.pack(docs)


STAGES = [
    ("quality_filter", quality_filter),
    ("near_dedup", near_dedup),
    ("redaction", redaction),
    ("mixture", mixture),
    ("pack", pack),
]

#: Models, MinHash and packing have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
