"""Row filters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.rules import lead_tier
from ..functions.scalars import default, to_number


def quality_rule() -> Column:
    """A lead is usable when it has an id, a visit count and a probability, neither negative."""
    return F.col("lead_id").isNotNull() & (F.col("total_visits") >= 0) & (F.col("Conversion_Probability") >= 0)


def quality_filter(df: DataFrame) -> DataFrame:
    return df.filter(quality_rule())


def quality_split(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    ok = F.coalesce(quality_rule(), F.lit(False))
    return df.filter(ok), df.filter(~ok)


def drop_bad_bars(df: DataFrame) -> DataFrame:
    return df.dropna(subset=[c for c in ("open", "close") if c in df.columns])


def positive_amount(df: DataFrame, col: str = "amount") -> DataFrame:
    return df.withColumn(col, to_number(col, 0)).filter(F.col(col) > 0)


def complete_cases(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.dropna(subset=[c for c in cols if c in df.columns])


def _lot(key: list[str], seed: int) -> Column:
    """A row's lot as 32 hex digits: the same on every run, layout and engine that has MD5."""
    return F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in key], F.lit(str(seed))))


def sample(df: DataFrame, frac: float, seed: int = 42, key: list[str] | None = None) -> DataFrame:
    """Bernoulli sample; with ``key`` it is decided by a hash of the key, the same on every run and layout."""
    if key is None:
        return df.sample(withReplacement=False, fraction=frac, seed=seed)
    return df.filter(F.substring(_lot(key, seed), 1, 13) < f"{int(frac * 16**13):013x}") if frac < 1 else df


def sample_n(df: DataFrame, n: int, key: list[str], seed: int = 42) -> DataFrame:
    """Exactly ``n`` rows (or all), chosen by hash order: each task keeps only its own first ``n``."""
    return df.orderBy(_lot(key, seed), *key).limit(n)


def filter_in(df: DataFrame, wanted: dict[str, list]) -> DataFrame:
    """Keep rows whose columns are in the given lists; an empty list does not filter."""
    conds = [F.col(c).isin(list(v)) for c, v in wanted.items() if v and c in df.columns]
    return df.filter(reduce(lambda a, b: a & b, conds)) if conds else df


SEARCH_COLUMNS = ("name", "city", "occupation", "lead_id", "industry", "lead_source")


def search_leads(
    df: DataFrame, query: str | None = None, stage: str | None = None, priority: str | None = None, limit: int = 20
) -> DataFrame:
    """Leads matching free text, workflow stage and priority, best probability first."""
    prob = F.coalesce(F.col("conversion_probability"), F.lit(0.5))
    if query:
        hits = [F.lower(default(c, "")).contains(query.lower()) for c in SEARCH_COLUMNS if c in df.columns]
        df = df.filter(reduce(lambda a, b: a | b, hits))
    if stage:
        df = df.filter(F.lower(default("status", "New")) == stage.lower())
    if priority:
        df = df.filter(lead_tier(prob) == priority.lower())
    return df.orderBy(F.desc_nulls_last("conversion_probability"), "lead_id").limit(limit)


def name_like(df: DataFrame, col: str, text: str) -> DataFrame:
    return df.filter(F.coalesce(F.lower(F.col(col)).contains(text.lower()), F.lit(False)))
