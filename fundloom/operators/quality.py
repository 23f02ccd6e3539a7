"""Column names, cleaning, profiling and imputation. Statistics enter the plan as scalar subqueries, not via the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.scalars import as_col, row_md5, to_number
from .ordered import exact_quantiles, quantile_of

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, NUMERIC)]


def _present(df: DataFrame, cols) -> list[str]:
    return [c for c in cols if c in df.columns]


def _missing(df: DataFrame, c: str) -> Column:
    col = F.col(f"`{c}`")
    floating = isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType))
    return (col.isNull() | F.isnan(col)) if floating else col.isNull()


# ---- names ---------------------------------------------------------------------------------

def _clean_name(name: str, style: str) -> str:
    if name.startswith("_"):
        return name
    out = name.strip().lower().replace(" ", "_").translate(str.maketrans({"(": "", ")": "", "%": "pct"}))
    if style == "strict":
        out = out.translate(str.maketrans("-/,.", "____")).replace("__", "_").strip("_")
    return out


def normalize_columns(df: DataFrame, style: str = "basic") -> DataFrame:
    """Lower-case snake names in one projection; columns starting with ``_`` keep theirs."""
    names = [_clean_name(c, style) for c in df.columns]
    clash = sorted({n for n in names if names.count(n) > 1})
    if clash:
        raise ValueError(f"columns collide after normalisation: {clash}")
    return df.toDF(*names)


def coalesce_aliases(df: DataFrame, mapping: dict[str, list[str]]) -> DataFrame:
    """Each canonical column becomes the first non-null of itself and its aliases that exist."""
    for canon, aliases in mapping.items():
        have = _present(df, dict.fromkeys([canon, *aliases]))
        if have:
            df = df.withColumn(canon, F.coalesce(*[F.col(f"`{c}`") for c in have]))
            df = df.drop(*[c for c in have if c != canon])
    return df


def to_numeric(df: DataFrame, cols: list[str], fill: float | None = None) -> DataFrame:
    have = _present(df, cols)
    return df.withColumns({c: to_number(c, fill) for c in have}) if have else df


# ---- profiling -----------------------------------------------------------------------------

def null_profile(df: DataFrame, sort: bool = False) -> DataFrame:
    """(column, nulls, pct) in one scan; no rows for an empty table."""
    counted = df.agg(F.count("*").alias("_n"), *[F.count_if(_missing(df, c)).alias(f"c{i}")
                                                for i, c in enumerate(df.columns)])
    pairs = ", ".join(f"'{c}', c{i}" for i, c in enumerate(df.columns))
    out = (
        counted.filter("_n > 0").select("_n", F.expr(f"stack({len(df.columns)}, {pairs}) as (column, nulls)"))
        .select("column", "nulls", F.round(F.col("nulls") * 100.0 / F.col("_n"), 4).alias("pct"))
    )
    return out.orderBy(F.desc("pct"), "column") if sort else out


def duplicate_stats(df: DataFrame) -> DataFrame:
    groups = df.groupBy(*df.columns).agg(F.count("*").alias("_cnt"))
    return groups.agg(
        F.coalesce(F.sum("_cnt"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum(F.col("_cnt") - 1), F.lit(0)).alias("duplicate_rows"),
        F.count("*").alias("unique_rows"),
        F.round(F.coalesce(F.try_divide(F.sum(F.col("_cnt") - 1) * 100.0, F.sum("_cnt")), F.lit(0.0)), 4)
        .alias("duplicate_pct"),
    )


def dedupe(df: DataFrame, subset: list[str] | None = None, order: list | None = None, last: bool = False) -> DataFrame:
    """Distinct rows, or one row per ``subset``: with ``order`` the first (or last) one, combined map-side."""
    if not subset:
        return df.dropDuplicates()
    if not order:
        return df.dropDuplicates(subset)
    rest = [c for c in df.columns if c not in subset]
    first = (F.max_by if last else F.min_by)(F.struct(*[F.col(f"`{c}`") for c in rest]), F.struct(*[as_col(o) for o in order]))
    out = df.groupBy(*subset).agg(first.alias("_first"))
    return out.select(*[F.col(f"`{c}`") if c in subset else F.col(f"_first.`{c}`").alias(c) for c in df.columns])


def dedupe_by_hash(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Rows whose fields give the same MD5 are one row."""
    return df.withColumn("row_hash", row_md5(cols or df.columns)).dropDuplicates(["row_hash"]).drop("row_hash")


def approx_uniques(df: DataFrame, cols: list[str], rsd: float = 0.05) -> DataFrame:
    have = _present(df, cols)
    one = df.agg(*[F.approx_count_distinct(F.col(f"`{c}`"), rsd).alias(f"c{i}") for i, c in enumerate(have)])
    pairs = ", ".join(f"'{c}', c{i}" for i, c in enumerate(have))
    return one.select(F.expr(f"stack({len(have)}, {pairs}) as (column, approx_unique)"))


def describe_all(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Per column: count, unique, top, freq, mean, std, min, quartiles, max (numbers only where they apply)."""
    cols = _present(df, cols or df.columns)
    nums = [c for c in cols if c in numeric_columns(df)]
    as_text = ", ".join(f"'{c}', cast(`{c}` as string)" for c in cols)
    values = (
        df.select(F.expr(f"stack({len(cols)}, {as_text}) as (column, value)")).filter("value is not null")
        .groupBy("column", "value").agg(F.count("*").alias("cnt"))
    )
    shape = values.groupBy("column").agg(
        F.sum("cnt").alias("count"), F.count("*").alias("unique"),
        F.min_by("value", F.struct(-F.col("cnt"), F.col("value"))).alias("top"), F.max("cnt").alias("freq"),
    )
    if not nums:
        return shape
    stats = [F.struct(F.lit(c).alias("column"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"),
                      F.min(c).cast("double").alias("min"), F.max(c).cast("double").alias("max")) for c in nums]
    moments = df.agg(F.array(*stats).alias("a")).select(F.inline("a"))
    quart = exact_quantiles(df, nums, [0.25, 0.5, 0.75]).groupBy("column").agg(*[
        F.max(F.when(F.col("prob") == p, F.col("value"))).alias(n) for p, n in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"))
    ])
    return shape.join(moments, "column", "left").join(quart, "column", "left")


def iqr_outliers(df: DataFrame, col: str, exact: bool = False, name: str = "is_outlier") -> DataFrame:
    """Flags values more than 1.5 IQR outside the quartiles; nulls (and all-null columns) are not outliers."""
    if exact:
        q = quantile_of(df, col, [0.25, 0.75])
    else:
        q = df.agg(F.percentile_approx(col, [0.25, 0.75], 100).alias("q")).scalar()
    df = df.withColumn("_q", q)
    reach = (F.col("_q")[1] - F.col("_q")[0]) * 1.5
    out = (F.col(col) < F.col("_q")[0] - reach) | (F.col(col) > F.col("_q")[1] + reach)
    return df.withColumn(name, F.coalesce(out, F.lit(False))).drop("_q")


# ---- imputation and clipping ---------------------------------------------------------------

def impute(df: DataFrame, strategy: str, cols: list[str], value=None) -> DataFrame:
    """Fill missing cells with the ``mean``, exact ``median``, most frequent (``mode``) or a ``const`` value."""
    have = _present(df, cols)
    if not have:
        return df
    if strategy == "const":
        return df.fillna({c: value for c in have})
    if strategy == "mean":
        fills = df.agg(F.struct(*[F.avg(F.when(~_missing(df, c), F.col(c))).alias(c) for c in have]).alias("s"))
    elif strategy == "median":
        middle = exact_quantiles(df, have, [0.5])
        fills = middle.agg(F.struct(*[F.max(F.when(F.col("column") == c, F.col("value"))).alias(c) for c in have]).alias("s"))
    elif strategy == "mode":
        as_text = ", ".join(f"'{c}', cast(`{c}` as string)" for c in have)
        counts = (
            df.select(F.expr(f"stack({len(have)}, {as_text}) as (k, v)")).filter("v is not null")
            .groupBy("k", "v").count()
        )
        best = lambda c: F.min_by(F.when(F.col("k") == c, F.col("v")),
                                  F.when(F.col("k") == c, F.struct(-F.col("count"), F.col("v"))))
        fills = counts.agg(F.struct(*[best(c).alias(c) for c in have]).alias("s"))
    else:
        raise ValueError(f"unknown strategy {strategy!r}")
    out = df.withColumn("_fill", fills.scalar())
    return out.withColumns({
        c: F.when(_missing(df, c), F.col(f"_fill.`{c}`").cast(_filled_type(df, c, strategy))).otherwise(F.col(c))
        for c in have
    }).drop("_fill")


def _filled_type(df: DataFrame, c: str, strategy: str) -> T.DataType:
    return df.schema[c].dataType if strategy == "mode" else T.DoubleType()


def impute_zero_by_prefix(df: DataFrame, prefixes=("total", "page", "asym")) -> DataFrame:
    return impute(df, "const", [c for c in numeric_columns(df) if c.startswith(tuple(prefixes))], 0)


def winsorize(df: DataFrame, col: str, upper: float = 0.99) -> DataFrame:
    """Values above the quantile are pulled down to it; nulls stay."""
    if col not in df.columns:
        return df
    out = df.withColumn("_cap", quantile_of(df, col, [upper])[0])
    return out.withColumn(col, F.when(F.col(col) > F.col("_cap"), F.col("_cap")).otherwise(F.col(col))).drop("_cap")


def audit(df: DataFrame, sample: int | None = None, top: int | None = None) -> dict[str, DataFrame]:
    """Null profile (worst first), duplicate counts and column descriptions of a table, or of a sample if one is asked for.

    All columns are reported; ``top`` keeps the worst ones of the null profile only.
    """
    part = df if sample is None else df.orderBy(F.xxhash64(*df.columns)).limit(sample)
    missing = null_profile(part, sort=True)
    return {
        "missing": missing if top is None else missing.limit(top),
        "duplicates": duplicate_stats(part),
        "describe": describe_all(part).orderBy("column"),
    }
