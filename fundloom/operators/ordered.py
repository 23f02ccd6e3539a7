"""Global order without a global sort in one task.

Rows are cut into key ranges by a small hash sample of the keys. Each range is summed, the sums give every range its
offset, and only then is a range sorted on its own. A sample decides the balance of the ranges, never the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.scalars import as_col
from ..session import shuffle_width


def range_bucket(df: DataFrame, key: list, n: int | None = None, name: str = "_bucket", aggregated: bool = False) -> DataFrame:
    """Number of the key range each row lies in; at most ``n + 1`` ranges, balanced over distinct keys.

    With ``aggregated`` the sample reads all columns, so that it asks for the very shuffle the rows come from and Spark
    runs that shuffle once; leave it off for raw tables, where the sample then reads only the key.
    """
    n = n or shuffle_width(df.sparkSession)
    keyed = df.withColumn("_key", F.struct(*[as_col(k) for k in key]))
    # a key is compared with every ``step``-th cut and then with those from there on, not with all
    step = max(1, round(n ** 0.5))
    cuts = (
        keyed.orderBy(F.xxhash64(*(df.columns if aggregated else ["_key"])), "_key").limit(n)
        .agg(F.array_sort(F.collect_set("_key")).alias("cuts"))
        .select(F.struct("cuts", F.filter("cuts", lambda _, i: i % step == 0).alias("firsts")).alias("cuts"))
    )
    below = lambda some: F.size(F.filter(some, lambda c: c < F.col("_key")))
    start = F.greatest((F.col("_firsts") - 1) * step, F.lit(0))
    return (
        keyed.withColumn("_cuts", cuts.scalar())
        .withColumn("_firsts", below("_cuts.firsts"))
        # never null, or the join on it would push a null test of this expression below the aggregation
        .withColumn(name, F.coalesce(start + below(F.slice("_cuts.cuts", start + 1, step)), F.lit(0)))
        .drop("_cuts", "_key", "_firsts")
    )


def running_totals(
    df: DataFrame, order: list, sums: dict[str, Column], by: list[str] = (), totals: bool = False, n: int | None = None,
    aggregated: bool = False,
) -> DataFrame:
    """Cumulative sums (inclusive) in ``order`` within ``by``; order keys must be unique within ``by``.

    With ``totals`` each sum also gets a ``<name>_total`` over its whole ``by`` group.
    """
    by = list(by)
    work = df
    for name, value in sums.items():
        work = work.withColumn(f"_v_{name}", value)
    work = range_bucket(work, [*by, *order], n, aggregated=aggregated)
    part = by or [F.lit(0)]
    before = Window.partitionBy(*part).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*part)
    # one row per (by, range): as small as the number of ranges
    offsets = work.groupBy(*by, "_bucket").agg(*[F.sum(f"_v_{k}").alias(f"_t_{k}") for k in sums])
    picked = [F.coalesce(F.sum(f"_t_{k}").over(before), F.lit(0)).alias(f"_o_{k}") for k in sums]
    if totals:
        picked += [F.sum(f"_t_{k}").over(whole).alias(f"{k}_total") for k in sums]
    offsets = offsets.select(*by, "_bucket", *picked)
    inside = Window.partitionBy(*by, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = work.join(offsets, [*by, "_bucket"])
    for k in sums:
        out = out.withColumn(k, F.col(f"_o_{k}") + F.sum(f"_v_{k}").over(inside))
    return out.drop("_bucket", *[f"_{p}_{k}" for p in ("v", "o") for k in sums])


def global_rank(df: DataFrame, order: list, name: str = "rank", by: list[str] = ()) -> DataFrame:
    """1-based row number in ``order``; the order must be total."""
    return running_totals(df, order, {name: F.lit(1).cast("bigint")}, by)


def exact_quantiles(df: DataFrame, cols: list[str], probs: list[float], accuracy: int = 10_000) -> DataFrame:
    """Linear-interpolated quantiles of each column as (column, prob, value) rows; nulls and NaN are left out.

    A sketch brackets each quantile first: its rank error is at most 1/accuracy, so three times that on either side
    surely holds the wanted ranks (in a column of at most ``accuracy`` values, where rounding of ranks would matter, all
    values count as inside). One pass then counts what lies below each bracket and keeps only the values inside
    it, equal values counted together; just these few are ranked. A bracket that missed would raise, not mislead.
    """
    clean = {c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in cols}
    margin = 3.0 / accuracy
    ends = [x for p in probs for x in (max(0.0, p - margin), min(1.0, p + margin))]
    sketch = df.agg(F.struct(*[
        F.struct(F.count(v).alias("n"), F.percentile_approx(v, ends, accuracy).alias("e")).alias(c) for c, v in clean.items()
    ]).alias("s"))
    limits, at = [], F.col("s")
    for c in cols:
        few = at[c]["n"] <= accuracy
        limits += [F.struct(F.lit(c).alias("_of"), F.lit(float(p)).alias("prob"), F.when(few, float("-inf")).otherwise(at[c]["e"][2 * i]).alias("_lo"),
                            F.when(few, float("inf")).otherwise(at[c]["e"][2 * i + 1]).alias("_hi")) for i, p in enumerate(probs)]
    # one expression over all brackets took some 26 microseconds a row, a join with these few rows about 5
    limits = sketch.select(F.inline(F.array(*limits)))
    values = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), v.alias("_v")) for c, v in clean.items()]))).filter("_v is not null")
    counts = (
        # a handful of rows; dealt by column, all values of one would meet in one task
        values.join(F.broadcast(limits), (F.col("column") == F.col("_of")) & (F.col("_v") <= F.col("_hi")))
        .groupBy("column", "prob", F.when(F.col("_v") >= F.col("_lo"), F.col("_v")).alias("value")).agg(F.count("*").alias("cnt"))
    )
    ranked = running_totals(counts, ["value"], {"cum": F.col("cnt")}, by=["column", "prob"], aggregated=True)
    size = F
    for c in cols:
        size = size.when(F.col("column") == c, F.col(f"_s.`{c}`.n"))
    hits = ranked.withColumn("_s", sketch.scalar()).withColumn("_pos", F.col("prob") * (size - 1))
    covers = lambda r: (F.col("cum") - F.col("cnt") <= r) & (r < F.col("cum"))
    low, high = F.floor("_pos"), F.ceil("_pos")
    found = hits.groupBy("column", "prob").agg(
        F.max(F.when(covers(low) , F.col("value"))).alias("lo"), F.max(F.when(covers(high), F.col("value"))).alias("hi"),
        F.max(F.col("_pos") - low).alias("frac"))
    sure = F.when(F.col("lo").isNull() | F.col("hi").isNull(), F.raise_error(F.lit("quantile outside its bracket")).cast("double"))
    return found.select("column", "prob", F.coalesce(sure, F.col("lo") + F.col("frac") * (F.col("hi") - F.col("lo"))).alias("value"))


def quantile_of(df: DataFrame, col: str, probs: list[float]) -> Column:
    """The quantiles of one column as a scalar array in the order of ``probs`` (ascending)."""
    q = exact_quantiles(df, [col], probs)
    return q.agg(
        F.transform(F.array_sort(F.collect_list(F.struct("prob", "value"))), lambda s: s["value"]).alias("q")
    ).scalar()


def last_rows_window(df: DataFrame, rank: str, size: int, exprs: dict[str, Column], chunk: int = 100_000) -> DataFrame:
    """Aggregates over the last ``size`` rows of a global rank, computed chunk by chunk.

    ``exprs`` are window aggregates without a window. Rows near the end of a chunk are repeated in the next one as
    look-back, so each chunk is complete on its own.
    """
    chunk_no = F.floor((F.col(rank) - 1) / chunk)
    tail = (F.col(rank) - 1) % chunk >= chunk - (size - 1)
    copies = df.withColumn("_chunk", F.explode(F.when(
        tail, F.array(F.struct(chunk_no.alias("c"), F.lit(True).alias("own")),
                      F.struct((chunk_no + 1).alias("c"), F.lit(False).alias("own")))
    ).otherwise(F.array(F.struct(chunk_no.alias("c"), F.lit(True).alias("own"))))))
    w = Window.partitionBy("_chunk.c").orderBy(rank).rowsBetween(-(size - 1), 0)
    return (
        copies.select("*", *[e.over(w).alias(k) for k, e in exprs.items()]).filter("_chunk.own").drop("_chunk")
    )
