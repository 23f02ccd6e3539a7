"""Series per entity: calendars, moving averages, sequences, forecasts by momentum, performance, drift.

A series has one row per (entity, date): ``daily`` enforces it, and the calendar then bounds every entity's window
however skewed the raw table is. Streams of events without that bound go through ``ordered.global_rank`` instead.
"""

from __future__ import annotations

from math import ceil, log10

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.rules import signal_score
from ..functions.scalars import clamp, round_even, safe_div, signature
from ..session import shuffle_width
from .ordered import global_rank, last_rows_window, running_totals
from .quality import dedupe


def daily(df: DataFrame, key: str, date: str, order: list | None = None) -> DataFrame:
    """One row per (entity, date)."""
    return dedupe(df, [key, date], order or [c for c in df.columns if c not in (key, date)])


def _w(key: str, date: str, lo: int | None = None, hi: int = 0):
    w = Window.partitionBy(key).orderBy(date)
    return w if lo is None else w.rowsBetween(lo, hi)


#: Days of calendars that a task sorts.
TASK_DAYS = 1 << 21


def dealt_by_days(df: DataFrame, key: str, date: str) -> DataFrame:
    """Entities dealt over so many tasks that the days between their first and last rows, summed, are about ``TASK_DAYS`` in each."""
    days = df.groupBy(key).agg((F.datediff(F.max(date), F.min(date)) + 1).alias("n")).agg(F.sum("n").alias("n")).first()["n"] or 0
    return df.repartition(max(shuffle_width(df.sparkSession), ceil(days / TASK_DAYS)), key)


def sma(df: DataFrame, n: int, key="scheme", date="date", col="nav", min_periods: int = 1, name: str | None = None) -> DataFrame:
    w = _w(key, date, -(n - 1))
    out = F.when(F.count(col).over(w) >= min_periods, F.avg(col).over(w))
    return df.withColumn(name or f"{col}_sma_{n}", out)


def _to_next(df: DataFrame, key: str, date: str) -> DataFrame:
    """Every row repeated for each day up to the entity's next row, as ``_day``: a calendar without a join."""
    end = F.coalesce(F.date_sub(F.lead(date).over(_w(key, date)), 1), F.col(date))
    return df.withColumn("_end", end).withColumn("_day", F.explode(F.sequence(date, "_end", F.expr("interval 1 day")))).drop("_end")


def calendar(df: DataFrame, key="scheme", date="date") -> DataFrame:
    """Every day from an entity's first to its last; days without a row have nulls in the other columns."""
    rest = [c for c in df.columns if c not in (key, date)]
    return _to_next(df, key, date).select(
        key, F.col("_day").alias(date), *[F.when(F.col("_day") == F.col(date), F.col(c)).alias(c) for c in rest])


def forward_fill(df: DataFrame, key="scheme", date="date", col="nav") -> DataFrame:
    """The daily calendar with the last known value of ``col``; other columns are null on filled days."""
    rest = [c for c in df.columns if c not in (key, date, col)]
    known = df.withColumn(col, F.last(col, ignorenulls=True).over(_w(key, date, Window.unboundedPreceding)))
    return _to_next(known, key, date).select(
        key, F.col("_day").alias(date), col, *[F.when(F.col("_day") == F.col(date), F.col(c)).alias(c) for c in rest])


def last_n(df: DataFrame, key: str, ts: str, n: int, ties: list[str] = ()) -> DataFrame:
    w = Window.partitionBy(key).orderBy(F.desc(ts), *ties)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def ohlc_from_nav(df: DataFrame, key="scheme", date="date", col="nav") -> DataFrame:
    opened = F.coalesce(F.lag(col).over(_w(key, date)), F.col(col))
    return df.select(key, date, opened.alias("open"), F.greatest(opened, F.col(col)).alias("high"),
                     F.least(opened, F.col(col)).alias("low"), F.col(col).alias("close"))


def sequences(df: DataFrame, key="scheme", date="date", col="nav", lookback: int = 30, horizon: int = 5) -> DataFrame:
    """Sliding samples: the last ``lookback`` values and the ``horizon`` values after them."""
    out = df.select(key, date, F.collect_list(col).over(_w(key, date, -(lookback - 1))).alias("x"),
                    F.collect_list(col).over(_w(key, date, 1, horizon)).alias("y"))
    return out.filter((F.size("x") == lookback) & (F.size("y") == horizon))


def temporal_split(df: DataFrame, key="scheme", date="date", train: float = 0.7, val: float = 0.15) -> DataFrame:
    """Per entity: the first 70 % of rows train, the next 15 % validate, the rest test (row counts truncated)."""
    n = df.groupBy(key).agg(F.count("*").alias("_n"))
    pos = F.row_number().over(_w(key, date)) - 1
    a = F.floor(F.col("_n") * train)
    b = a + F.floor(F.col("_n") * val)
    return (
        df.join(n, key).withColumn("_pos", pos)
        .withColumn("split", F.when(F.col("_pos") < a, "train").when(F.col("_pos") < b, "val").otherwise("test"))
        .drop("_n", "_pos")
    )


def momentum_forecast(df: DataFrame, key="scheme", date="date", col="nav", steps: int = 5) -> DataFrame:
    """Straight-line projection from the last five values; entities with fewer than 30 rows give none."""
    recent = (
        df.withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy(F.desc(date)))).filter("_r <= 30")
        .groupBy(key).agg(
            F.count("*").alias("n"),
            F.max(F.when(F.col("_r") == 1, F.col(col))).alias("last"),
            F.max(F.when(F.col("_r") == 5, F.col(col))).alias("fifth"),
            F.stddev_pop(F.when(F.col("_r") <= 10, F.col(col))).alias("sd"),
            F.avg(F.when(F.col("_r") <= 10, F.col(col))).alias("mean"),
        ).filter("n >= 30")
    )
    step = (F.col("last") - F.col("fifth")) / 5.0
    end = round_even(F.col("last") + steps * step, 2)
    return recent.select(
        key, F.col("last").alias("historical_last"),
        round_even(clamp(99.0 - 1000.0 * safe_div("sd", "mean", 0.0), 75, 99), 1).alias("confidence_score"),
        F.when(end > F.col("last"), "UPWARD").when(end < F.col("last"), "DOWNWARD").otherwise("STABLE").alias("trend"),
        F.explode(F.transform(F.sequence(F.lit(1), F.lit(steps)), lambda k: F.struct(
            k.alias("step"), round_even(F.col("last") + k * step, 2).alias("forecast")))).alias("f"),
    ).select(key, "historical_last", "confidence_score", "trend", "f.step", "f.forecast")


def forecast_change(forecast: DataFrame, key="scheme", last="historical_last") -> DataFrame:
    """Percentage change from the last value to the last forecast step."""
    end = F.max_by("forecast", "step")
    return forecast.groupBy(key).agg(
        F.coalesce(safe_div((end - F.first(last)) * 100.0, F.first(last)), F.lit(0.0)).alias("forecast_change_pct"))


def direction(df: DataFrame, key="scheme", date="date", col="nav") -> DataFrame:
    prev = F.lag(col).over(_w(key, date))
    return df.withColumn("is_up", F.when(prev.isNotNull(), F.col(col) > prev))


def high_first(col: str) -> Column:
    """A key by which larger numbers come first and nulls last."""
    return F.struct(F.col(col).isNull(), -F.col(col))


def rank_allocation(df: DataFrame, by: list[str], order: list) -> DataFrame:
    """Rank within a group and the share it gets; ``order`` are ascending keys that leave no ties.

    Ranks come from sums over key ranges, so a group that holds most rows is not one task's.
    """
    return global_rank(df, order, "rank", by=by).withColumn("rank", F.col("rank").cast("int")).withColumn(
        "allocation_pct", F.greatest(F.lit(8), F.least(F.lit(40), 24 - (F.col("rank") - 1) * 4)))


def minmax_by(df: DataFrame, key="scheme", col="nav", name: str | None = None, bounds: DataFrame | None = None) -> DataFrame:
    """Values scaled to [0, 1] per entity; a constant series is 0. ``bounds`` may name a smaller frame with the same range."""
    span = (df if bounds is None else bounds).groupBy(key).agg(F.min(col).alias("_lo"), F.max(col).alias("_hi"))
    return df.join(span, key).withColumn(
        name or f"{col}_scaled",
        F.when(F.col(col).isNotNull(), F.coalesce(safe_div(F.col(col) - F.col("_lo"), F.col("_hi") - F.col("_lo")), F.lit(0.0)))
    ).drop("_lo", "_hi")


def minmax_global(df: DataFrame, col="nav", name: str | None = None) -> DataFrame:
    """Values scaled to [0, 1] with the bounds of the whole table."""
    span = df.agg(F.struct(F.min(col).alias("lo"), F.max(col).alias("hi")).alias("s"))
    return df.withColumn("_s", span.scalar()).withColumn(
        name or f"{col}_scaled",
        F.when(F.col(col).isNotNull(), F.coalesce(safe_div(F.col(col) - F.col("_s.lo"), F.col("_s.hi") - F.col("_s.lo")), F.lit(0.0)))
    ).drop("_s")


def inverse_minmax(scaled, lo, hi) -> Column:
    s = F.col(scaled) if isinstance(scaled, str) else scaled
    return s * (hi - lo) + lo


def nav_preprocess(nav: DataFrame, key="scheme", date="date", col="nav", dealt: bool = False) -> DataFrame:
    """Per scheme: daily calendar with forward fill, 7- and 30-day means, scaling to [0, 1]. One job for all schemes.

    A job before it sizes the tasks, unless ``dealt`` says that ``nav`` already comes from ``dealt_by_days``.
    """
    # rows that a task reads become the days that it sorts; duplicates, windows and bounds need no other shuffle
    one = daily(nav if dealt else dealt_by_days(nav, key, date), key, date)
    full = forward_fill(one, key, date, col)
    full = sma(full, 7, key, date, col, name="nav_sma_7")
    full = sma(full, 30, key, date, col, name="nav_sma_30")
    # filling adds no new values, so the bounds come from the unfilled rows
    return minmax_by(full, key, col, "nav_scaled", bounds=one)


# ---- performance ---------------------------------------------------------------------------

def ema(df: DataFrame, span: int, key="scheme", date="date", col="nav", name: str | None = None) -> DataFrame:
    """Exponential mean with weight 2/(span+1), started at the first value.

    A scan in two steps: within a stretch of rows the recursion is a running sum of values that are scaled up by what
    the mean forgets, so each row costs the same; each stretch hands on its last mean, which fades over the next one.
    Stretches are as long as the scale fits a double. Rows are one per (entity, date); a null value leaves the mean as it was.
    """
    alpha = 2.0 / (span + 1)
    keep = 1 - alpha
    out = name or f"{col}_ema_{span}"
    if keep <= 0:
        return df.withColumn(out, F.last(F.col(col).cast("double"), ignorenulls=True).over(_w(key, date, Window.unboundedPreceding)))
    stretch = max(1, min(512, int(-200 / log10(keep))))
    # only rows with a value move the mean
    seen = F.count(col).over(_w(key, date, Window.unboundedPreceding))
    at = df.withColumn("_at", seen - 1).withColumn("_stretch", F.expr(f"_at div {stretch}")).withColumn("_k", F.pmod("_at", F.lit(stretch)))
    weight = F.when(F.col("_at") == 0, 1.0).otherwise(alpha)
    part = Window.partitionBy(key, "_stretch").orderBy(date).rowsBetween(Window.unboundedPreceding, 0)
    grown = F.sum(F.when(F.col(col).isNotNull(), F.col(col).cast("double") * weight / F.pow(F.lit(keep), F.col("_k")))).over(part)
    own = at.withColumn("_own", grown * F.pow(F.lit(keep), F.col("_k")))
    # the stretches' last means fade over the stretches after them; there are so few that they fit a list per entity
    ends = own.filter("_at >= 0").groupBy(key, "_stretch").agg(F.max_by("_own", "_at").alias("_end"), (F.max("_k") + 1).alias("_n"))
    listed = ends.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("_stretch", "_end", "_n"))).alias("_ends"))
    step = lambda acc, e: F.concat(acc, F.array(F.element_at(acc, -1) * F.pow(F.lit(keep), e["_n"]) + e["_end"]))
    carried = listed.select(key, F.aggregate("_ends", F.array(F.lit(0.0)), step).alias("_carried"))
    mean = F.col("_own") + F.element_at("_carried", F.col("_stretch").cast("int") + 1) * F.pow(F.lit(keep), F.col("_k") + 1)
    return own.join(carried, key, "left").withColumn(out, F.when(F.col("_at") >= 0, mean)).drop("_at", "_stretch", "_k", "_own", "_carried")


def nav_returns(df: DataFrame, key="scheme", date="date", col="nav", roll: int = 30) -> DataFrame:
    """Daily and log return, point-to-point return since the start, ``roll``-row return and drawdown of each row."""
    w = _w(key, date)
    run = _w(key, date, Window.unboundedPreceding)
    prev, back = F.lag(col).over(w), F.lag(col, roll).over(w)
    return (
        df.withColumn("daily_return", safe_div(F.col(col) - prev, prev))
        .withColumn("log_return", F.when((prev > 0) & (F.col(col) > 0), F.ln(F.col(col) / prev)))
        .withColumn("total_return", safe_div(F.col(col), F.first(col).over(run)) - 1)
        .withColumn("rolling_return", safe_div(F.col(col), back) - 1)
        .withColumn("drawdown", safe_div(F.col(col), F.max(col).over(run)) - 1)
    )


def nav_metrics(nav: DataFrame, benchmark: DataFrame, rf: float = 0.06, key="scheme", date="date", col="nav",
                bench="close", days: int = 252) -> DataFrame:
    """CAGR, volatility, Sharpe, Sortino, maximum drawdown, beta, alpha and return rank per scheme."""
    r = nav_returns(nav, key, date, col)
    # one benchmark row per date, so this window is as long as the calendar
    prev = F.lag(bench).over(Window.partitionBy(F.lit(0)).orderBy(date))
    b = benchmark.groupBy(date).agg(F.avg(bench).alias(bench)).withColumn("bench_return", safe_div(F.col(bench) - prev, prev)).select(date, "bench_return")
    j = r.join(b, date, "left")
    years = F.datediff(F.max(date), F.min(date)) / 365.25
    x, y, d = F.col("daily_return"), F.col("bench_return"), F.col("daily_return") - rf / days
    both = x.isNotNull() & y.isNotNull()
    stats = j.groupBy(key).agg(
        F.count("*").alias("n"), years.alias("years"),
        F.min_by(col, date).alias("first_nav"), F.max_by(col, date).alias("last_nav"),
        F.avg(x).alias("mean_return"), F.stddev_samp(x).alias("sd"),
        F.sqrt(F.avg(F.when(x.isNotNull(), F.pow(F.least(d, F.lit(0.0)), 2)))).alias("downside"),
        F.min("drawdown").alias("max_drawdown"),
        F.covar_samp(F.when(both, x), F.when(both, y)).alias("cov"), F.var_samp(F.when(both, y)).alias("var"),
        F.avg(F.when(both, x)).alias("mx"), F.avg(F.when(both, y)).alias("my"),
    )
    out = stats.select(
        key, "n", F.when(F.col("years") > 0, F.pow(F.col("last_nav") / F.col("first_nav"), 1 / F.nullif("years", F.lit(0.0))) - 1).alias("cagr"),
        (F.col("sd") * F.sqrt(F.lit(float(days)))).alias("volatility"),
        (safe_div(F.col("mean_return") - rf / days, "sd") * F.sqrt(F.lit(float(days)))).alias("sharpe"),
        (safe_div(F.col("mean_return") - rf / days, "downside") * F.sqrt(F.lit(float(days)))).alias("sortino"),
        "max_drawdown", safe_div("cov", "var").alias("beta"),
        ((F.col("mx") - rf / days - safe_div("cov", "var") * (F.col("my") - rf / days)) * days).alias("alpha"),
    )
    # how many schemes do better, from sums over key ranges rather than one global sort
    counts = out.filter(F.col("cagr").isNotNull()).groupBy("cagr").agg(F.count("*").alias("c"))
    ranks = running_totals(counts, [F.col("cagr")], {"cum": F.col("c")}, totals=True, aggregated=True).select(
        "cagr", (F.col("cum_total") - F.col("cum") + 1).alias("cagr_rank"))
    return out.join(ranks, "cagr", "left")


def rate_of_change(df: DataFrame, n: int, key="scheme", date="date", col="nav") -> DataFrame:
    back = F.lag(col, n).over(_w(key, date))
    return df.withColumn(f"roc_{n}", safe_div((F.col(col) - back) * 100, back))


# ---- drift ---------------------------------------------------------------------------------

SIGNATURE_FIELDS = ("title", "headline", "source", "sentiment", "market_impact", "timestamp")


def scored_signals(signals: DataFrame) -> DataFrame:
    """Signals with their signature and direction score; missing fields fall back along the usual aliases."""
    have = lambda *names: [F.col(n) for n in names if n in signals.columns]
    first = lambda cols, d: F.coalesce(*cols, F.lit(d)) if cols else F.lit(d)
    sig = signature([n if n in signals.columns else F.lit("") for n in SIGNATURE_FIELDS])
    conf = have("confidence") or have("score") or [F.lit(0.5)]
    return signals.withColumn("signature", sig).withColumn("direction", signal_score(
        first(have("sentiment", "market_sentiment", "severity"), "neutral"),
        first(have("market_impact", "impact", "severity"), "neutral"), conf[0]))


def _drift(n, mean, neg, min_samples=12, mean_limit=-0.20, share_limit=0.60) -> Column:
    return (n >= min_samples) & ((mean <= mean_limit) | (neg >= share_limit))


def drift_series(signals: DataFrame, ts: str, key: str, window: int = 50, chunk: int = 100_000) -> DataFrame:
    """Drift state after every unique signal, in arrival order over the whole table."""
    unique = dedupe(scored_signals(signals).select(key, ts, "signature", "direction"), ["signature"], [ts, key])
    ranked = global_rank(unique, [ts, key])
    out = last_rows_window(ranked, "rank", window, {
        "samples": F.count("direction"), "mean_score": F.avg("direction"),
        "negative_ratio": F.avg((F.col("direction") < 0).cast("double")),
    }, chunk)
    return out.withColumn("drift_detected", _drift(F.col("samples"), F.col("mean_score"), F.col("negative_ratio")))


def drift_status(signals: DataFrame, ts: str, key: str, window: int = 50) -> DataFrame:
    """Drift state now: over the newest ``window`` unique signals."""
    unique = dedupe(scored_signals(signals).select(key, ts, "signature", "direction"), ["signature"], [ts, key])
    recent = unique.orderBy(F.desc(ts), F.desc(key)).limit(window)
    one = recent.agg(F.count("*").alias("samples_seen"), F.coalesce(F.avg("direction"), F.lit(0.0)).alias("m"),
                     F.coalesce(F.avg((F.col("direction") < 0).cast("double")), F.lit(0.0)).alias("r"),
                     F.max(ts).alias("last_signal_at"))
    return one.select("samples_seen", F.round("m", 4).alias("mean_score"), F.round("r", 4).alias("negative_ratio"),
                      "last_signal_at", _drift(F.col("samples_seen"), F.col("m"), F.col("r")).alias("drift_detected"))


def mean_shift(df: DataFrame, score: str, order: list[str], baseline: float = 0.0, threshold: float = 0.3, last: int = 100) -> DataFrame:
    recent = df.orderBy(*[F.desc(c) for c in order]).limit(last)
    mean = F.coalesce(F.avg(score), F.lit(0.0))
    return recent.agg(F.count("*").alias("n"), mean.alias("mean_score"), (F.abs(mean - baseline) > threshold).alias("drift"))
