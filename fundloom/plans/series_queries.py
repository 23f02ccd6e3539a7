"""Series per scheme and drift over signals."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import evaluation as EV, timeseries as TS
from ..operators.ordered import global_rank
from . import views as V
from .registry import query

FILLED = """cal AS (SELECT scheme, unnest(generate_series(a, b, INTERVAL 1 DAY))::DATE AS date FROM (SELECT scheme, min(date) AS a, max(date) AS b FROM nav GROUP BY 1)),
filled AS (SELECT scheme, date, last_value(nav IGNORE NULLS) OVER (PARTITION BY scheme ORDER BY date ROWS UNBOUNDED PRECEDING) AS nav FROM cal LEFT JOIN nav USING (scheme, date))"""


@query("""SELECT scheme, date, round(avg(nav) OVER (PARTITION BY scheme ORDER BY date ROWS 6 PRECEDING), 6) AS sma_7,
 CASE WHEN count(nav) OVER (PARTITION BY scheme ORDER BY date ROWS 29 PRECEDING) >= 30 THEN round(avg(nav) OVER (PARTITION BY scheme ORDER BY date ROWS 29 PRECEDING), 6) END AS sma_30 FROM nav""", "nav")
def moving_averages(t):
    n = TS.sma(TS.sma(V.nav(t), 7, name="sma_7"), 30, min_periods=30, name="sma_30")
    return n.select("scheme", "date", F.round("sma_7", 6).alias("sma_7"), F.round("sma_30", 6).alias("sma_30"))


@query("""SELECT scheme, unnest(generate_series(a, b, INTERVAL 1 DAY))::DATE AS date FROM (SELECT scheme, min(date) AS a, max(date) AS b FROM nav GROUP BY 1)""", "nav")
def calendar_days(t):
    return TS.calendar(V.nav(t)).select("scheme", "date")


@query(f"WITH {FILLED} SELECT * FROM filled", "nav")
def forward_fill(t):
    return TS.forward_fill(V.nav(t)).select("scheme", "date", "nav")


@query(f"""WITH {FILLED}, r AS (SELECT scheme, min(nav) AS lo, max(nav) AS hi FROM filled GROUP BY 1)
SELECT scheme, date, nav, round(avg(nav) OVER (PARTITION BY scheme ORDER BY date ROWS 6 PRECEDING), 6) AS nav_sma_7, round(avg(nav) OVER (PARTITION BY scheme ORDER BY date ROWS 29 PRECEDING), 6) AS nav_sma_30,
 round((nav - lo) / (hi - lo), 8) AS nav_scaled FROM filled JOIN r USING (scheme)""", "nav")
def nav_preprocess(t):
    p = TS.nav_preprocess(V.nav(t, TS.dealt_by_days), dealt=True)
    return p.select("scheme", "date", "nav", F.round("nav_sma_7", 6).alias("nav_sma_7"), F.round("nav_sma_30", 6).alias("nav_sma_30"), F.round("nav_scaled", 8).alias("nav_scaled"))


@query("""SELECT scheme, date, nav FROM (SELECT *, row_number() OVER (PARTITION BY scheme ORDER BY date DESC) AS rn FROM nav) WHERE rn <= 30""", "nav")
def last_rows(t):
    return TS.last_n(V.nav(t), "scheme", "date", 30)


@query("""SELECT scheme, date, coalesce(p, nav) AS open, greatest(coalesce(p, nav), nav) AS high, least(coalesce(p, nav), nav) AS low, nav AS close
FROM (SELECT *, lag(nav) OVER (PARTITION BY scheme ORDER BY date) AS p FROM nav)""", "nav")
def ohlc_bars(t):
    return TS.ohlc_from_nav(V.nav(t))


@query("""SELECT scheme, date, round(list_sum(x), 6) AS x_sum, x[1] AS x_first, x[30] AS x_last, y[1] AS y_first, y[5] AS y_last FROM (
SELECT scheme, date, list(nav) OVER (PARTITION BY scheme ORDER BY date ROWS 29 PRECEDING) AS x, list(nav) OVER (PARTITION BY scheme ORDER BY date ROWS BETWEEN 1 FOLLOWING AND 5 FOLLOWING) AS y FROM nav) WHERE len(x) = 30 AND len(y) = 5""", "nav")
def lookback_sequences(t):
    s = TS.sequences(V.nav(t))
    return s.select("scheme", "date", F.round(F.aggregate("x", F.lit(0.0), lambda a, v: a + v), 6).alias("x_sum"), F.col("x")[0].alias("x_first"), F.col("x")[29].alias("x_last"),
                    F.col("y")[0].alias("y_first"), F.col("y")[4].alias("y_last"))


@query("""SELECT scheme, date, CASE WHEN pos < a THEN 'train' WHEN pos < a + floor(n * 0.15::DOUBLE) THEN 'val' ELSE 'test' END AS split FROM (
SELECT *, floor(n * 0.7::DOUBLE) AS a FROM (SELECT scheme, date, row_number() OVER (PARTITION BY scheme ORDER BY date) - 1 AS pos, count(*) OVER (PARTITION BY scheme) AS n FROM nav))""", "nav")
def temporal_split(t):
    return TS.temporal_split(V.nav(t)).select("scheme", "date", "split")


MOMENTUM = """m AS (SELECT scheme, count(*) AS n, max(nav) FILTER (r = 1) AS last, max(nav) FILTER (r = 5) AS fifth, stddev_pop(nav) FILTER (r <= 10) AS sd, avg(nav) FILTER (r <= 10) AS mean
 FROM (SELECT *, row_number() OVER (PARTITION BY scheme ORDER BY date DESC) AS r FROM nav) WHERE r <= 30 GROUP BY 1 HAVING count(*) >= 30),
fc AS (SELECT scheme, last, greatest(75, least(99, 99 - 1000 * sd / mean)) AS conf, CAST(k AS INTEGER) AS step, round_even(last + k * ((last - fifth) / 5), 2) AS forecast, round_even(last + 5 * ((last - fifth) / 5), 2) AS fin FROM m, (SELECT unnest(range(1, 6)) AS k))"""


@query(f"""WITH {MOMENTUM} SELECT scheme, last AS historical_last, round_even(conf, 1) AS confidence_score, CASE WHEN fin > last THEN 'UPWARD' WHEN fin < last THEN 'DOWNWARD' ELSE 'STABLE' END AS trend, step, forecast FROM fc""", "nav")
def momentum_forecast(t):
    return TS.momentum_forecast(V.nav(t))


@query(f"""WITH {MOMENTUM} SELECT scheme, round((fin - last) * 100 / last, 6) AS forecast_change_pct FROM fc WHERE step = 5""", "nav")
def forecast_change(t):
    return TS.forecast_change(TS.momentum_forecast(V.nav(t))).withColumn("forecast_change_pct", F.round("forecast_change_pct", 6))


@query("""SELECT scheme, date, nav > lag(nav) OVER (PARTITION BY scheme ORDER BY date) AS is_up FROM nav""", "nav")
def direction(t):
    return TS.direction(V.nav(t)).select("scheme", "date", "is_up")


@query("""SELECT scheme, date, round((nav - lo) / (hi - lo), 8) AS own, round((nav - glo) / (ghi - glo), 8) AS whole FROM (SELECT *, min(nav) OVER (PARTITION BY scheme) AS lo, max(nav) OVER (PARTITION BY scheme) AS hi,
 min(nav) OVER () AS glo, max(nav) OVER () AS ghi FROM nav)""", "nav")
def minmax_scaling(t):
    n = TS.minmax_global(TS.minmax_by(V.nav(t), name="own"), name="whole")
    return n.select("scheme", "date", F.round("own", 8).alias("own"), F.round("whole", 8).alias("whole"))


@query("""SELECT scheme, date, round(nav / p - 1, 8) AS daily_return, round(ln(nav / p), 8) AS log_return, round(nav / f - 1, 8) AS total_return, round(nav / b - 1, 8) AS rolling_return, round(nav / h - 1, 8) AS drawdown FROM (
SELECT scheme, date, nav, lag(nav) OVER w AS p, lag(nav, 30) OVER w AS b, first_value(nav) OVER w AS f, max(nav) OVER (PARTITION BY scheme ORDER BY date ROWS UNBOUNDED PRECEDING) AS h FROM nav WINDOW w AS (PARTITION BY scheme ORDER BY date))""", "nav")
def nav_returns(t):
    r = TS.nav_returns(V.nav(t))
    return r.select("scheme", "date", *[F.round(c, 8).alias(c) for c in ("daily_return", "log_return", "total_return", "rolling_return", "drawdown")])


@query("""WITH r AS (SELECT scheme, date, nav, nav / lag(nav) OVER (PARTITION BY scheme ORDER BY date) - 1 AS x, nav / max(nav) OVER (PARTITION BY scheme ORDER BY date ROWS UNBOUNDED PRECEDING) - 1 AS dd FROM nav),
b AS (SELECT date, close / lag(close) OVER (ORDER BY date) - 1 AS y FROM bench),
s AS (SELECT scheme, count(*) AS n, date_diff('day', min(date), max(date)) / 365.25::DOUBLE AS years, arg_min(nav, date) AS f, arg_max(nav, date) AS l, avg(x) AS mx, stddev_samp(x) AS sd,
 sqrt(avg(CASE WHEN x IS NOT NULL THEN pow(least(x - 0.06::DOUBLE / 252, 0), 2) END)) AS down, min(dd) AS mdd, covar_samp(x, y) AS cov, var_samp(y) FILTER (x IS NOT NULL) AS v,
 avg(x) FILTER (y IS NOT NULL) AS ax, avg(y) FILTER (x IS NOT NULL) AS ay FROM r LEFT JOIN b USING (date) GROUP BY 1)
SELECT scheme, n, round(pow(l / f, 1 / years) - 1, 6) AS cagr, round(sd * sqrt(252), 6) AS volatility, round((mx - 0.06::DOUBLE / 252) / sd * sqrt(252), 6) AS sharpe, round((mx - 0.06::DOUBLE / 252) / down * sqrt(252), 6) AS sortino,
 round(mdd, 8) AS max_drawdown, round(cov / v, 6) AS beta, round((ax - 0.06::DOUBLE / 252 - cov / v * (ay - 0.06::DOUBLE / 252)) * 252, 5) AS alpha, rank() OVER (ORDER BY pow(l / f, 1 / years) DESC) AS cagr_rank FROM s""", "nav bench")
def nav_metrics(t):
    m = TS.nav_metrics(V.nav(t), V.bench(t))
    return m.select("scheme", "n", *[F.round(c, d).alias(c) for c, d in (("cagr", 6), ("volatility", 6), ("sharpe", 6), ("sortino", 6), ("max_drawdown", 8), ("beta", 6), ("alpha", 5))], "cagr_rank")


@query("""SELECT scheme, date, round(CASE WHEN len(l) = 1 THEN l[1] ELSE list_reduce(l, lambda a, x: a * (1 - 2.0::DOUBLE / 21) + x * (2.0::DOUBLE / 21)) END, 6) AS ema_20, round((nav - back) * 100 / back, 6) AS roc_10
FROM (SELECT *, list(nav) OVER (PARTITION BY scheme ORDER BY date ROWS 391 PRECEDING) AS l, lag(nav, 10) OVER (PARTITION BY scheme ORDER BY date) AS back FROM nav)""", "nav")
def ema_and_roc(t):
    n = TS.rate_of_change(TS.ema(V.nav(t), 20, name="ema_20"), 10)
    return n.select("scheme", "date", F.round("ema_20", 6).alias("ema_20"), F.round("roc_10", 6).alias("roc_10"))


SCORED = """sc AS (SELECT event_id, ts, sha1(title || '||' || source || '|' || sentiment || '|' || coalesce(market_impact, '') || '|') AS sig,
 greatest(-1, least(1, (CASE sentiment WHEN 'positive' THEN 1 WHEN 'negative' THEN -1 ELSE 0 END + CASE market_impact WHEN 'bullish' THEN 0.25::DOUBLE WHEN 'bearish' THEN -0.25::DOUBLE ELSE 0 END) * greatest(0.3::DOUBLE, least(confidence, 1)))) AS d FROM signals),
un AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sig ORDER BY ts, event_id) AS rn FROM sc) WHERE rn = 1)"""


@query(f"WITH {SCORED} SELECT event_id, sig AS signature, d AS direction FROM sc", "signals")
def signal_scores(t):
    s = TS.scored_signals(V.signals(t).withColumn("confidence", F.col("conf_text")).withColumn("confidence", F.when(
        F.col("conf_text") == "n/a", F.col("conf_text")).otherwise((F.col("conf_text").try_cast("double") / 97).cast("string"))))
    return s.select("event_id", "signature", "direction")


@query(f"""WITH {SCORED} SELECT event_id, ts, rank, samples, mean_score, negative_ratio, samples >= 12 AND (m <= -0.2 OR r >= 0.6) AS drift_detected FROM (
SELECT event_id, ts, row_number() OVER (ORDER BY ts, event_id) AS rank, count(*) OVER w AS samples, avg(d) OVER w AS m, round(avg(d) OVER w, 6) AS mean_score, avg(CASE WHEN d < 0 THEN 1.0::DOUBLE ELSE 0 END) OVER w AS r,
 round(avg(CASE WHEN d < 0 THEN 1.0::DOUBLE ELSE 0 END) OVER w, 6) AS negative_ratio FROM un WINDOW w AS (ORDER BY ts, event_id ROWS 49 PRECEDING))""", "signals")
def rolling_drift(t):
    d = TS.drift_series(V.signals(t), "ts", "event_id", chunk=1000)
    return d.select("event_id", "ts", "rank", "samples", F.round("mean_score", 6).alias("mean_score"), F.round("negative_ratio", 6).alias("negative_ratio"), "drift_detected")


@query(f"""WITH {SCORED} SELECT count(*) AS samples_seen, round(avg(d), 4) AS mean_score, round(avg(CASE WHEN d < 0 THEN 1.0::DOUBLE ELSE 0 END), 4) AS negative_ratio, max(ts) AS last_signal_at,
 count(*) >= 12 AND (avg(d) <= -0.2 OR avg(CASE WHEN d < 0 THEN 1.0::DOUBLE ELSE 0 END) >= 0.6) AS drift_detected FROM (SELECT * FROM un ORDER BY ts DESC, event_id DESC LIMIT 50)""", "signals")
def drift_status(t):
    return TS.drift_status(V.signals(t), "ts", "event_id")


@query("""SELECT count(*) AS n, round(avg(confidence), 6) AS mean_score, abs(avg(confidence) - 0.1) > 0.3 AS drift FROM (SELECT * FROM signals ORDER BY ts DESC, event_id DESC LIMIT 100)""", "signals")
def mean_shift(t):
    return TS.mean_shift(V.signals(t), "confidence", ["ts", "event_id"], 0.1).withColumn("mean_score", F.round("mean_score", 6))


@query("""SELECT event_id, row_number() OVER (ORDER BY value, event_id) AS rank FROM events""")
def global_ranks(t):
    return global_rank(t.events.select("event_id", "value"), ["value", "event_id"]).select("event_id", "rank")


@query("""SELECT count(*) AS steps, round(avg(CASE WHEN (dy > 0) = (dp > 0) THEN 1.0::DOUBLE ELSE 0 END), 6) AS directional_accuracy FROM (
SELECT nav - lag(nav) OVER w AS dy, s - lag(s) OVER w AS dp FROM (SELECT *, round(avg(nav) OVER (PARTITION BY scheme ORDER BY date ROWS 6 PRECEDING), 6) AS s FROM nav) WINDOW w AS (PARTITION BY scheme ORDER BY date)) WHERE dy IS NOT NULL""", "nav")
def directional_accuracy(t):
    n = TS.sma(V.nav(t), 7, name="s").withColumn("s", F.round("s", 6))
    return EV.directional_accuracy(n, "scheme", "date", "nav", "s").withColumn("directional_accuracy", F.round("directional_accuracy", 6))
