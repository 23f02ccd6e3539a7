"""Exact model metrics as aggregates and range-wise running sums."""

from __future__ import annotations

from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.scalars import safe_div
from ..functions.vectors import dot
from .ordered import running_totals
from .topk import union_all


def confusion(df: DataFrame, label: str, pred: str) -> DataFrame:
    return df.groupBy(F.col(label).alias("actual"), F.col(pred).alias("predicted")).agg(F.count("*").alias("n"))


def classification_report(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy, macro and weighted averages; undefined ratios are 0."""
    n = F.col("n")
    sides = F.array(
        F.struct(F.col("actual").alias("cls"), F.when(F.col("actual") == F.col("predicted"), n).otherwise(0).alias("tp"),
                 n.alias("support"), F.lit(0).cast("bigint").alias("called")),
        F.struct(F.col("predicted").alias("cls"), F.lit(0).cast("bigint").alias("tp"), F.lit(0).cast("bigint").alias("support"), n.alias("called")),
    )
    per = (
        confusion(df, label, pred).select(F.inline(sides)).groupBy("cls")
        .agg(F.sum("tp").alias("tp"), F.sum("support").alias("support"), F.sum("called").alias("called"))
        .withColumn("precision", safe_div("tp", "called", 0.0)).withColumn("recall", safe_div("tp", "support", 0.0))
        .withColumn("f1", safe_div(F.col("tp") * 2.0, F.col("called") + F.col("support"), 0.0))
    )
    w = lambda c: safe_div(F.sum(F.col(c) * F.col("support")), F.sum("support"), 0.0)
    acc = safe_div(F.sum("tp"), F.sum("support"), 0.0)
    row = lambda name, p, r, f: F.struct(F.lit(name).alias("class"), p.alias("precision"), r.alias("recall"), f.alias("f1"),
                                         F.sum("support").alias("support"))
    totals = per.agg(F.array(
        row("accuracy", acc, acc, acc), row("macro avg", F.avg("precision"), F.avg("recall"), F.avg("f1")),
        row("weighted avg", w("precision"), w("recall"), w("f1"))).alias("r")).select(F.inline("r"))
    return per.select(F.col("cls").cast("string").alias("class"), "precision", "recall", "f1", "support").unionByName(totals)


def score_counts(df: DataFrame, label: str, prob: str) -> DataFrame:
    """Positives and negatives per distinct score: ties are one row and most data is combined before any sort."""
    return df.filter(F.col(prob).isNotNull()).groupBy(F.col(prob).alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) != 1).alias("n"))


def roc_auc(df: DataFrame, label: str, prob: str) -> DataFrame:
    r = running_totals(score_counts(df, label, prob), ["score"], {"below": F.col("n"), "pos": F.col("p")}, totals=True, aggregated=True)
    wins = F.col("p") * (F.col("below") - F.col("n") + F.col("n") * 0.5)
    return r.agg(safe_div(F.sum(wins), F.max("pos_total").cast("double") * F.max("below_total")).alias("roc_auc"))


def _descending(df: DataFrame, label: str, prob: str) -> DataFrame:
    c = score_counts(df, label, prob).withColumn("neg_score", -F.col("score"))
    return running_totals(c, ["neg_score"], {"tp": F.col("p"), "fp": F.col("n")}, totals=True, aggregated=True)


def average_precision(df: DataFrame, label: str, prob: str) -> DataFrame:
    d = _descending(df, label, prob)
    return d.agg(safe_div(F.sum(F.col("p") * F.col("tp") / (F.col("tp") + F.col("fp"))), F.max("tp_total")).alias("average_precision"))


def roc_curve(df: DataFrame, label: str, prob: str) -> DataFrame:
    """(threshold, fpr, tpr) for every distinct score, and the start point at an infinite threshold."""
    d = _descending(df, label, prob).select(
        F.col("score").alias("threshold"), safe_div("fp", "fp_total", 0.0).alias("fpr"), safe_div("tp", "tp_total", 0.0).alias("tpr"))
    start = df.agg(F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return d.unionByName(start)


THRESHOLDS = [round(0.25 + 0.02 * k, 2) for k in range(29)]


def threshold_curve(df: DataFrame, label: str, prob: str, grid: list[float] = THRESHOLDS) -> DataFrame:
    """Precision, recall and F1 at every threshold of the grid.

    A row only says how many thresholds it passes, so the data shrinks to one row per step before the running sum.
    """
    passed = F.array_size(F.filter(F.array(*[F.lit(t) for t in grid]), lambda t: F.col(prob) >= t))
    steps = df.filter(F.col(prob).isNotNull()).groupBy(passed.alias("passed")).agg(
        F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) != 1).alias("n"))
    every = steps.agg(F.collect_list(F.struct("passed", "p", "n")).alias("s"), F.sum("p").alias("pos"))
    at = every.select("s", "pos", F.posexplode(F.array(*[F.lit(t) for t in grid])).alias("i", "threshold"))
    above = lambda f: F.aggregate(F.filter("s", lambda x: x["passed"] > F.col("i")), F.lit(0).cast("bigint"), lambda a, x: a + x[f])
    at = at.select("i", "threshold", "pos", above("p").alias("tp"), above("n").alias("fp"))
    return at.select("i", "threshold", safe_div("tp", F.col("tp") + F.col("fp"), 0.0).alias("precision"),
                     safe_div("tp", "pos", 0.0).alias("recall"),
                     safe_div(F.col("tp") * 2.0, F.col("tp") + F.col("fp") + F.col("pos"), 0.0).alias("f1"))


def threshold_search(df: DataFrame, label: str, prob: str, grid: list[float] = THRESHOLDS) -> DataFrame:
    """The threshold with the best F1; the first one wins a tie."""
    best = threshold_curve(df, label, prob, grid).agg(
        F.max_by(F.struct("threshold", "precision", "recall", "f1"), F.struct(F.col("f1"), -F.col("i"))).alias("b"))
    return best.select("b.*")


def regression_metrics(df: DataFrame, y: str, yhat: str) -> DataFrame:
    err = F.col(y) - F.col(yhat)
    both = df.filter(F.col(y).isNotNull() & F.col(yhat).isNotNull())
    m = both.agg(F.avg(err * err).alias("mse"), F.avg(F.abs(err)).alias("mae"), F.var_pop(y).alias("v"))
    return m.select("mse", F.sqrt("mse").alias("rmse"), "mae", F.when(F.col("v") > 0, 1 - F.col("mse") / F.col("v")).otherwise(0.0).alias("r2"))


def directional_accuracy(df: DataFrame, key: str, date: str, y: str, yhat: str) -> DataFrame:
    w = Window.partitionBy(key).orderBy(date)
    step = df.select((F.col(y) - F.lag(y).over(w)).alias("dy"), (F.col(yhat) - F.lag(yhat).over(w)).alias("dp"))
    return step.filter("dy is not null and dp is not null").agg(
        F.count("*").alias("steps"), F.avg(((F.col("dy") > 0) == (F.col("dp") > 0)).cast("double")).alias("directional_accuracy"))


def silhouette(df: DataFrame, features: str, cluster: str) -> float:
    """Mean silhouette (squared Euclidean distance)."""
    return ClusteringEvaluator(featuresCol=features, predictionCol=cluster, metricName="silhouette",
                               distanceMeasure="squaredEuclidean").evaluate(df)


def silhouette_points(df: DataFrame, key: str, cols: list[str], cluster: str) -> DataFrame:
    """Silhouette of each point (squared Euclidean distance) from per-cluster sums; no pair of points is formed.

    Mean squared distance from x to a cluster is |x|^2 - 2 x.mean + mean|y|^2; the point itself is taken out of its own.
    """
    x = F.array(*[F.col(c).cast("double") for c in cols])
    stats = df.groupBy(cluster).agg(
        F.count("*").alias("n"), F.array(*[F.avg(c) for c in cols]).alias("mean"), F.avg(dot(x, x)).alias("sq"))
    packed = stats.agg(F.collect_list(F.struct(F.col(cluster).alias("c"), "n", "mean", "sq")).alias("s")).scalar()
    far = df.withColumn("_x", x).withColumn("_s", packed).withColumn("_d", F.transform("_s", lambda s: F.struct(
        (s["c"] == F.col(cluster)).alias("own"), s["n"].alias("n"),
        F.greatest(dot("_x", "_x") - 2 * dot(F.col("_x"), s["mean"]) + s["sq"], F.lit(0.0)).alias("d"))))
    own = F.filter("_d", lambda d: d["own"])[0]
    a = F.when(own["n"] > 1, own["d"] * own["n"] / (own["n"] - 1))
    others = F.filter("_d", lambda d: ~d["own"])
    b = F.array_min(F.transform(others, lambda d: d["d"]))
    far = far.withColumn("_a", a).withColumn("_b", b)
    return far.select(key, cluster, F.when(F.col("_a").isNull() | F.col("_b").isNull(), 0.0).otherwise(
        safe_div(F.col("_b") - F.col("_a"), F.greatest("_a", "_b"), 0.0)).alias("silhouette"))


def metrics_long(df: DataFrame, model: str) -> DataFrame:
    """One metrics row to (model, metric, value) rows."""
    return df.select(*[F.col(c).cast("double").alias(c) for c in df.columns]).unpivot([], df.columns, "metric", "value").select(
        F.lit(model).alias("model"), "metric", "value")


def metrics_manifest(*metrics: DataFrame) -> DataFrame:
    return union_all(*metrics)
