"""Lead scoring, sentiment and forecast models as MLlib pipelines, and their scoring operators."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import (IDF, CountVectorizer, ElementwiseProduct, IndexToString, NGram, Normalizer, OneHotEncoder,
                                RegexTokenizer, SQLTransformer, StringIndexer, VectorAssembler)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.ml.param.shared import HasInputCol, HasNumFeatures, HasOutputCol
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..functions.scalars import default, to_number
from ..functions.words import LEAD_CATEGORICAL, LEAD_NUMERIC
from .features import class_weights, stratified_folds
from .topk import union_all


# ---- lead model ----------------------------------------------------------------------------

def feature_frame(df: DataFrame, num: list[str], cat: list[str]) -> DataFrame:
    """The model's columns in the right types; absent or null ones become 0 and ``Unknown``."""
    new = {c: to_number(c, 0) if c in df.columns else F.lit(0.0) for c in num}
    new |= {c: default(F.col(c).cast("string"), "Unknown") if c in df.columns else F.lit("Unknown") for c in cat}
    return df.withColumns(new)


def _encoder(num: list[str], cat: list[str]) -> list:
    stages = []
    if cat:
        stages = [
            StringIndexer(inputCols=cat, outputCols=[f"{c}_idx" for c in cat], handleInvalid="keep", stringOrderType="alphabetAsc"),
            OneHotEncoder(inputCols=[f"{c}_idx" for c in cat], outputCols=[f"{c}_vec" for c in cat], dropLast=False),
        ]
    return stages + [VectorAssembler(inputCols=[*num, *[f"{c}_vec" for c in cat]], outputCol="features")]


def lead_estimator(num: list[str], cat: list[str], label: str, algo: str = "rf", trees: int = 200, depth: int | None = None, seed: int = 42) -> Pipeline:
    """Forests are 12 levels deep and boosted trees 6 unless ``depth`` says otherwise."""
    depth = depth or (12 if algo == "rf" else 6)
    common = dict(labelCol=label, featuresCol="features", weightCol="weight", seed=seed)
    clf = (RandomForestClassifier(numTrees=trees, maxDepth=depth, **common) if algo == "rf"
           else GBTClassifier(maxIter=trees, maxDepth=depth, stepSize=0.06, subsamplingRate=0.85, **common))
    return Pipeline(stages=[*_encoder(num, cat), clf])


def fit_lead_model(df: DataFrame, num: list[str] = LEAD_NUMERIC, cat: list[str] = LEAD_CATEGORICAL, label: str = "converted",
                   algo: str = "rf", trees: int = 200, depth: int | None = None, seed: int = 42) -> PipelineModel:
    # every stage and every tree level passes over these columns again
    train = class_weights(feature_frame(df, num, cat).select(*num, *cat, label), label)
    # dealt over the cores: each task sends the sums of all nodes of a level, so more tasks would only shuffle more
    train = train.repartition(df.sparkSession.sparkContext.defaultParallelism).persist()
    try:
        return lead_estimator(num, cat, label, algo, trees, depth, seed).fit(train)
    finally:
        train.unpersist()


def positive_probability(col: str = "probability") -> Column:
    return vector_to_array(col)[1]


def with_prediction_fields(schema: T.StructType) -> T.StructType:
    """The input schema plus what scoring adds."""
    return T.StructType([*schema.fields]).add("pred_label", T.IntegerType()).add("pred_proba", T.DoubleType())


def score_leads(df: DataFrame, model: PipelineModel, threshold: float = 0.5, num: list[str] = LEAD_NUMERIC,
                cat: list[str] = LEAD_CATEGORICAL) -> DataFrame:
    """Probability and label per row; works on a batch or a stream, all in the JVM."""
    # features are built beside the input in a struct, so the input columns come back unchanged
    whole = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_in")
    packed = feature_frame(df.select(whole, *[c for c in [*num, *cat] if c in df.columns]), num, cat)
    return model.transform(packed).select("_in.*", (positive_probability() >= threshold).cast("int").alias("pred_label"),
                                          positive_probability().alias("pred_proba"))


def score_activity(df: DataFrame, model: PipelineModel, **kw) -> DataFrame:
    """Probability from the three activity numbers alone; everything else is missing."""
    few = df.withColumns({c: to_number(c, 0) for c in LEAD_NUMERIC[:3] if c in df.columns})
    return score_leads(few, model, **kw)


def score_with_function(df: DataFrame, batch_fn, threshold: float = 0.5) -> DataFrame:
    """A user's own model: ``batch_fn(pandas frame) -> probabilities`` over Arrow batches."""
    def run(batches):
        for pdf in batches:
            prob = batch_fn(pdf)
            yield pdf.assign(pred_label=(prob >= threshold).astype("int32"), pred_proba=prob)

    return df.mapInPandas(run, with_prediction_fields(df.schema))


def grid_cv(df: DataFrame, estimator, grid: list[dict], label: str, key: str, folds: int = 3, metric: str = "fMeasureByLabel", parallelism: int = 4):
    """Grid search over stratified folds; returns the fitted cross-validator and (params, score) rows.

    The score is F1 of the positive class; ``metric="f1"`` weighs all classes.
    """
    cv = CrossValidator(
        estimator=estimator, estimatorParamMaps=grid, numFolds=folds, foldCol="fold", parallelism=parallelism,
        evaluator=MulticlassClassificationEvaluator(labelCol=label, predictionCol="prediction", metricName=metric, metricLabel=1.0))
    data = stratified_folds(df, label, key, folds).persist()
    try:
        fitted = cv.fit(data)
    finally:
        data.unpersist()
    rows = [(", ".join(f"{p.name}={v}" for p, v in sorted(g.items(), key=lambda t: t[0].name)), float(m))
            for g, m in zip(grid, fitted.avgMetrics)]
    return fitted, df.sparkSession.createDataFrame(rows, "params string, score double")


def param_grid(values: dict) -> list[dict]:
    b = ParamGridBuilder()
    for param, options in values.items():
        b = b.addGrid(param, options)
    return b.build()


def feature_names(df: DataFrame, features: str = "features") -> list[str]:
    attrs = df.schema[features].metadata["ml_attr"]["attrs"]
    flat = sorted((a["idx"], a["name"]) for group in attrs.values() for a in group)
    return [name for _, name in flat]


def explain(model: PipelineModel, df: DataFrame, num: list[str], cat: list[str]) -> DataFrame:
    """(feature, importance_score, impact) by importance; ``positive`` above 0.05."""
    names = feature_names(model.transform(feature_frame(df, num, cat).limit(1)))
    rows = [(n, float(v)) for n, v in zip(names, model.stages[-1].featureImportances.toArray())]
    out = df.sparkSession.createDataFrame(rows, "feature string, weight double")
    return out.select("feature", F.round("weight", 4).alias("importance_score"),
                      F.when(F.col("weight") > 0.05, "positive").otherwise("neutral").alias("impact")).orderBy(
        F.desc("importance_score"), "feature")


def top_features(model: PipelineModel, df: DataFrame, num: list[str], cat: list[str], n: int = 10) -> DataFrame:
    return explain(model, df, num, cat).limit(n)


# ---- sentiment model -----------------------------------------------------------------------

#: Words whose terms are counted together; a single text is never cut.
SLICE_WORDS = 1 << 20


def _murmur3(terms: pa.Array, seed: int = 42) -> np.ndarray:
    """MurmurHash3 (32 bits, as a signed number) of each string's UTF-8 bytes: the hash of ``HashingTF``."""
    at = np.frombuffer(terms.buffers()[1], np.int32)[terms.offset:terms.offset + len(terms) + 1].astype(np.int64)
    start, size = at[:-1], np.diff(at)
    data = np.concatenate([np.frombuffer(terms.buffers()[2] or b"", np.uint8), np.zeros(4, np.uint8)]).astype(np.uint32)
    word = lambda i: data[i] | data[i + 1] << 8 | data[i + 2] << 16 | data[i + 3] << 24
    turn = lambda x, r: x << np.uint32(r) | x >> np.uint32(32 - r)
    mix = lambda k: turn(k * np.uint32(0xCC9E2D51), 15) * np.uint32(0x1B873593)
    h = np.full(len(terms), seed, np.uint32)
    for i in range(int(size.max(initial=0)) // 4):
        on = np.flatnonzero(size >= 4 * i + 4)
        h[on] = turn(h[on] ^ mix(word(start[on] + 4 * i)), 13) * np.uint32(5) + np.uint32(0xE6546B64)
    rest = (size % 4).astype(np.uint32)
    h ^= mix(word(start + size - size % 4) & ((np.uint32(1) << rest * np.uint32(8)) - np.uint32(1)))
    h ^= size.astype(np.uint32)
    h = (h ^ h >> np.uint32(16)) * np.uint32(0x85EBCA6B)
    h = (h ^ h >> np.uint32(13)) * np.uint32(0xC2B2AE35)
    return (h ^ h >> np.uint32(16)).view(np.int32)


def _term_vectors(lists: pa.Array, buckets: int) -> pa.Array:
    """Sparse counts of the words and bigrams of each list, as ``VectorUDT`` stores them."""
    many = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(len(many)), many)
    words = lists.flatten().dictionary_encode()
    code, names = words.indices.to_numpy().astype(np.int64), words.dictionary
    # a word is a number, a pair of neighbours the number of both: only distinct terms are strings
    first = np.flatnonzero(row[1:] == row[:-1])
    pairs, pair = np.unique(code[first] * len(names) + code[first + 1], return_inverse=True)
    joined = pc.binary_join_element_wise(names.take(pa.array(pairs // max(1, len(names)))), names.take(pa.array(pairs % max(1, len(names)))), " ")
    slot = np.concatenate([_murmur3(names)[code], _murmur3(joined)[pair]]).astype(np.int64) % buckets
    at, times = np.unique(np.concatenate([row, row[first]]) * buckets + slot, return_counts=True)
    ends = pa.array(np.concatenate([[0], np.cumsum(np.bincount(at // buckets, minlength=len(many)))]).astype(np.int32))
    parts = [pa.array(np.zeros(len(many), np.int8)), pa.array(np.full(len(many), buckets, np.int32)),
             pa.ListArray.from_arrays(ends, pa.array((at % buckets).astype(np.int32))), pa.ListArray.from_arrays(ends, pa.array(times.astype(np.float64)))]
    return pa.StructArray.from_arrays(parts, names=["type", "size", "indices", "values"])


class TermHasher(Transformer, HasInputCol, HasOutputCol, HasNumFeatures, DefaultParamsReadable, DefaultParamsWritable):
    """Counts of a word list's words and bigrams in hashed buckets, the vectors of ``NGram`` and ``HashingTF``.

    Those turn every term of every text into a string and hash it; here a batch hashes each of its distinct terms once.
    """

    def __init__(self, inputCol: str | None = None, outputCol: str | None = None, numFeatures: int = 1 << 18):
        super().__init__()
        self._setDefault(numFeatures=1 << 18)
        self._set(inputCol=inputCol, outputCol=outputCol, numFeatures=numFeatures)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        buckets, limit = self.getNumFeatures(), SLICE_WORDS

        def count(lists: pa.Array) -> pa.Array:
            ends = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).cumsum()
            cuts = np.unique(np.concatenate([[0], np.flatnonzero(np.diff(ends // limit)) + 1, [len(ends)]]))
            return pa.concat_arrays([_term_vectors(lists[a:b], buckets) for a, b in zip(cuts, cuts[1:])] or [_term_vectors(lists, buckets)])

        # named by value, so that workers need not find the annotations of this module
        count.__annotations__ = {"lists": pa.Array, "return": pa.Array}
        return dataset.withColumn(self.getOutputCol(), F.arrow_udf(count, VectorUDT())(self.getInputCol()))


def fit_sentiment(df: DataFrame, text_col: str, label_col: str, max_features: int | None = None, min_df: int = 2, max_iter: int = 200,
                  vector_col: str | None = None, strength: float = 1.0, buckets: int = 1 << 18) -> PipelineModel:
    """Word and bigram TF-IDF (or a given vector column) into a class-weighted multinomial regression.

    Every term counts: terms are hashed into ``buckets``, so that no vocabulary goes through the driver; only with
    ``max_features`` the commonest terms are kept instead. Weights are idf + 1 on rows of unit length, and the penalty is 1 / (``strength`` * rows).
    """
    stages = [StringIndexer(inputCol=label_col, outputCol="_label", handleInvalid="skip", stringOrderType="alphabetAsc")]
    if vector_col is None:
        stages += [
            # a run of word characters ends at word boundaries, so the pattern need not look for them
            RegexTokenizer(inputCol=text_col, outputCol="w1", pattern=r"(?U)\w\w+", gaps=False),
            *([NGram(n=2, inputCol="w1", outputCol="w2"), SQLTransformer(statement="SELECT *, concat(w1, w2) AS grams FROM __THIS__"),
               CountVectorizer(inputCol="grams", outputCol="tf", vocabSize=max_features, minDF=min_df)] if max_features
              else [TermHasher(inputCol="w1", outputCol="tf", numFeatures=buckets)]),
        ]
    # the label is only needed for fitting: the scoring model leaves its indexer out
    train = df.withColumn(text_col, default(text_col, "")) if vector_col is None else df
    train = class_weights(train.select(vector_col or text_col, label_col), label_col).persist()
    counted = None
    try:
        shaped = Pipeline(stages=stages).fit(train)
        rows, done = shaped.transform(train), list(shaped.stages)
        if vector_col is None:
            # three passes read the counts; on disk they leave the memory to the blocks that every step of the regression reads
            rows = counted = rows.select("_label", "weight", "tf").persist(StorageLevel.DISK_ONLY)
            idf = IDF(inputCol="tf", outputCol="_idf").fit(rows)
            seen = np.array(idf.docFreq) >= min_df
            weigh = ElementwiseProduct(inputCol="tf", outputCol="_w", scalingVec=Vectors.dense(np.where(seen, idf.idf.toArray() + 1, 0.0)))
            done += [weigh, Normalizer(inputCol="_w", outputCol="features", p=2.0)]
            rows = PipelineModel(done[-2:]).transform(rows)
        lr = LogisticRegression(maxIter=max_iter, weightCol="weight", regParam=1 / (strength * max(1, train.count())), featuresCol=vector_col or "features", labelCol="_label")
        done.append(lr.fit(rows))
    finally:
        train.unpersist()
        if counted is not None:
            counted.unpersist()
    # names by code come from the indexer, however many there are
    return PipelineModel([*done[1:], IndexToString(inputCol="prediction", outputCol="predicted_label", labels=shaped.stages[0].labels)])


def score_sentiment(df: DataFrame, model: PipelineModel, text_col: str, positive: int = 1) -> DataFrame:
    """Label, its probability, and P(positive); blank text is 0.5."""
    keep = df.columns
    packed = df.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("_in"), default(text_col, "").alias(text_col))
    prob = vector_to_array("probability")
    blank = F.trim(text_col) == ""
    return model.transform(packed).select(
        "_in.*", "predicted_label", F.array_max(prob).alias("confidence"),
        F.when(blank, 0.5).otherwise(F.coalesce(prob[positive], F.lit(0.5))).alias("p_positive"))


# ---- NAV forecast --------------------------------------------------------------------------

def lag_sums(df: DataFrame, key="scheme", date="date", col="nav", lookback: int = 30, horizon: int = 5) -> DataFrame:
    """Per place of a row in its series: rows, their sum, and the sum of their products with the value ``d`` rows later.

    Columns: head (rows before it, null from ``lookback + horizon`` on), tail (rows after it, likewise), n, s, p0, p1 ..
    All lagged moments of the samples follow from these few rows: a moment is the sum over all rows less those too near
    an end of their series. One pass, one window, no sample is built.
    """
    reach = lookback + horizon
    w = Window.partitionBy(key).orderBy(date)
    value = F.col(col).cast("double")
    size = F.count("*").over(Window.partitionBy(key))
    place = F.row_number().over(w) - 1
    rows = df.select(place.alias("head"), (size - 1 - place).alias("tail"), value.alias("v"), *[F.lead(value, d).over(w).alias(f"v{d}") for d in range(1, reach)])
    near = lambda c: F.when(F.col(c) < reach, F.col(c).cast("int")).alias(c)
    return rows.groupBy(near("head"), near("tail")).agg(
        F.count("*").alias("n"), F.sum("v").alias("s"), F.sum(F.col("v") * F.col("v")).alias("p0"), *[F.sum(F.col("v") * F.col(f"v{d}")).alias(f"p{d}") for d in range(1, reach)])


@dataclass(frozen=True)
class LagModel:
    """One linear regression per step ahead: ``weights[h]`` over the last values, oldest first, and ``intercepts[h]``."""

    intercepts: tuple[float, ...]
    weights: tuple[tuple[float, ...], ...]


def _moments(sums: list, lookback: int, horizon: int) -> tuple[float, np.ndarray, np.ndarray]:
    """Number of samples, sums of their numbers (oldest first, targets last), and sums of products of these."""
    reach = lookback + horizon
    far = 10**9
    head = np.array([far if r.head is None else r.head for r in sums])
    tail = np.array([far if r.tail is None else r.tail for r in sums])
    table = np.array([[r.n, r.s, *[r[f"p{d}"] or 0.0 for d in range(reach)]] for r in sums], np.float64).reshape(len(sums), reach + 2)
    # number i of a sample is a row with i rows before it in the sample and reach - 1 - i after it
    own = lambda i: (head >= i) & (tail >= reach - 1 - i)
    first = np.array([table[own(i), 1].sum() for i in range(reach)])
    second = np.zeros((reach, reach))
    for i in range(reach):
        for j in range(i, reach):
            second[i, j] = second[j, i] = table[own(i), 2 + j - i].sum()
    return float(table[own(0), 0].sum()), first, second


def fit_nav_forecast(df: DataFrame, key="scheme", date="date", col="nav", lookback: int = 30, horizon: int = 5, reg: float = 1e-6) -> LagModel:
    """One linear regression per step ahead on the last ``lookback`` values of every series.

    The normal equations of all steps come from ``lag_sums`` and share one factor; ``reg`` is the penalty on weights of
    columns scaled to unit variance. Without samples all weights are zero.
    """
    n, first, second = _moments(lag_sums(df.filter(F.col(col).isNotNull()), key, date, col, lookback, horizon).collect(), lookback, horizon)
    if not n:
        return LagModel((0.0,) * horizon, ((0.0,) * lookback,) * horizon)
    mean = first / n
    cov = second / n - np.outer(mean, mean)
    x, xy = cov[:lookback, :lookback], cov[:lookback, lookback:]
    weights = np.linalg.lstsq(x + reg * np.diag(np.maximum(np.diag(x), 0)), xy, rcond=None)[0]
    return LagModel(tuple((mean[lookback:] - mean[:lookback] @ weights).tolist()), tuple(map(tuple, weights.T.tolist())))


def apply_nav_forecast(df: DataFrame, model: LagModel, key="scheme", date="date", col="nav") -> DataFrame:
    """Adds ``step_1`` .. ``step_h``, the forecast after each row; null where a series has no ``lookback`` values yet."""
    w = Window.partitionBy(key).orderBy(date)
    lookback = len(model.weights[0])
    value = F.col(col).cast("double")
    held = df.withColumn("_last", F.array(*[F.lag(value, lookback - 1 - i).over(w) if i < lookback - 1 else value for i in range(lookback)]))
    step = lambda b, ws: F.aggregate(F.zip_with("_last", F.lit(list(ws)), lambda x, c: x * c), F.lit(float(b)), lambda s, v: s + v)
    return held.withColumns({f"step_{h + 1}": step(b, ws) for h, (b, ws) in enumerate(zip(model.intercepts, model.weights))}).drop("_last")
