"""A quality classifier: random-indexing word vectors pooled per document, a two-layer network, calibrated scores.

Word vectors come from the whole corpus: every token falls into one of ``BUCKETS`` by its hash, each bucket has a sparse
random index vector, and the vector of a bucket is the sum of the index vectors of its neighbours in all texts. A
document is the mean, the spread and the neighbour agreement of the vectors of all its tokens, and how many there are. The network learns from labelled documents only.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .common import free_name, mix64, text_of, worker_state
from .shingles import byte_codes, powers

#: Sizes of the model, whatever the corpus holds; neighbours on either side that make up a word's context.
BUCKETS, DIMS, REACH = 1 << 14, 32, 2
#: A text is read in parts of so many bytes, cut anywhere a token ends.
PART = 1 << 19


def _kinds() -> np.ndarray:
    """0 blank, 1 letter or part of one, 2 digit, 3 mark."""
    kind = np.full(256, 3, np.uint8)
    kind[:33] = 0
    kind[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1
    kind[48:58] = 2
    return kind


def _tokens(data: np.ndarray, state: dict) -> np.ndarray:
    """The bucket of each run of letters, of digits or of marks in ``data``; case counts."""
    if "kinds" not in state:
        codes = byte_codes()
        codes[65:91] = mix64(codes[65:91] + np.uint64(1))
        state["kinds"], state["cased"] = _kinds(), codes
    if "powers" not in state or len(state["powers"][0]) < len(data):
        state["powers"] = powers(1 << max(16, int(len(data)).bit_length()))
    up, down = state["powers"]
    kind = state["kinds"][data]
    edge = np.flatnonzero(np.diff(kind)) + 1
    starts = np.concatenate(([0], edge)) if len(data) else np.zeros(0, np.int64)
    ends = np.concatenate((edge, [len(data)])) if len(data) else starts
    keep = kind[starts] > 0
    starts, ends = starts[keep], ends[keep]
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(state["cased"][data] * up[: len(data)], out=sums[1:])
    return (mix64((sums[ends] - sums[starts]) * down[starts]) % np.uint64(BUCKETS)).astype(np.int64)


def _parts(text: bytes):
    """The text in parts of bounded size; a token longer than a part is read as several."""
    data, at = np.frombuffer(text, np.uint8), 0
    while at < len(data):
        end = min(len(data), at + PART)
        if end < len(data):
            blank = np.flatnonzero(data[at:end] < 33)
            end = at + int(blank[-1]) + 1 if len(blank) else end
        yield data[at:end]
        at = end


def _index_vectors() -> np.ndarray:
    """Four entries of +1 or -1 for each bucket; the last row, which stands between texts, is zero."""
    rng = np.random.default_rng(17)
    out = np.zeros((BUCKETS + 1, DIMS), np.float32)
    for _ in range(4):
        out[np.arange(BUCKETS), rng.integers(0, DIMS, BUCKETS)] += rng.choice(np.float32([-1, 1]), BUCKETS)
    return out


def _contexts(source):
    """Sums of neighbours' index vectors for each bucket that occurs in the partition."""
    index, state = _index_vectors(), worker_state("buckets", dict)
    total = np.zeros((BUCKETS + 1, DIMS))
    gap = np.full(REACH, BUCKETS)

    def add(ids: np.ndarray) -> None:
        own = index[ids]
        near = own * 2
        for k in range(1, REACH + 1):
            near[k:] += own[:-k]
            near[:-k] += own[k:]
        for d in range(DIMS):
            total[:, d] += np.bincount(ids, near[:, d], BUCKETS + 1)

    for batch in source:
        held, size = [], 0
        for text in batch.column(0).to_pylist():
            for data in _parts(text.encode()):
                held += [_tokens(data, state), gap]
                size += len(data)
                if size >= PART:
                    add(np.concatenate(held))
                    held, size = [], 0
        if held:
            add(np.concatenate(held))
    seen = np.flatnonzero(np.abs(total[:BUCKETS]).sum(axis=1))
    yield pa.RecordBatch.from_arrays([pa.array(seen), *[pa.array(total[seen, d].astype(np.int64)) for d in range(DIMS)]], names=["bucket", *[f"d{d}" for d in range(DIMS)]])


def word_vectors(docs: DataFrame) -> np.ndarray:
    """A unit vector for each bucket, from all texts. The driver gets at most BUCKETS rows, whatever the corpus holds."""
    kinds = "bucket long, " + ", ".join(f"d{d} long" for d in range(DIMS))
    sums = docs.select(text_of().alias("text")).mapInArrow(_contexts, kinds).groupBy("bucket").agg(*[F.sum(f"d{d}").alias(f"d{d}") for d in range(DIMS)]).toArrow()
    out = np.zeros((BUCKETS, DIMS), np.float32)
    if sums.num_rows:
        rows = np.stack([sums.column(f"d{d}").to_numpy() for d in range(DIMS)], axis=1).astype(np.float64)
        out[sums.column("bucket").to_numpy()] = rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)
    return out


#: Mean, spread and agreement of neighbours in each dimension, and the logarithm of the number of tokens.
POOLED = 3 * DIMS + 1


def _pooled(text: str, vectors: np.ndarray, state: dict) -> np.ndarray:
    """What the network sees of a text; zeros for one without tokens."""
    n, first, second, along = 0, np.zeros(DIMS), np.zeros(DIMS), np.zeros(DIMS)
    for data in _parts(text.encode()):
        v = vectors[_tokens(data, state)]
        n += len(v)
        first += v.sum(axis=0)
        second += np.einsum("ij,ij->j", v, v)
        along += np.einsum("ij,ij->j", v[1:], v[:-1])
    mean = first / max(n, 1)
    spread = np.maximum(second / max(n, 1) - mean * mean, 0)
    # how alike neighbours are beyond what the mean says: a repeated word agrees with itself
    return np.concatenate([mean, np.sqrt(spread), along / max(n - 1, 1) - mean * mean, [np.log1p(n)]])


@dataclass
class QualityModel:
    """Word vectors, the scaling of the pooled features, the two layers and the temperature."""

    vectors: np.ndarray
    centre: np.ndarray
    scale: np.ndarray
    layers: list[np.ndarray]
    temperature: float

    def logits(self, pooled: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.layers
        return np.tanh((pooled - self.centre) / self.scale @ w1 + b1) @ w2 + b2[0]

    def scores(self, pooled: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(pooled) / self.temperature, -60, 60)))


def _train(x: np.ndarray, y: np.ndarray, hidden: int, rounds: int, seed: int) -> list[np.ndarray]:
    """Two layers by Adam on shuffled parts of the rows, with weight decay."""
    rng = np.random.default_rng(seed)
    layers = [rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], hidden)), np.zeros(hidden), rng.normal(0, 1 / np.sqrt(hidden), hidden), np.zeros(1)]
    first, second = [np.zeros_like(w) for w in layers], [np.zeros_like(w) for w in layers]
    size, step = 128, 0
    per_round = -(-len(x) // size)
    for _ in range(max(rounds, 1500 // per_round)):
        order = rng.permutation(len(x))
        for at in range(0, len(x), size):
            rows = order[at : at + size]
            a = np.tanh(x[rows] @ layers[0] + layers[1])
            p = 1 / (1 + np.exp(-np.clip(a @ layers[2] + layers[3][0], -60, 60)))
            g = (p - y[rows]) / len(rows)
            back = np.outer(g, layers[2]) * (1 - a * a)
            grads = [x[rows].T @ back + 1e-4 * layers[0], back.sum(axis=0), a.T @ g + 1e-4 * layers[2], np.array([g.sum()])]
            step += 1
            for w, d, m, v in zip(layers, grads, first, second):
                m += 0.1 * (d - m)
                v += 0.001 * (d * d - v)
                w -= 0.004 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return layers


def _temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """What to divide logits by for the least log loss on rows the network has not seen."""
    tries = np.geomspace(0.2, 8, 80)
    loss = [np.mean(np.logaddexp(0, np.where(y > 0, -1, 1) * logits / t)) for t in tries]
    return float(tries[int(np.argmin(loss))])


def fit(docs: DataFrame, labels: DataFrame, sample: int = 20_000, hidden: int = 24, rounds: int = 30, seed: int = 5) -> QualityModel:
    """The model from all texts of ``docs`` and from ``labels`` (doc_id, quality).

    Rows whose crc32(doc_id as text) mod 5 is 0 are held out. At most ``sample`` labelled rows, chosen by hash, train
    it: three quarters the network, the others its temperature. Several labels of one document are averaged, null ones
    ignored. Without labels of both kinds every score is the share of label 1, or a half.
    """
    vectors = word_vectors(docs)
    rest = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    chosen = (
        labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.avg("quality").alias("_y"))
        .withColumn("_part", rest.cast("int")).filter("_part != 0").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    )

    def pool(source):
        state = worker_state("buckets", dict)
        for batch in source:
            rows = [_pooled(t, vectors, state).tobytes() for t in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(rows, pa.binary())], names=["doc_id", "_y", "_part", "x"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    # at most ``sample`` rows of labels, so their side fits everywhere
    got = texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "_y", "_part", "text").mapInArrow(pool, "doc_id long, _y double, _part int, x binary").toArrow()
    order = np.lexsort((got.column("x").to_pylist(), got.column("doc_id").to_numpy())) if got.num_rows else np.zeros(0, np.int64)
    x = np.frombuffer(b"".join(got.column("x").to_pylist()), np.float64).reshape(-1, POOLED)[order]
    y, part = (got.column("_y").to_numpy()[order] >= 0.5).astype(np.float64), got.column("_part").to_numpy()[order]
    tune = part == 1
    if min(y.sum(), (1 - y).sum()) < 1:
        share = np.clip(y.mean() if len(y) else 0.5, 0.01, 0.99)
        return QualityModel(vectors, np.zeros(POOLED), np.ones(POOLED), [np.zeros((POOLED, 1)), np.zeros(1), np.zeros(1), np.array([np.log(share / (1 - share))])], 1.0)
    if tune.all() or not tune.any():
        tune = np.zeros(len(y), bool)
    centre, scale = x[~tune].mean(axis=0), x[~tune].std(axis=0) + 1e-6
    layers = _train((x[~tune] - centre) / scale, y[~tune], hidden, rounds, seed)
    model = QualityModel(vectors, centre, scale, layers, 1.0)
    if tune.any():
        model.temperature = _temperature(model.logits(x[tune]), y[tune])
    return model


def score(docs: DataFrame, model: QualityModel, name: str = "quality_score") -> DataFrame:
    """``docs`` with a column ``name``: the probability of label 1 from the text alone.

    Null and empty texts get the score of an empty text; rows that repeat get the same score each; texts of any length
    count as a whole; an empty table stays empty. Other columns stay, whatever their names but ``name``.
    """
    text = free_name(docs, "_text")

    def run(source):
        state = worker_state("buckets", dict)
        for batch in source:
            pooled = np.array([_pooled(t, model.vectors, state) for t in batch.column(batch.num_columns - 1).to_pylist()]).reshape(-1, POOLED)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(model.scores(pooled))], names=[*batch.schema.names, name])

    kinds = T.StructType([*docs.schema.fields, T.StructField(text, T.StringType()), T.StructField(name, T.DoubleType())])
    return docs.withColumn(text, text_of()).mapInArrow(run, kinds).drop(text)


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, **options) -> DataFrame:
    """The rows of ``docs`` that score at least ``threshold``; columns stay as they are, whatever their names.

    Null and empty texts share one score; of rows that repeat, all stay or none; an empty table stays empty.
    """
    name = free_name(docs, "_quality")
    return score(docs, fit(docs, labels, **options), name).filter(F.col(name) >= threshold).drop(name)
