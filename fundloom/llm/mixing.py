"""Mixing documents to target shares by iterative proportional fitting, then sampling by calibrated probabilities."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import free_name, saved, text_of
from .tokens import encoder, word_bpe_path

#: What falls under none of the targets' names.
OTHER = "other"

#: Production mix: the one large source gives a quarter of the tokens, the others equal parts.
TARGETS = {
    "source": {"src0": 0.28, **{f"src{i}": 0.036 for i in range(1, 20)}, OTHER: 0.036},
    "lang": {"en": 0.58, "de": 0.15, "fr": 0.15, "es": 0.1, OTHER: 0.02},
    "topic": {"legal": 0.05, "table": 0.1, "long": 0.45, "short": 0.3, OTHER: 0.1},
}


def topic_of(text: Column) -> Column:
    """A coarse topic from the text's form: licence text, tables, long and short prose."""
    return (
        F.when(text.rlike("(?i)licen[sc]e|copyright"), "legal").when(text.contains(" | "), "table")
        .when(F.length(text) >= 4000, "long").when(F.length(text) > 0, "short").otherwise(OTHER)
    )


def words_of(text: Column, tokenizer: str | None = None) -> Column:
    """How many token ids the words of a text have, by the public tokenizer that packing uses: the token weight of a document."""
    path = tokenizer or word_bpe_path()

    @F.arrow_udf("long")
    def count(texts: pa.Array) -> pa.Array:
        tokens = encoder(path)
        return pa.array([len(tokens.encode(t.as_py() or "")) // tokens.width for t in texts], pa.int64())

    return count(text)


def rake(have: np.ndarray, targets: list[np.ndarray], rounds: int = 200, close: float = 1e-9) -> np.ndarray:
    """Weights with the inner structure of ``have`` whose margins are the targets.

    Every round scales each margin in turn to its target. Categories without tokens cannot be filled: their share goes
    to the others of that margin in proportion. A round that changes no margin by more than ``close`` is the last; margins
    that contradict each other (no table has both) end with the last margin met after ``rounds``.
    """
    if not have.sum():
        return have.astype(np.float64)
    out = have / have.sum()
    axes = range(have.ndim)
    wanted = []
    for k in axes:
        there = have.sum(axis=tuple(a for a in axes if a != k)) > 0
        t = np.where(there, targets[k], 0.0)
        wanted.append(t / t.sum() if t.sum() else there / there.sum())
    for _ in range(rounds):
        worst = 0.0
        for k in axes:
            now = out.sum(axis=tuple(a for a in axes if a != k))
            worst = max(worst, float(np.abs(now - wanted[k]).max()))
            scale = np.divide(wanted[k], now, out=np.zeros_like(now), where=now > 0)
            out = out * scale.reshape([-1 if a == k else 1 for a in axes])
        if worst < close:
            break
    return out


def probabilities(have: np.ndarray, weights: np.ndarray, keep: float) -> np.ndarray:
    """Sampling probability of each cell: in proportion to weights / have, at most 1, so that ``keep`` of all tokens are expected.

    What cells at probability 1 cannot give, the others do, still in proportion.
    """
    ratio = np.divide(weights, have, out=np.zeros(have.shape), where=have > 0)
    budget, full = keep * have.sum(), np.zeros(have.shape, bool)
    while True:
        open_ = ~full & (ratio > 0)
        mass = (have * ratio)[open_].sum()
        if not mass:
            return np.where(full, 1.0, 0.0)
        scale = max(0.0, budget - have[full].sum()) / mass
        over = open_ & (ratio * scale > 1)
        if not over.any():
            return np.where(full, 1.0, ratio * scale)
        full |= over


def mix(docs: DataFrame, targets: dict[str, dict[str, float]] = TARGETS, keep: float = 0.8, seed: int = 11, details: bool = True) -> DataFrame:
    """A sample of ``docs`` whose tokens have the target shares by source, language and topic.

    Tokens (ids of whole texts) of each (source, lang, topic) cell are counted over all rows; names outside the targets, and nulls, count as
    ``other``. Raking gives every cell its weight, calibration its probability, and a row stays if a hash of its doc_id
    (of its text where that is null) lies below it, so repeated rows share their fate and a rerun keeps the same rows.
    ``keep`` is the expected share of tokens. With ``details`` the columns topic, n_tokens, weight and probability are
    added (in place of ones of the same name); without, columns stay as they are. An empty table stays empty.
    Texts go through the tokenizer once: with ``details`` the rows are saved with their counts, without them only the cells
    need counts.

    The cells are at most the product of the numbers of named categories, whatever the data hold; they go through the
    driver, and back as one array in the plan.
    """
    axes = list(targets)
    names = [[*targets[a], *([] if OTHER in targets[a] else [OTHER])] for a in axes]
    shape = [len(n) for n in names]
    topic, tokens, cell = (free_name(docs, n) for n in ("_topic", "_tokens", "_cell"))
    text = text_of()

    def place(axis: str, known: list[str]) -> Column:
        value = F.col(topic) if axis == "topic" else F.col(axis)
        at = F.array_position(F.array(*[F.lit(n) for n in known]), value.cast("string")) - 1
        return F.when(at >= 0, at).otherwise(F.lit(known.index(OTHER)))

    index = F.lit(0)
    for axis, known in zip(axes, names):
        index = index * len(known) + place(axis, known)
    placed = docs.withColumn(topic, topic_of(text)).withColumn(cell, index.cast("int"))
    counted = placed.withColumn(tokens, words_of(text))
    if details:
        placed = counted = saved(counted, "mixing")
    have = np.zeros(int(np.prod(shape)))
    for row in counted.groupBy(cell).agg(F.sum(tokens).alias("n")).collect():
        have[row[cell]] = row.n
    weights = rake(have.reshape(shape), [np.array([targets[a].get(n, 0.0) for n in known]) for a, known in zip(axes, names)])
    chance = probabilities(have, weights.ravel(), keep)
    pick = lambda values: F.element_at(F.lit([float(v) for v in values]), F.col(cell) + 1)
    key = F.coalesce(F.xxhash64("doc_id", F.lit(seed)), F.lit(0)) if "doc_id" in docs.columns else F.xxhash64(text, F.lit(seed))
    if "doc_id" in docs.columns:
        key = F.when(F.col("doc_id").isNull(), F.xxhash64(text, F.lit(seed))).otherwise(key)
    # tokens decide the mix; a blank text has none, so no share to keep, and stays
    stays = ~text.rlike(r"(?U)\S") | (F.pmod(key, F.lit(1 << 30)) / float(1 << 30) < pick(chance))
    out = placed.filter(stays)
    if not details:
        return out.select(*docs.columns)
    added = {"topic": F.col(topic), "n_tokens": F.col(tokens), "weight": pick(weights.ravel()), "probability": pick(chance)}
    return out.select(*[c for c in docs.columns if c.lower() not in added], *[c.alias(k) for k, c in added.items()])
