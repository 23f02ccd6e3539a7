"""Boosted trees by histograms, many models at once.

Columns are cut into bins once and kept as blocks of rows beside the running margins of every model. A tree grows level by
level: one job per level sums the gradients of all models, nodes and bins, combined in each task and shuffled by model;
what comes back is the best split of each node. So a grid of points and folds costs the jobs of its largest model, and a
smaller number of rounds is read off on the way. The blocks are an RDD because a round changes the margins in place of
a new column for each of many models; they are kept between rounds and written to the checkpoint folder every ``CUT``
rounds, so a lost executor costs at most that many. Sums are of whole numbers (gradients times ``UNIT``), so that no order
of rows or tasks changes a split.

A table of up to ``ALONE`` rows is small as codes, its work is not: there the models are dealt over the tasks, each task gets
the codes of all rows and grows its models to the end, with no job in between. A set of columns whose
bins fit ``JOINT`` together is summed in one go, and of two children only the smaller is summed, the other is the parent's rest.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, functions as F, types as T

from ..sources.scratch import checkpoint_dir, cut_lineage
from .features import stratified_folds

#: Bins of a numeric column, kept values of a text column (the commonest; the others share one), rows of a block, and
#: rows that a task has at least (in lots of ``LOT``) and at most, however many cores there are.
BINS, VALUES, BLOCK, TASK, LOT, MANY = 64, 62, 4096, 8, 256, 1 << 18
#: Rounds between checkpoints, and what a gradient of one counts.
CUT, UNIT = 10, float(1 << 20)
#: Rows up to which a task holds all of them, bins of columns summed together, and rows of a node from which that pays.
ALONE, JOINT, FEW = 1 << 21, 2048, 512
#: Second derivative that either side of a split has at least.
LEAST = 1.0
DEFAULTS = {"rounds": 200, "depth": 6, "step": 0.06, "rows": 0.85, "columns": 1.0}


@dataclass(frozen=True)
class Binning:
    """Upper ends of the bins of numeric columns, and the known values of text columns."""

    num: tuple[str, ...]
    cat: tuple[str, ...]
    ends: tuple[tuple[float, ...], ...]
    values: tuple[tuple[str, ...], ...]

    @property
    def width(self) -> int:
        return len(self.num) + len(self.cat)

    def candidates(self) -> list[tuple[int, int]]:
        """What a tree may draw: a numeric column as a whole (-1), or one value of a text column."""
        return [(f, -1) for f in range(len(self.num))] + [(len(self.num) + k, v) for k, known in enumerate(self.values) for v in range(len(known))]

    def codes(self, columns: list[pa.Array]) -> np.ndarray:
        out = np.empty((len(columns[0]) if columns else 0, self.width), np.uint8)
        for f, ends in enumerate(self.ends):
            out[:, f] = np.searchsorted(np.asarray(ends), columns[f].to_numpy(zero_copy_only=False), side="left")
        for k, known in enumerate(self.values):
            at = {v: i for i, v in enumerate(known)}
            out[:, len(self.num) + k] = [at.get(v, len(known)) for v in columns[len(self.num) + k].to_pylist()]
        return out


def binning(df: DataFrame, num: list[str], cat: list[str]) -> Binning:
    """Bins of about equal numbers of rows from one pass; at most ``VALUES`` values of each text column, the commonest."""
    ends: tuple = ()
    if num:
        shares = [k / BINS for k in range(1, BINS)]
        row = df.agg(*[F.percentile_approx(c, shares, 10_000).alias(f"_{i}") for i, c in enumerate(num)]).first()
        ends = tuple(tuple(sorted(set(map(float, q or ())))) for q in row)
    values = tuple(tuple(r[0] for r in df.groupBy(c).count().orderBy(F.desc("count"), c).limit(VALUES).collect()) for c in cat)
    return Binning(tuple(num), tuple(cat), ends, values)


@dataclass(frozen=True)
class Spec:
    """One model: tree depth, step, shares of rows and columns a tree draws, and the fold it does not see (-1: sees all)."""

    depth: int
    step: float
    rows: float
    columns: float
    fold: int = -1

    def seed(self, turn: int) -> int:
        return zlib.crc32(repr((self, turn)).encode())


class _Trees:
    """One tree per model as heaps: column (-1 at a leaf), bin, and value of each node."""

    def __init__(self, models: int, depth: int):
        self.column = np.full((models, 2 ** (depth + 1) - 1), -1, np.int16)
        self.bin = np.zeros(self.column.shape, np.int16)
        self.value = np.zeros(self.column.shape)

    def walk(self, codes: np.ndarray, first_text: int, levels: int) -> np.ndarray:
        """The node that each row (down) reaches in the tree of each model (across)."""
        base = np.arange(len(self.column)) * self.column.shape[1]
        column, cut = self.column.ravel(), self.bin.ravel()
        node = np.zeros((len(codes), len(base)), np.int64)
        flat, rows = codes.ravel(), np.arange(len(codes))[:, None] * codes.shape[1]
        for _ in range(levels):
            at = node + base
            f, b = column.take(at), cut.take(at)
            x = flat.take(rows + np.maximum(f, 0))
            right = np.where(f >= first_text, x == b, x > b)
            node = np.where(f >= 0, 2 * node + 1 + right, node)
        return node


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _draw(key: np.ndarray, turn: int) -> np.ndarray:
    """A number from 0 to 1 for each row and round."""
    return _mixed(key ^ _mixed(np.full(1, turn + 1, np.uint64))).astype(np.float64) / 2.0**64


def _gradients(block: dict, specs: list[Spec], turn: int) -> tuple[np.ndarray, np.ndarray]:
    """Whole-numbered first and second derivatives of the loss, zero for rows that a model's tree does not draw."""
    p = 1 / (1 + np.exp(-block["margin"]))
    draw = _draw(block["key"], turn)
    seen = (draw[:, None] < np.array([s.rows for s in specs])) & (block["fold"][:, None] != np.array([s.fold for s in specs]))
    w = block["weight"][:, None] * seen
    return np.rint(UNIT * w * (p - block["label"][:, None])), np.rint(UNIT * w * p * (1 - p))


def _sums(trees: _Trees, specs: list[Spec], turn: int, level: int, active: list[int], first_text: int):
    """For each model that still grows: sums of both derivatives by node of the level, column and bin."""
    def run(blocks):
        nodes, total = 2**level, None
        for block in blocks:
            codes = block["codes"]
            g, h = (d[:, active] for d in _gradients(block, specs, turn))
            node = trees.walk(codes, first_text, level)[:, active] - (nodes - 1)
            # only rows that a tree draws and that reach the level
            row, model = np.nonzero((node >= 0) & ((g != 0) | (h != 0)))
            g, h = g[row, model], h[row, model]
            place = (model * nodes + node[row, model]) * BINS
            out = np.empty((codes.shape[1], 2, len(active) * nodes * BINS))
            for f in range(codes.shape[1]):
                at = place + codes[row, f]
                out[f, 0] = np.bincount(at, g, out.shape[2])
                out[f, 1] = np.bincount(at, h, out.shape[2])
            total = out if total is None else total + out
        if total is not None:
            shaped = total.reshape(len(total), 2, len(active), nodes, BINS)
            for k, m in enumerate(active):
                yield m, shaped[:, :, k]
    return run


def _allowed(spec: Spec, turn: int, binned: Binning, candidates: list[tuple[int, int]]) -> np.ndarray:
    """The columns and bins that a model's tree may split at."""
    draw = np.random.default_rng(spec.seed(turn)).permutation(len(candidates))[: max(1, round(spec.columns * len(candidates)))]
    allowed = np.zeros((binned.width, BINS), bool)
    for k in draw:
        f, v = candidates[k]
        allowed[f, slice(None) if v < 0 else v] = True
    return allowed


def _split(sums: np.ndarray, allowed: np.ndarray, n_num: int, keep: float = 1.0, least: float = LEAST):
    """The best split of each node: column, bin and sums on both sides; the first of equals, column -1 if none gains."""
    sums = np.moveaxis(sums, 2, 0) / UNIT
    whole = sums[:, 0].sum(axis=-1)
    # left of a numeric cut is up to and with the bin; left of a text value is everything else
    left = np.cumsum(sums, axis=-1)
    left[:, n_num:] = whole[:, None, :, None] - sums[:, n_num:]
    right = whole[:, None, :, None] - left
    score = lambda s: s[:, :, 0] ** 2 / (s[:, :, 1] + keep)
    gain = score(left) + score(right) - (whole[:, 0] ** 2 / (whole[:, 1] + keep))[:, None, None]
    gain = np.where(allowed & (left[:, :, 1] >= least) & (right[:, :, 1] >= least), gain, -1.0).reshape(len(whole), -1)
    at = gain.argmax(axis=1)
    some = gain[np.arange(len(whole)), at] > 1e-9
    f, b = at // BINS, at % BINS
    nodes = np.arange(len(whole))
    return np.where(some, f, -1), b, left[nodes, f, :, b], right[nodes, f, :, b], whole


def _best(specs: list[Spec], turn: int, binned: Binning):
    candidates = binned.candidates()

    def run(item):
        m, sums = item
        return m, *_split(sums, _allowed(specs[m], turn, binned, candidates), len(binned.num))
    return run


def _moved(trees: _Trees, depth: int, first_text: int):
    """Blocks with the values of a round's trees added to the margins."""
    def run(block):
        node = trees.walk(block["codes"], first_text, depth)
        return {**block, "margin": block["margin"] + trees.value[np.arange(len(trees.value)), node]}
    return run


def _blocks(df: DataFrame, binned: Binning, label: str, key: str, weight: str | None, fold: str | None, models: int):
    columns = [*binned.num, *binned.cat]
    plain = df.filter(F.col(label).isNotNull()).select(
        *[F.col(c).cast("double" if c in binned.num else "string").alias(f"_{i}") for i, c in enumerate(columns)], F.col(label).cast("double").alias("label"),
        F.xxhash64(key).alias("key"), (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("weight"), (F.col(fold) if fold else F.lit(-2)).cast("long").alias("fold"))
    names = ["codes", "label", "key", "weight", "fold"]

    def run(source):
        for batch in source:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                rest = [part.column(len(columns) + k).to_numpy(zero_copy_only=False).tobytes() for k in range(4)]
                yield pa.RecordBatch.from_arrays([pa.array([b], pa.binary()) for b in [binned.codes([part.column(i) for i in range(len(columns))]).tobytes(), *rest]], names=names)

    def unpacked(row):
        label = np.frombuffer(row.label)
        return {"codes": np.frombuffer(row.codes, np.uint8).reshape(len(label), binned.width), "label": label, "key": np.frombuffer(row.key, np.int64).view(np.uint64),
                "weight": np.frombuffer(row.weight), "fold": np.frombuffer(row.fold, np.int64), "margin": np.zeros((len(label), models))}
    return plain.mapInArrow(run, ", ".join(f"{n} binary" for n in names)).rdd.map(unpacked)


class _Rows:
    """All rows of some blocks, column by column: first those that the models of a fold see, then the fold's own."""

    def __init__(self, blocks: list[dict], binned: Binning, fold: int):
        empty = {"codes": np.empty((0, binned.width), np.uint8), "label": np.empty(0), "key": np.empty(0, np.uint64), "weight": np.empty(0)}
        parts = [[{n: b[n][(b["fold"] == fold) == own] for n in empty} for b in blocks] or [empty] for own in (False, True)]
        join = lambda name, *of: np.concatenate([p[name] for k in of for p in parts[k]])
        self.codes, self.label = np.ascontiguousarray(join("codes", 0, 1).T), join("label", 0, 1)
        self.key, self.scale = join("key", 0), UNIT * join("weight", 0)
        self.seen = len(self.key)
        sizes = [len(e) + 1 for e in binned.ends] + [len(v) + 1 for v in binned.values]
        sets: list[list[int]] = []
        for f in sorted(range(len(sizes)), key=lambda f: -sizes[f]):
            fits = next((s for s in sets if sizes[f] * np.prod([sizes[k] for k in s]) <= JOINT), None)
            fits.append(f) if fits else sets.append([f])
        self.sets = [(s, [sizes[f] for f in s], np.ravel_multi_index([self.codes[f, : self.seen] for f in s], [sizes[f] for f in s]).astype(np.uint16)) for s in sets]

    def sums(self, g: np.ndarray, h: np.ndarray, rows: np.ndarray | None = None, node: np.ndarray | int = 0, nodes: int = 1) -> np.ndarray:
        """Sums of both derivatives over some of the seen rows (None: all) by node, column and bin."""
        out = np.zeros((nodes, len(self.codes), 2, BINS))
        if rows is not None:
            g, h = g[rows], h[rows]
        if len(g) < FEW * nodes:
            codes = self.codes[:, : self.seen] if rows is None else self.codes[:, rows]
            at = (codes + (node * len(codes) + np.arange(len(codes))[:, None]) * BINS).ravel()
            for k, d in enumerate((g, h)):
                out[:, :, k] = np.bincount(at, np.tile(d, len(codes)), nodes * len(codes) * BINS).reshape(nodes, -1, BINS)
            return out
        for columns, shape, joint in self.sets:
            bins = int(np.prod(shape))
            at = joint.astype(np.intp) if rows is None else node * bins + joint[rows]
            for k, d in enumerate((g, h)):
                table = np.bincount(at, d, nodes * bins).reshape(nodes, *shape)
                for i, f in enumerate(columns):
                    out[:, f, k, : shape[i]] = table.sum(axis=tuple(1 + j for j in range(len(shape)) if j != i))
        return out


def _tree(rows: _Rows, spec: Spec, allowed: np.ndarray, n_num: int, g: np.ndarray, h: np.ndarray, tree: tuple) -> np.ndarray:
    """Grows a tree into ``tree`` (column, bin and value by node); what it adds to each row's margin.

    Rows have the number of their node in its level. At a leaf they go on to the left, so all end at the lowest level.
    """
    columns, bins, values = tree
    n = rows.seen
    at = np.zeros(len(rows.label), np.uint8 if spec.depth <= 8 else np.uint32)
    worth = lambda s: -spec.step * s[0] / (s[1] + 1.0)
    sums, ends = {0: rows.sums(g, h)[0]}, np.zeros(1)
    for depth in range(spec.depth):
        column, cut, left, right, whole = _split(np.stack(list(sums.values()), axis=2), allowed, n_num)
        if depth == 0:
            values[0] = ends[0] = worth(whole[0])
        if (column < 0).all():
            break
        ends, first = np.repeat(ends, 2), 2**depth - 1
        goes, few, below = np.zeros(len(at), bool), np.zeros(n, bool), []
        for i, (node, whole_sums) in enumerate(sums.items()):
            if column[i] < 0:
                continue
            f, b = int(column[i]), int(cut[i])
            columns[first + node], bins[first + node] = f, b
            inside = at == node
            over = rows.codes[f] == b if f >= n_num else rows.codes[f] > b
            over &= inside
            goes |= over
            grows = []
            for k, s in enumerate((left[i], right[i])):
                values[2 * first + 1 + 2 * node + k] = ends[2 * node + k] = worth(s)
                # a node can be split only if both sides can have their least
                if depth + 1 < spec.depth and s[1] >= 2 * LEAST:
                    grows.append(k)
            if grows:
                # mostly the side of fewer rows
                small = int(right[i, 1] < left[i, 1])
                few |= over[:n] if small else np.bitwise_xor(inside[:n], over[:n], out=inside[:n])
                below.append((node, small, grows, whole_sums))
        at += at
        at += goes
        if not below:
            break
        number = np.zeros(2 ** (depth + 1), np.intp)
        number[[2 * node + small for node, small, *_ in below]] = range(len(below))
        picked = np.flatnonzero(few)
        some, sums = rows.sums(g, h, picked, number[at[picked]], len(below)), {}
        for k, (node, small, grows, whole_sums) in enumerate(below):
            sums |= {2 * node + side: some[k] if side == small else whole_sums - some[k] for side in grows}
    return ends[at]


def _whole_models(binned: Binning, specs: list[Spec], dealt: list[list[int]], rounds: int, stages: list[int]):
    """All rounds of the models dealt to a task, from the blocks of all rows: (model, trees by round, counts by stage)."""
    candidates, n_num = binned.candidates(), len(binned.num)
    size = 2 ** (max(s.depth for s in specs) + 1) - 1

    def run(task, source):
        mine = dealt[task] if task < len(dealt) else []
        blocks = [block for _, block in source] if mine else []
        for fold in sorted({specs[m].fold for m in mine}):
            models = [m for m in mine if specs[m].fold == fold]
            rows = _Rows(blocks, binned, fold)
            n, true = rows.seen, rows.label[rows.seen :] == 1
            margins = {m: np.zeros(len(rows.label)) for m in models}
            trees = {m: (np.full((rounds, size), -1, np.int16), np.zeros((rounds, size), np.int16), np.zeros((rounds, size))) for m in models}
            counts: dict[int, list] = {m: [] for m in models}
            for turn in range(rounds):
                draw = _draw(rows.key, turn)
                for m in models:
                    p = 1 / (1 + np.exp(-margins[m][:n]))
                    drawn = draw < specs[m].rows
                    g, h = np.rint(rows.scale * (p - rows.label[:n])) * drawn, np.rint(rows.scale * p * (1 - p)) * drawn
                    margins[m] += _tree(rows, specs[m], _allowed(specs[m], turn, binned, candidates), n_num, g, h, tuple(t[turn] for t in trees[m]))
                    if turn + 1 in stages:
                        said = margins[m][n:] > 0
                        counts[m].append([int((said & true).sum()), int((said & ~true).sum()), int((~said & true).sum())])
            for m in models:
                yield m, trees[m], counts[m]
    return run


def _boost_alone(blocks, binned: Binning, specs: list[Spec], rounds: int, stages: list[int], cores: int):
    """The same as the rounds of ``boost``, by tasks that have all rows and some of the models."""
    # models of a fold share its rows and draws; deep ones and others take turns, so that tasks cost about the same
    order = sorted(range(len(specs)), key=lambda m: (specs[m].fold, specs[m].step, specs[m].rows, specs[m].columns, specs[m].depth))
    dealt = [[int(m) for m in part] for part in np.array_split(order, min(len(specs), 2 * cores))]
    stages = sorted(s for s in set(stages) if 1 <= s <= rounds)
    copies = blocks.flatMap(lambda block: [(k, block) for k in range(len(dealt))]).partitionBy(len(dealt), int)
    depth = max(s.depth for s in specs)
    grown = [_Trees(len(specs), depth) for _ in range(rounds)]
    counts = {s: np.zeros((len(specs), 3), np.int64) for s in stages}
    for m, trees, said in copies.mapPartitionsWithIndex(_whole_models(binned, specs, dealt, rounds, stages)).collect():
        for into, column, cut, value in zip(grown, *trees):
            into.column[m], into.bin[m], into.value[m] = column, cut, value
        for s, three in zip(stages, said):
            counts[s][m] = three
    return grown, counts


def boost(df: DataFrame, binned: Binning, specs: list[Spec], rounds: int, label: str, key: str, weight: str | None = None, fold: str | None = None, stages: list[int] = ()):
    """Trees of all models, one ``_Trees`` a round, and {round: (models, 3)} true, false and missed positives on each model's own fold.

    Logistic loss; leaf values -G / (H + 1), at least a second derivative of 1 on each side of a split. Rows without a
    label are left out. ``key`` decides which rows a tree draws.
    """
    depth, first_text = max(s.depth for s in specs), len(binned.num)
    sc = df.sparkSession.sparkContext
    checkpoint_dir(df.sparkSession)
    # as many tasks as there are cores, if the data fill them: each sends its sums, so more would only shuffle more
    df = df.filter(F.col(label).isNotNull())
    n = df.count()
    tasks = max(1, -(-n // MANY), min(sc.defaultParallelism, -(-n // (TASK * LOT))))
    alone = n <= ALONE
    blocks = _blocks(df.repartition(tasks), binned, label, key, weight, fold, 0 if alone else len(specs))
    if alone:
        return _boost_alone(blocks, binned, specs, rounds, stages, sc.defaultParallelism)
    blocks = blocks.persist(StorageLevel.MEMORY_AND_DISK)
    before = None
    grown: list[_Trees] = []
    counts: dict[int, np.ndarray] = {}

    def positives(block):
        own = block["fold"][:, None] == np.array([s.fold for s in specs])
        said, true = block["margin"] > 0, block["label"][:, None] == 1
        return np.stack([(own & said & true).sum(axis=0), (own & said & ~true).sum(axis=0), (own & ~said & true).sum(axis=0)], axis=1)

    for turn in range(rounds):
        trees = _Trees(len(specs), depth)
        for level in range(depth):
            active = [m for m, s in enumerate(specs) if s.depth > level and (level == 0 or (trees.column[m, 2 ** (level - 1) - 1 : 2**level - 1] >= 0).any())]
            if not active:
                break
            sums = blocks.mapPartitions(_sums(trees, specs, turn, level, active, first_text))
            # one task has nothing to add up
            sums = sums if tasks == 1 else sums.reduceByKey(np.add, min(tasks, len(active)))
            found = sums.map(_best(specs, turn, binned)).collect()
            if level == 0 and before is not None:
                before.unpersist()
                before = None
            for m, column, cut, left, right, whole in found:
                first = 2**level - 1
                value = lambda s: -specs[m].step * s[..., 0] / (s[..., 1] + 1.0)  # noqa: E731, B023
                if level == 0:
                    trees.value[m, 0] = value(whole)[0]
                for i in np.flatnonzero(column >= 0):
                    node = first + i
                    trees.column[m, node], trees.bin[m, node] = column[i], cut[i]
                    trees.value[m, 2 * node + 1], trees.value[m, 2 * node + 2] = value(left[i]), value(right[i])
        grown.append(trees)
        before, blocks = blocks, blocks.map(_moved(trees, depth, first_text)).persist(StorageLevel.MEMORY_AND_DISK)
        if (turn + 1) % CUT == 0:
            blocks.checkpoint()
        if turn + 1 in stages:
            counts[turn + 1] = blocks.map(positives).reduce(np.add)
    for held in (before, blocks):
        if held is not None:
            held.unpersist()
    return grown, counts


@dataclass(frozen=True)
class BoostedModel:
    """Bins and trees of one model."""

    binned: Binning
    trees: tuple
    depth: int

    def probability(self, codes: np.ndarray) -> np.ndarray:
        margin = np.zeros(len(codes))
        for t in self.trees:
            margin += t.value[0, t.walk(codes, len(self.binned.num), self.depth)[:, 0]]
        return 1 / (1 + np.exp(-margin))


def fit_boosted(df: DataFrame, num: list[str], cat: list[str], label: str, key: str, weight: str | None = None, **params) -> BoostedModel:
    """One model; ``params`` as in ``DEFAULTS``. Feature columns without nulls (``models.feature_frame`` makes them)."""
    p = DEFAULTS | params
    binned = binning(df, num, cat)
    trees, _ = boost(df, binned, [Spec(p["depth"], p["step"], p["rows"], p["columns"])], p["rounds"], label, key, weight)
    return BoostedModel(binned, tuple(trees), p["depth"])


def score_boosted(df: DataFrame, model: BoostedModel, threshold: float = 0.5) -> DataFrame:
    """``df`` with pred_label and pred_proba; columns of these names are replaced."""
    keep = [c for c in df.columns if c not in ("pred_label", "pred_proba")]
    columns = [*model.binned.num, *model.binned.cat]
    plain = df.select(*keep, *[F.col(c).cast("double" if c in model.binned.num else "string").alias(f"_boost_{i}") for i, c in enumerate(columns)])

    def run(source):
        for batch in source:
            prob = model.probability(model.binned.codes([batch.column(len(keep) + i) for i in range(len(columns))]))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array((prob >= threshold).astype(np.int32)), pa.array(prob)], names=[*keep, "pred_label", "pred_proba"])
    return plain.mapInArrow(run, T.StructType([*df.select(*keep).schema.fields, T.StructField("pred_label", T.IntegerType()), T.StructField("pred_proba", T.DoubleType())]))


def boosted_grid(df: DataFrame, num: list[str], cat: list[str], label: str, key: str, values: dict[str, list], folds: int = 3, weight: str | None = None) -> DataFrame:
    """(params, score) for every combination of ``values`` (names as in ``DEFAULTS``): mean F1 of the positive class over stratified folds.

    All points and folds are boosted together; points that differ in ``rounds`` alone are one model read off twice.
    """
    names = sorted(values)
    points = [DEFAULTS | dict(zip(names, v)) for v in product(*(values[n] for n in names))]
    spec = lambda p, fold: Spec(p["depth"], p["step"], p["rows"], p["columns"], fold)
    specs = sorted({spec(p, fold) for p in points for fold in range(folds)}, key=repr)
    # read by each column's binning, the count and the blocks
    data = cut_lineage(stratified_folds(df.filter(F.col(label).isNotNull()), label, key, folds).select(*num, *cat, label, key, "fold", *([weight] if weight else [])))
    stages = sorted({p["rounds"] for p in points})
    _, counts = boost(data, binning(data, num, cat), specs, stages[-1], label, key, weight, "fold", stages)
    at = {s: m for m, s in enumerate(specs)}
    rows = []
    for p in points:
        mine = np.array([counts[p["rounds"]][at[spec(p, fold)]] for fold in range(folds)], np.float64)
        both = 2 * mine[:, 0] + mine[:, 1] + mine[:, 2]
        f1 = np.divide(2 * mine[:, 0], both, out=np.zeros(folds), where=both > 0)
        rows.append((", ".join(f"{n}={p[n]}" for n in names), float(f1.mean())))
    return df.sparkSession.createDataFrame(rows, "params string, score double")
