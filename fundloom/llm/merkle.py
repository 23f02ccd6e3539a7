"""Merkle manifest of a data set: leaf hashes, a tree per group, a tree over the groups, and proofs for all rows at once.

Leaves are put in order by ranges, so a group of any size spreads over as many tasks as it needs; each range hands on
where its last group stopped, one row per range. Every level of all trees is one aggregate over runs of ``FANOUT`` nodes.

Proofs come as octopus multiproofs. A block of consecutive leaves needs only the nodes beside its two ends: everything
else on the ways from its leaves to the root it derives itself. Each block names the few coordinates it lacks, fetches
them with one join, derives the inner nodes that its leaves share once, and expands the proof of each leaf from them.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from ..session import shuffle_width
from .common import record, saved

#: So many consecutive nodes become one; and so many consecutive leaves share one multiproof.
FANOUT, BLOCK = 16, 4096
#: The tree over the roots of the groups.
TOP = -1

PLACED = pa.schema([("part", pa.int64()), ("pos", pa.int64()), ("ord", pa.int64()), ("seen", pa.int64()), ("grp", pa.string()), ("key", pa.int64()),
                    ("leaf", pa.string()), ("claimed", pa.string())])
PROVED = pa.schema([("key", pa.int64()), ("leaf", pa.string()), ("subroot", pa.string()), ("root", pa.string()), ("proof_sha256", pa.string()),
                    ("folded_root", pa.string()), ("siblings", pa.list_(pa.string()))])


def leaf_hash(columns: dict[str, Column] | list[str]) -> Column:
    """The hash of a row: each value as its UTF-8 length, a colon and itself, ``-`` where it is null."""
    values = [F.col(c) for c in columns] if isinstance(columns, list) else list(columns.values())
    said = [F.coalesce(F.concat(F.octet_length(v.cast("string")).cast("string"), F.lit(":"), v.cast("string")), F.lit("-")) for v in values]
    return F.sha2(F.concat(*said), 256)


def _place(source):
    """Numbers rows within their range, groups within it, and rows within a group."""
    part, pos, group, order, seen = TaskContext.get().partitionId(), 0, None, -1, 0
    for batch in source:
        out = []
        for row in zip(*(batch.column(i).to_pylist() for i in range(4))):
            if order < 0 or row[0] != group:
                group, order, seen = row[0], order + 1, 0
            out.append((part, pos, order, seen, *row))
            pos, seen = pos + 1, seen + 1
        if out:
            yield record(PLACED, *zip(*out))


def placed(leaves: DataFrame) -> DataFrame:
    """at (place among all leaves), tree (number of the group in order), idx (place within it), key, leaf and claimed.

    ``leaves`` has grp, key, leaf and claimed. Groups are in order of their UTF-8 bytes, null first; leaves within a
    group by key, null first, ties by hash. Rows that are equal in everything may take any of their places.
    """
    flat = saved(leaves.select("grp", "key", "leaf", "claimed"), "leaves")
    order = ["grp", "key", "leaf", "claimed", "salt"]
    ranged = flat.withColumn("salt", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1024))).repartitionByRange(
        shuffle_width(leaves.sparkSession), *order).sortWithinPartitions(*order)
    rows = saved(ranged.select("grp", "key", "leaf", "claimed").mapInArrow(
        _place, "part long, pos long, ord long, seen long, grp string, key long, leaf string, claimed string"), "placed")
    # one row per range
    edges = rows.groupBy("part").agg(
        F.min(F.struct("pos", "grp")).alias("head"), F.max(F.struct("pos", "grp", "ord", "seen")).alias("tail")).orderBy("part").collect()
    known, at, tree, last, total = [], 0, -1, None, 0
    for e in edges:
        goes_on = tree >= 0 and e.head.grp == last
        known.append((e.part, at, tree if goes_on else tree + 1, total if goes_on else 0))
        total = e.tail.seen + 1 + (known[-1][3] if e.tail.ord == 0 else 0)
        at, tree, last = at + e.tail.pos + 1, known[-1][2] + e.tail.ord, e.tail.grp
    starts = leaves.sparkSession.createDataFrame(known, "part long, at0 long, tree0 long, idx0 long")
    return rows.join(F.broadcast(starts), "part").select(
        (F.col("at0") + F.col("pos")).alias("at"), (F.col("tree0") + F.col("ord")).alias("tree"),
        (F.col("seen") + F.when(F.col("ord") == 0, F.col("idx0")).otherwise(0)).alias("idx"), "key", "leaf", "claimed")


def climbed(nodes: DataFrame, name: str) -> tuple[list[DataFrame], DataFrame]:
    """The levels of all trees over ``nodes`` (tree, idx, hash), these included, and the root (tree, hash) of each tree.

    While a tree has more than one node, each run of consecutive ones becomes their hash, also a run of a single node
    at the end. A group of the aggregate is one run, so no tree is ever in one task.
    """
    levels, tops = [nodes], None
    while True:
        runs = levels[-1].groupBy("tree", F.expr(f"idx div {FANOUT}").alias("run")).agg(F.sort_array(F.collect_list(F.struct("idx", "hash"))).alias("kids"))
        more = (F.size("kids") > 1) | (F.col("run") > 0)
        up = saved(runs.select("tree", F.col("run").alias("idx"), more.alias("more"), F.when(more, F.sha2(F.concat_ws("", "kids.hash"), 256)).otherwise(
            F.col("kids")[0]["hash"]).alias("hash")), name)
        done = up.filter("NOT more").select("tree", "hash")
        tops = done if tops is None else tops.union(done)
        if up.filter("more").isEmpty():
            return levels, tops
        levels.append(up.filter("more").select("tree", "idx", "hash"))


def _missing(ends: DataFrame, tree: str, first: Column, last: Column, height: int) -> DataFrame:
    """Coordinates beside the ends of an interval of leaves, level by level; ``first`` or ``last`` null: that end is the tree's."""
    run = F.lit(FANOUT).cast("long")
    level = ends.select("block", F.col(tree).alias("tree"), first.alias("lo"), last.alias("hi"), F.explode(F.sequence(F.lit(0), F.lit(height - 1))).alias("level"))
    shift = F.pow(run.cast("double"), F.col("level")).cast("long")
    level = level.select("block", "tree", "level", F.floor(F.col("lo") / shift).alias("a"), F.floor(F.col("hi") / shift).alias("b"))
    none = F.array().cast("array<bigint>")
    left = F.when(F.col("a") % run > 0, F.sequence(F.col("a") - F.col("a") % run, F.col("a") - 1))
    right = F.when(F.col("b") % run < run - 1, F.sequence(F.col("b") + 1, F.col("b") - F.col("b") % run + run - 1))
    return level.select("block", "tree", "level", F.explode(F.concat(F.coalesce(left, none), F.coalesce(right, none))).alias("idx"))


class _Multiproof:
    """What a block knows: its own leaves, the nodes it fetched, and what follows from both."""

    def __init__(self, leaves, fetched):
        self.kids, self.above, self.folded = {}, {}, {}
        nodes = {}
        for tree, level, idx, value in fetched:
            nodes.setdefault((tree, level), {})[idx] = value
        own = {}
        for tree, idx, value in leaves:
            own.setdefault(tree, {})[idx] = value
        self.root_of = {t: self._derive(t, mine, nodes) for t, mine in own.items()}
        self.root = self._derive(TOP, dict(self.root_of), nodes)

    def _derive(self, tree: int, mine: dict, nodes: dict) -> str:
        level = 0
        while True:
            every = {**nodes.get((tree, level), {}), **mine}
            up = {}
            for run in sorted({i // FANOUT for i in mine}):
                kids = [(i, every[i]) for i in range(run * FANOUT, (run + 1) * FANOUT) if i in every]
                if run == 0 and len(kids) == 1:
                    return kids[0][1]
                self.kids[tree, level, run] = kids
                up[run] = _hash("".join(v for _, v in kids))
            mine, level = up, level + 1

    def siblings(self, tree: int, level: int, idx: int) -> list[str]:
        """Level by level, first in the tree and then in the one over the groups; one entry a level."""
        run = idx // FANOUT
        kids = self.kids.get((tree, level, run))
        if kids is None:
            return [] if tree == TOP else self._shared(TOP, 0, tree)
        return ["".join(v for i, v in kids if i != idx), *self._shared(tree, level + 1, run)]

    def _shared(self, tree: int, level: int, idx: int) -> list[str]:
        key = tree, level, idx
        if key not in self.above:
            self.above[key] = self.siblings(*key)
        return self.above[key]

    def fold(self, tree: int, level: int, idx: int, value: str) -> str:
        """The root that follows if this node had this value and all its siblings stayed."""
        run = idx // FANOUT
        kids = self.kids.get((tree, level, run))
        if kids is None:
            return value if tree == TOP else self._fold(TOP, 0, tree, value)
        return self._fold(tree, level + 1, run, _hash("".join(value if i == idx else v for i, v in kids)))

    def _fold(self, *node) -> str:
        if node not in self.folded:
            self.folded[node] = self.fold(*node)
        return self.folded[node]


def _hash(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _expand(with_siblings: bool):
    def run(rows: pa.Table, fetched: pa.Table) -> pa.Table:
        tree, idx, key, leaf, claimed = (rows.column(c).to_pylist() for c in ("tree", "idx", "key", "leaf", "claimed"))
        known = _Multiproof(zip(tree, idx, leaf), zip(*(fetched.column(c).to_pylist() for c in ("tree", "level", "idx", "hash"))))
        proofs = [known.siblings(t, 0, i) for t, i in zip(tree, idx)]
        columns = [key, leaf, [known.root_of[t] for t in tree], [known.root] * len(key), [_hash("".join(p)) for p in proofs],
                   [known.fold(t, 0, i, c) for t, i, c in zip(tree, idx, claimed)], proofs if with_siblings else [None] * len(key)]
        return pa.table([pa.array(c, t.type) for c, t in zip(columns, PROVED)], schema=PROVED)
    return run


def prove(rows: DataFrame, leaf: Column, claimed: Column | None = None, group: str = "source", order: str = "doc_id", with_siblings: bool = False,
          block: int = BLOCK) -> DataFrame:
    """For each row its leaf, the root of its group, the root of all, the hash of its proof, and what the proof folds to.

    ``leaf`` is the recorded hash of a row, ``claimed`` the hash of what it says now (the same if not given): the proof is
    made of recorded hashes only, so ``verified`` tells whether the row still is what was recorded. Columns: the order
    column, leaf, subroot, root, proof_sha256, folded_root, verified, and with ``with_siblings`` the proof itself, one
    string of concatenated hashes per level.

    Null groups are a group of their own, the first; null keys come first in their group; ties are in order of their
    hashes, and rows that repeat are leaves of their own. Null and empty texts have different leaves. A group of one row
    is its own root. A very long text is hashed where it is read, and only its hash moves. An empty table gives no rows.
    Other columns are not read; their names may be anything.
    """
    named = rows.select(F.col(group).cast("string").alias("grp"), F.col(order).cast("long").alias("key"), leaf.alias("leaf"), (leaf if claimed is None else claimed).alias("claimed"))
    leaves = saved(placed(named).withColumn("block", F.expr(f"at div {block}")), "blocks")
    levels, subroots = climbed(leaves.select("tree", "idx", F.col("leaf").alias("hash")), "nodes")
    over, _ = climbed(subroots.select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("idx"), "hash"), "over")
    ends = leaves.groupBy("block").agg(F.min(F.struct("tree", "idx")).alias("f"), F.max(F.struct("tree", "idx")).alias("l")).select(
        "block", F.lit(TOP).cast("long").alias("top"), F.col("f.tree").alias("t0"), F.col("f.idx").alias("i0"), F.col("l.tree").alias("t1"), F.col("l.idx").alias("i1"))
    never = F.lit(None).cast("long")
    lacks = (
        _missing(ends, "t0", F.col("i0"), F.when(F.col("t0") == F.col("t1"), F.col("i1")), len(levels))
        .union(_missing(ends.filter("t0 != t1"), "t1", never, F.col("i1"), len(levels)))
        .union(_missing(ends, "top", F.col("t0"), F.col("t1"), len(over)))
    )
    nodes = None
    for level, frame in [*enumerate(levels), *enumerate(over)]:
        frame = frame.select("tree", F.lit(level).alias("level"), "idx", "hash")
        nodes = frame if nodes is None else nodes.union(frame)
    fetched = saved(lacks.join(nodes, ["tree", "level", "idx"]).select("block", "tree", "level", "idx", "hash"), "fetched")
    out = leaves.select("block", "tree", "idx", "key", "leaf", "claimed").groupBy("block").cogroup(fetched.groupBy("block")).applyInArrow(
        _expand(with_siblings), "key long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, siblings array<string>")
    return out.select(F.col("key").alias(order), "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
                      *(["siblings"] if with_siblings else []))


def document_leaf(text: Column | None = None) -> Column:
    """The leaf of a row of ``documents``, or of the row with another text."""
    return leaf_hash({c: F.col(c) for c in ("doc_id", "source", "lang", "n_chars")} | {"text": F.col("text") if text is None else text})
