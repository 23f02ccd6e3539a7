"""MinHash near-duplicates through an inverted join on signature coordinates.

A document is posted under (coordinate, value) pairs of its signature. Two documents that agree in at least ``matches``
of ``coords`` coordinates share one of their ``coords - matches + 1`` first pairs in any common order of the pairs
(prefix filter), so only those are posted, rare pairs first: what many documents have in common is skipped and merely
counted when the signatures of a candidate pair are compared. Pairs that agree often enough are confirmed on their
full shingle sets.

Groups of copies never become all their pairs. Equal sets are one class from the start, and classes are what is posted,
compared and linked; rows meet their class at the end. A class with posting lists longer than ``SMALL`` first meets at
most ``DRAWS`` hubs, drawn from its long lists; what they link becomes one component. After that, members
of different components are compared tile by tile: signatures first, then the sets of those that have a partner there,
and only links that join components leave the tile. A pair is looked at in one list only, that of the first coordinate
which both have among their posted ones.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import batches, free_name, mix64, record, saved, spans_take, text_of, worker_state
from .components import components
from .shingles import shingle_sets

#: A list of at most so many classes is compared at once; longer ones have so many hubs, and a class with longer ones
#: meets the hubs of so many draws from its lists first.
SMALL, HUBS, DRAWS = 16, 6, 24
#: Members of a long list that one side of a tile holds, counters of the sketch of how common a pair is, and slots of
#: documents.
TILE, SLOTS = 1024, 1 << 20

SIGNED = pa.schema([("doc_id", pa.int64()), ("said", pa.int64()), ("n_shingles", pa.int64()), ("c1", pa.int64()), ("c2", pa.int64()), ("sig", pa.binary())])
PAIR = pa.schema([("a", pa.int64()), ("b", pa.int64())])
SETS = pa.schema([("doc_id", pa.int64()), ("c1", pa.int64()), ("c2", pa.int64()), ("shingles", pa.binary())])


def _signed64(x) -> np.ndarray:
    return np.asarray(x, np.uint64).view(np.int64)


def _texts(column) -> list[bytes]:
    return [t.encode("utf-8", "surrogatepass") for t in column.to_pylist()]


def _identity(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a set: two sums of mixed members."""
    x = mix64(shingles + np.uint64(0x632BE59BD9B4E019))
    return int(x.sum()), int(mix64(x ^ np.uint64(0x2545F4914F6CDD1D)).sum())


def _signature(shingles: np.ndarray, factors: np.ndarray, step: int = 4096) -> bytes:
    """The smallest value of each of the multiplicative hashes over the set, as 32-bit numbers."""
    low = np.full(len(factors), np.iinfo(np.uint64).max)
    for at in range(0, len(shingles), step):
        np.minimum(low, (shingles[None, at : at + step] * factors[:, None]).min(axis=1), out=low)
    return (low >> np.uint64(32)).astype("<u4").tobytes()


def _sign(width: int, coords: int):
    factors = mix64(np.arange(1, coords + 1, dtype=np.uint64)) | np.uint64(1)

    def run(source):
        state = worker_state("words", dict)
        for batch in batches(source, 1 << 20):
            sets = shingle_sets(_texts(batch.column(2)), width, state)
            ids = [_identity(s) for s in sets]
            yield record(SIGNED, batch.column(0), batch.column(1), [len(s) for s in sets], _signed64([i[0] % 2**64 for i in ids]), _signed64([i[1] % 2**64 for i in ids]),
                         [_signature(s, factors) for s in sets])
    return run


def signatures(docs: DataFrame, width: int, coords: int) -> DataFrame:
    """doc_id, a hash of the text, n_shingles, 128 bits that name the set, and the signature of each document."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_of()).alias("said"), text_of().alias("text")).mapInArrow(
        _sign(width, coords), "doc_id long, said long, n_shingles long, c1 long, c2 long, sig binary")


def _matrix(column) -> np.ndarray:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), "<u4").reshape(len(rows), -1) if rows else np.zeros((0, 1), "<u4")


def _pair_keys(sig: np.ndarray) -> np.ndarray:
    """One 64-bit key for each (coordinate, value)."""
    return mix64(sig.astype(np.uint64) + (np.arange(sig.shape[1], dtype=np.uint64) << np.uint64(32)))


def _slots(keys: np.ndarray) -> np.ndarray:
    return (keys % np.uint64(SLOTS)).astype(np.int64)


def _posted(keys: np.ndarray, weight: np.ndarray, prefix: int) -> np.ndarray:
    """The coordinates under which each document is posted: the rarest pairs, ties by key."""
    return np.lexsort((keys, weight[_slots(keys)]), axis=1)[:, :prefix]


def _tally(source):
    seen = np.zeros(SLOTS, np.int64)
    for batch in source:
        np.add.at(seen, _slots(_pair_keys(_matrix(batch.column(0)))).ravel(), 1)
    # once in a task says nothing about how common a pair is
    hot = np.flatnonzero(seen > 1)
    yield pa.RecordBatch.from_arrays([pa.array(hot), pa.array(seen[hot])], names=["slot", "n"])


def _prefixes(common: np.ndarray, slots: np.ndarray, prefix: int):
    schema = pa.schema([("key", pa.int64()), ("doc", pa.int64())])

    def run(source):
        weight = np.zeros(SLOTS, np.int64)
        weight[slots] = common
        for batch in source:
            keys = _pair_keys(_matrix(batch.column(1)))
            if not len(keys):
                continue
            order = _posted(keys, weight, prefix)
            yield record(schema, _signed64(np.take_along_axis(keys, order, 1).ravel()), np.repeat(batch.column(0).to_numpy(), prefix))
    return run


def _agree(matches: int):
    def run(source):
        for batch in source:
            same = (_matrix(batch.column(2)) == _matrix(batch.column(3))).sum(axis=1) >= matches
            yield batch.select([0, 1]).filter(pa.array(same))
    return run


def _shingled(width: int):
    def run(source):
        state = worker_state("words", dict)
        for batch in batches(source, 1 << 20):
            sets = shingle_sets(_texts(batch.column(1)), width, state)
            ids = [_identity(s) for s in sets]
            yield record(SETS, batch.column(0), _signed64([i[0] % 2**64 for i in ids]), _signed64([i[1] % 2**64 for i in ids]), [s.astype("<u8").tobytes() for s in sets])
    return run


def _confirm(percent: int):
    def run(source):
        for batch in source:
            keep = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                x, y = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))
    return run


TILED = pa.schema([("key", pa.int64()), ("i", pa.int32()), ("j", pa.int32()), ("doc", pa.int64())])


def _partners(table: pa.Table, common: np.ndarray, slots: np.ndarray, prefix: int, matches: int, percent: int):
    """For each document on one side of a tile: those on the other that it may be linked with and that no other list has first."""
    comp, part, size = (table.column(c).to_numpy() for c in ("comp", "part", "n"))
    sig = _matrix(table.column("sig"))
    keys = _pair_keys(sig)
    weight = np.zeros(SLOTS, np.int64)
    weight[slots] = common
    posted = np.zeros(sig.shape, bool)
    np.put_along_axis(posted, _posted(keys, weight, prefix), True, 1)
    here = int(np.flatnonzero(_signed64(keys[0]) == table.column("key")[0].as_py())[0])
    i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
    right = np.flatnonzero(part == j)
    for x in np.flatnonzero(part == i):
        y = right[right > x] if i == j else right
        y = y[(comp[y] != comp[x]) & (100 * np.minimum(size[y], size[x]) >= percent * np.maximum(size[y], size[x]))]
        same = sig[y] == sig[x]
        fits = same.sum(axis=1) >= matches
        y, same = y[fits], same[fits]
        if len(y):
            y = y[(same & posted[y] & posted[x]).argmax(axis=1) == here]
        if len(y):
            yield int(x), y


def _wanted(*how):
    """The documents of a tile that have a partner in it."""
    def run(table: pa.Table) -> pa.Table:
        found = np.zeros(table.num_rows, bool)
        for x, y in _partners(table, *how):
            found[x] = True
            found[y] = True
        return table.select(TILED.names).filter(pa.array(found))
    return run


def _resolve(*how):
    """Links between components within a tile, confirmed on full sets; once two are joined no more between them."""
    percent = how[-1]

    def run(table: pa.Table) -> pa.Table:
        doc, comp = table.column("doc").to_numpy(), table.column("comp").to_numpy().copy()
        sets = [np.frombuffer(s, "<u8") for s in table.column("shingles").to_pylist()]
        size = np.array([len(s) for s in sets])
        first = np.concatenate(([0], np.cumsum(size)))
        values, ids = np.unique(np.concatenate(sets), return_inverse=True)
        a, b, mark = [], [], np.zeros(len(values), np.int64)
        for x, y in _partners(table, *how):
            y = y[comp[y] != comp[x]]
            if not len(y):
                continue
            mark[:] = 0
            mark[ids[first[x] : first[x + 1]]] = 1
            places = spans_take(first[y], size[y])
            both = np.add.reduceat(mark[ids[places]], np.concatenate(([0], np.cumsum(size[y])[:-1])))
            for k in y[100 * both >= percent * (size[x] + size[y] - both)]:
                if comp[k] != comp[x]:
                    a.append(doc[x])
                    b.append(doc[k])
                    comp[comp == comp[k]] = comp[x]
        return pa.table([pa.array(a, pa.int64()), pa.array(b, pa.int64())], schema=PAIR)
    return run


def _sets_of(texts: DataFrame, wanted: DataFrame, reps: DataFrame, width: int) -> DataFrame:
    """doc and the full set of each wanted class (doc), from the text of its first document.

    Texts stay where they are read: only those whose doc_id falls into a slot with a wanted one are cut into shingles.
    The slots are at most ``SLOTS`` numbers, however many classes are wanted.
    """
    slot = lambda c: F.pmod(F.xxhash64(c), F.lit(SLOTS)).alias("slot")
    names = reps.select("doc", "doc_id", "c1", "c2").join(wanted, "doc", "left_semi")
    some = texts.select("doc_id", "text", slot("doc_id")).join(F.broadcast(names.select(slot("doc_id")).distinct()), "slot", "left_semi")
    sets = some.select("doc_id", "text").mapInArrow(_shingled(width), "doc_id long, c1 long, c2 long, shingles binary")
    # rows that repeat a doc_id with the same set
    return sets.join(names, ["doc_id", "c1", "c2"]).groupBy("doc").agg(F.min("shingles").alias("shingles"))


def _linked(pairs: DataFrame, reps: DataFrame, texts: DataFrame, width: int, matches: int, percent: int) -> DataFrame:
    """Those of the candidate pairs that reach the similarity on their full sets."""
    side = lambda k: reps.select(F.col("doc").alias(k), F.col("n").alias(f"n{k}"), F.col("sig").alias(f"s{k}"))
    # a pair of sets whose sizes differ too much cannot reach it
    fits = pairs.distinct().join(side("a"), "a").join(side("b"), "b").filter(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
    near = saved(fits.select("a", "b", "sa", "sb").mapInArrow(_agree(matches), "a long, b long"), "near")
    wanted = near.select(F.col("a").alias("doc")).union(near.select(F.col("b").alias("doc"))).distinct()
    sets = _sets_of(texts, wanted, reps, width)
    of = lambda k: sets.select(F.col("doc").alias(k), F.col("shingles").alias(f"s{k}"))
    return saved(near.join(of("a"), "a").join(of("b"), "b").select("a", "b", "sa", "sb").mapInArrow(_confirm(percent), "a long, b long"), "links")


def grouped(docs: DataFrame, width: int = 5, percent: int = 80, coords: int = 48, matches: int = 28) -> DataFrame:
    """doc_id, said (a hash of the text), n_shingles, c1 and c2 (which name the set), component_id and first for each row.

    component_id is the smallest doc_id of the row's group; first, whether the row's set is the one of the group that has it.
    """
    prefix = coords - matches + 1
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    rows = saved(signatures(docs, width, coords), "signatures")
    sets = rows.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    # a class is a number that is written once
    reps = saved(sets.groupBy("c1", "c2").agg(F.min(F.struct("doc_id", "n_shingles", "sig")).alias("r"))
                 .select(F.monotonically_increasing_id().alias("doc"), "c1", "c2", F.col("r.doc_id").alias("doc_id"), F.col("r.n_shingles").alias("n"), F.col("r.sig").alias("sig")), "classes")
    # at most SLOTS rows, however large the input is
    tally = reps.select("sig").mapInArrow(_tally, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).filter("n > 8").toArrow()
    posts = saved(reps.select("doc", "sig").mapInArrow(
        _prefixes(tally.column("n").to_numpy(), tally.column("slot").to_numpy(), prefix), "key long, doc long"), "postings")
    lists = posts.groupBy("key").agg(F.count("*").alias("size"), *[
        F.min(F.struct(F.xxhash64("doc", F.lit(k)).alias("h"), F.col("doc").alias("d"))).alias(f"hub{k}") for k in range(HUBS)]).filter("size > 1")
    short = (
        posts.join(lists.filter(F.col("size") <= SMALL).select("key"), "key").groupBy("key").agg(F.sort_array(F.collect_set("doc")).alias("d"))
        .select(F.posexplode("d").alias("p", "a"), "d").select("a", F.explode(F.expr("slice(d, p + 2, size(d))")).alias("b"))
    )
    long = saved(posts.join(lists.filter(F.col("size") > SMALL), "key").select("key", "doc", *[F.col(f"hub{k}.d").alias(f"hub{k}") for k in range(HUBS)]), "long")
    # a draw takes a hub of the list whose key comes first in its own order, so copies draw alike
    drawn = long.groupBy("doc").agg(*[F.min(F.struct(F.xxhash64("key", F.lit(k)).alias("o"), F.col(f"hub{k % HUBS}").alias("d"))).alias(f"draw{k}") for k in range(DRAWS)])
    star = drawn.select("doc", F.explode(F.array_distinct(F.array(*[f"draw{k}.d" for k in range(DRAWS)]))).alias("hub")).filter("doc != hub").select(
        F.least("doc", "hub").alias("a"), F.greatest("doc", "hub").alias("b"))
    links = _linked(short.union(star), reps, texts, width, matches, percent)
    first = components(links)
    # what is still apart in a long list
    members = long.select("key", "doc").join(first.withColumnRenamed("node", "doc"), "doc", "left").select("key", "doc", F.coalesce("component", "doc").alias("comp"))
    apart = members.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("size")).filter("lo != hi")
    apart = apart.select("key", F.ceil(F.col("size") / TILE).cast("int").alias("g"))
    tiled = (
        members.join(apart, "key").withColumn("part", F.pmod(F.xxhash64("doc"), "g").cast("int"))
        .withColumn("o", F.explode(F.expr("sequence(0, g - 1)")))
        .select("key", "doc", "comp", "part", F.least("part", "o").alias("i"), F.greatest("part", "o").alias("j"))
    )
    how = tally.column("n").to_numpy(), tally.column("slot").to_numpy(), prefix, matches, percent
    facts = reps.select("doc", "n", "sig")
    wanted = saved(tiled.join(facts, "doc").groupBy("key", "i", "j").applyInArrow(_wanted(*how), "key long, i int, j int, doc long"), "wanted")
    whole = _sets_of(texts, wanted.select("doc").distinct(), reps, width)
    more = saved(tiled.join(wanted, ["key", "i", "j", "doc"], "left_semi").join(facts, "doc").join(whole, "doc")
                 .groupBy("key", "i", "j").applyInArrow(_resolve(*how), "a long, b long"), "more")
    found = components(links.union(more)).withColumnRenamed("node", "doc")
    classes = reps.select("doc", "c1", "c2", "doc_id").join(found, "doc", "left").select("doc", "c1", "c2", "doc_id", F.coalesce("component", "doc").alias("component"))
    lowest = classes.groupBy("component").agg(F.min(F.struct("doc_id", "doc")).alias("low"))
    named = saved(classes.join(lowest, "component").select("c1", "c2", F.col("low.doc_id").alias("component_id"), (F.col("low.doc") == F.col("doc")).alias("first")), "named")
    return rows.drop("sig").join(named, ["c1", "c2"], "left").select("doc_id", "said", "n_shingles", "c1", "c2", "component_id", "first")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, coords: int = 48, matches: int = 28) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for each row of ``docs`` (doc_id, text; other columns are not read).

    Documents are linked if 100 * intersection >= ``percent`` * union of their sets of distinct ``width``-word shingles
    (words: runs without space and 9 to 13, A-Z in lower case). component_id is the smallest doc_id that links reach,
    kept whether that is the document itself. A document shorter than a shingle has its whole word sequence as its one
    shingle; null and empty texts have an empty set and link with nothing. Rows that repeat a doc_id are rows of their
    own: their texts are linked or not like those of any two documents. Rows without a doc_id come back with a null
    component and kept = true; they and an empty table link nothing. A very long text is one set of 8 bytes a shingle.
    At the threshold itself, a pair of different sets agrees in fewer than ``matches`` of ``coords`` coordinates about
    once in ten thousand times; equal sets always meet.
    """
    out = grouped(docs, width, percent, coords, matches)
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates, the one with the smallest doc_id; columns stay.

    Rows decide for themselves: of two unlike texts under one doc_id both stay if each is the first of its group. Of rows
    with the same doc_id and set, one stays; of those without a set (null and empty texts) all different texts. Rows
    without a doc_id all stay.
    """
    said, kept, rows = (free_name(docs, c) for c in ("_said", "_kept", "_rows"))
    groups = grouped(docs, **options).filter("doc_id IS NOT NULL")
    # of one doc_id and set, the text with the smallest hash
    lowest = groups.groupBy("doc_id", "c1", "c2").agg(
        F.min("said").alias(said), F.first("component_id").alias("component_id"), F.first("first").alias("first"), F.max("n_shingles").alias("n"))
    own = lowest.filter("n > 0").select("doc_id", said, ((F.col("component_id") == F.col("doc_id")) & F.col("first")).alias(kept))
    bare = groups.filter("n_shingles = 0").select("doc_id", F.col("said").alias(said), F.lit(True).alias(kept)).distinct()
    stays = own.filter(kept).union(bare)
    often = groups.groupBy("doc_id", F.col("said").alias(said)).agg(F.count("*").alias(rows))
    marked = docs.withColumn(said, F.xxhash64(text_of())).join(stays.join(often, ["doc_id", said]), ["doc_id", said], "left")
    out = marked.filter(F.col(kept) | F.col("doc_id").isNull())
    once, again = out.filter(F.coalesce(F.col(rows), F.lit(1)) == 1), out.filter(F.col(rows) > 1).dropDuplicates(["doc_id", said])
    return once.unionByName(again).select(*docs.columns)
