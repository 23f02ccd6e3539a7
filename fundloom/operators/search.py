"""Text and vector search: TF-IDF over blocks of documents, cosine top-k over blocks of vectors."""

from __future__ import annotations

from math import ceil
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..functions.text import terms, with_bigrams
from ..sources.scratch import cut_lineage
from .topk import topk


def english_stop_words() -> list[str]:
    """Spark's own English list; pass another list to match another tokenizer."""
    return StopWordsRemover.loadDefaultStopWords("english")


def term_counts(docs: DataFrame, key: str, text_col: str, bigrams: bool = True, stop_words: list[str] | None = None) -> DataFrame:
    # moving each text once is cheaper than moving its terms; the counts below then need no shuffle of their own
    docs = docs.select(key, text_col).repartition(key)
    words = terms(text_col)
    if stop_words:
        stops = F.array(*[F.lit(w) for w in stop_words])
        words = F.filter(words, lambda w: ~F.array_contains(stops, w))
    if bigrams:
        # inside a lambda the word list is a bound variable: the text is split once, not once per mention
        words = F.transform(F.array(words), with_bigrams)[0]
    return docs.select(key, F.explode(words).alias("term")).groupBy(key, "term").agg(F.count("*").alias("tf"))


def inverse_document_frequency(counts: DataFrame, key: str, n_docs, min_df: int = 1, max_features: int | None = None) -> DataFrame:
    """(term, df, idf) with idf = ln((1 + n) / (1 + df)) + 1, over the kept vocabulary."""
    per = counts.groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("ctf")).filter(F.col("df") >= min_df)
    if max_features:
        per = per.orderBy(F.desc("ctf"), "term").limit(max_features)
    return per.select("term", "df", (F.ln((1 + n_docs) / (1 + F.col("df"))) + 1).alias("idf"))


def _unit(weights: DataFrame, key: str) -> DataFrame:
    size = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy(key)))
    return weights.select(key, "term", (F.col("raw") / size).alias("weight"))


# ---- terms of blocks of documents ----------------------------------------------------------

#: Characters of text in a block, and documents in a row of its postings.
BLOCK_CHARS, SLICE = 1 << 23, 512


def _n_blocks(docs: DataFrame, text_col: str, most: int | None = None) -> tuple[int, int]:
    """(rows, blocks of so many characters, and of ``most`` rows)."""
    n, chars = docs.agg(F.count("*"), F.coalesce(F.sum(F.length(text_col)), F.lit(0))).first()
    return n, max(1, ceil(chars / BLOCK_CHARS), ceil(n / most) if most else 1)


def _in_blocks(docs: DataFrame, key: str, text_col: str, n: int, stop_words: list[str] | None) -> DataFrame:
    """(block, key, words): texts move once, and their words are taken where they arrive."""
    moved = docs.select(F.pmod(F.xxhash64(key), F.lit(n)).cast("int").alias("block"), F.col(key).alias("key"), F.col(text_col).alias("text")).repartition(n, "block")
    words = terms("text")
    if stop_words:
        stops = F.array(*[F.lit(w) for w in stop_words])
        words = F.filter(words, lambda w: ~F.array_contains(stops, w))
    return moved.select("block", "key", words.alias("words"))


class _Block:
    """Terms of a block in an order that its rows' order does not change, and which document has which term how often.

    A word is a number, a pair of neighbours the number of both: only distinct terms become strings. Terms are dealt over
    ``parts`` by their words, alike in all blocks.
    """

    def __init__(self, table: pa.Table, bigrams: bool, parts: int):
        who = table.column("key").combine_chunks().dictionary_encode("encode")
        lists = table.column("words").combine_chunks()
        many = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
        row = np.repeat(np.arange(len(many)), many)
        words = lists.flatten().dictionary_encode()
        order = pc.sort_indices(words.dictionary).to_numpy()
        rank = np.empty(len(order), dtype=np.int64)
        rank[order] = np.arange(len(order))
        self.words, n = words.dictionary.take(pa.array(order)), len(order)
        code, doc = rank[words.indices.to_numpy()], who.indices.to_numpy()[row].astype(np.int64)
        if bigrams:
            pair = np.flatnonzero(row[1:] == row[:-1])
            code, doc = np.concatenate([code, n + code[pair] * n + code[pair + 1]]), np.concatenate([doc, doc[pair]])
        codes, term = np.unique(code, return_inverse=True)
        at, self.tf = np.unique(doc * max(1, len(codes)) + term, return_counts=True)
        self.keys, self.doc, self.term = who.dictionary, at // max(1, len(codes)), at % max(1, len(codes))
        self.df = np.bincount(self.term, minlength=len(codes))
        self.single = int(np.searchsorted(codes, n))
        self.first = np.concatenate([codes[:self.single], (codes[self.single:] - n) // max(1, n)])
        self.second = (codes[self.single:] - n) % max(1, n)
        sums = np.array([crc32(w.encode()) for w in self.words.to_pylist()], dtype=np.uint64)
        mixed = sums[self.first]
        mixed[self.single:] += sums[self.second] * np.uint64(2654435761)
        part = (mixed % np.uint64(parts)).astype(np.int64)
        self.order = np.argsort(part, kind="stable")
        self.cuts = np.searchsorted(part[self.order], np.arange(parts + 1))

    def strings(self) -> pa.Array:
        pairs = pc.binary_join_element_wise(self.words.take(pa.array(self.first[self.single:])), self.words.take(pa.array(self.second)), " ")
        return pa.concat_arrays([self.words.take(pa.array(self.first[:self.single])), pairs])

    def take(self, found: pa.Table) -> np.ndarray:
        """Puts the counts of all blocks in place; the numbers of asked terms, -1 for the others."""
        ids = np.full(len(self.df), -1, dtype=np.int64)
        if found.num_rows:
            at, df, asked = (found.column(c).combine_chunks() for c in ("at", "df", "asked"))
            place = self.order[np.repeat(self.cuts[found.column("part").to_numpy()], pc.list_value_length(at).to_numpy(zero_copy_only=False)) + at.flatten().to_numpy()]
            self.df[place], ids[place] = df.flatten().to_numpy(), asked.flatten().to_numpy()
        return ids

    def weigh(self, n_docs: int, min_df: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, term, weight) of kept terms, each document's of unit length."""
        kept = (self.df >= max(1, min_df))[self.term]
        doc, term = self.doc[kept], self.term[kept]
        raw = self.tf[kept] * (np.log((1 + n_docs) / (1 + self.df)) + 1)[term]
        return doc, term, raw / np.sqrt(np.bincount(doc, raw * raw, len(self.keys)))[doc]


def _ranges(cuts: np.ndarray, values: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(values, kind))


def _block_terms(blocks: DataFrame, bigrams: bool, parts: int, asked: bool = False) -> DataFrame:
    """(part, block, terms, docs): the distinct terms of a block in its order, with their documents; asked blocks count from -1 down."""
    def run(table: pa.Table) -> pa.Table:
        b = _Block(table, bigrams, parts)
        own = table.column("block")[0].as_py()
        return pa.table([
            pa.array(np.arange(parts), pa.int32()), pa.array(np.full(parts, -1 - own if asked else own), pa.int32()),
            pa.ListArray.from_arrays(pa.array(b.cuts, pa.int32()), b.strings().take(pa.array(b.order))), _ranges(b.cuts, b.df[b.order], pa.int32()),
        ], names=["part", "block", "terms", "docs"])
    return blocks.groupBy("block").applyInArrow(run, "part int, block int, terms array<string>, docs array<int>")


def _shared(table: pa.Table) -> pa.Table:
    """(part, block, at, df, asked): documents over all blocks of the terms of a part that their block cannot know alone."""
    text, own = table.column("terms").combine_chunks(), table.column("docs").combine_chunks().flatten().to_numpy()
    many = pc.list_value_length(text).to_numpy(zero_copy_only=False)
    coded = text.flatten().dictionary_encode()
    code, row = coded.indices.to_numpy(), np.repeat(np.arange(len(many)), many)
    at = np.arange(len(code)) - np.repeat(np.cumsum(many) - many, many)
    asks = (table.column("block").to_numpy() < 0)[row]
    df = np.bincount(code, np.where(asks, 0, own), len(coded.dictionary)).astype(np.int64)
    wanted = np.zeros(len(coded.dictionary), dtype=bool)
    wanted[code[asks]] = True
    send = np.flatnonzero(asks | (df[code] != own) | wanted[code])
    cuts, code, part = np.searchsorted(send, np.concatenate([[0], np.cumsum(many)])), code[send], table.column("part").to_numpy()
    number = np.where(wanted[code], (part[0].astype(np.int64) << 32) + code, -1) if len(part) else code
    return pa.table([table.column("part"), table.column("block"), _ranges(cuts, at[send], pa.int32()), _ranges(cuts, df[code], pa.int64()), _ranges(cuts, number, pa.int64())],
                    names=["part", "block", "at", "df", "asked"])


def _counts(terms: DataFrame, parts: int) -> DataFrame:
    return terms.repartition(parts, "part").groupBy("part").applyInArrow(_shared, "part int, block int, at array<int>, df array<bigint>, asked array<bigint>")


def tfidf(docs: DataFrame, key: str, text_col: str, bigrams: bool = True, min_df: int = 1,
          max_features: int | None = None, stop_words: list[str] | None = None) -> DataFrame:
    """(key, term, weight) with each document's weights of unit length.

    A block of documents sends out each of its terms once, and gets back the counts of those that other blocks have too:
    no row per document and term is shuffled. With ``max_features`` the few kept terms are joined instead.
    """
    if max_features:
        counts = term_counts(docs, key, text_col, bigrams, stop_words)
        idf = inverse_document_frequency(counts, key, docs.agg(F.count("*").alias("n")).scalar(), min_df, max_features)
        return _unit(counts.join(idf, "term").select(key, "term", (F.col("tf") * F.col("idf")).alias("raw")), key)
    rows, n = _n_blocks(docs, text_col)
    blocks, kind = _in_blocks(docs, key, text_col, n, stop_words), docs.schema[key].dataType
    found = _counts(_block_terms(blocks, bigrams, n), n)

    def run(table: pa.Table, found: pa.Table) -> pa.Table:
        b = _Block(table, bigrams, n)
        b.take(found)
        doc, term, weight = b.weigh(rows, min_df)
        names, pieces = b.strings(), range(0, max(1, len(doc)), 1 << 16)
        return pa.concat_tables([pa.table([b.keys.take(pa.array(doc[i:i + (1 << 16)])), names.take(pa.array(term[i:i + (1 << 16)])), pa.array(weight[i:i + (1 << 16)])],
                                          names=[key, "term", "weight"]) for i in pieces])
    return blocks.groupBy("block").cogroup(found.repartition(n, "block").groupBy("block")).applyInArrow(run, f"`{key}` {kind.simpleString()}, term string, weight double")


def _postings(blocks: DataFrame, found: DataFrame, kind, bigrams: bool, parts: int, n_docs: int, n: int, asked: bool = False) -> DataFrame:
    """(block, keys, row, term, weight): postings of asked terms, so many documents a row."""
    def run(table: pa.Table, found: pa.Table) -> pa.Table:
        b = _Block(table, bigrams, parts)
        ids = b.take(found)
        doc, term, weight = b.weigh(n_docs, 1)
        # only queries may go without a name
        some = (ids[term] >= 0) & (asked | b.keys.is_valid().to_numpy(zero_copy_only=False)[doc])
        doc, term, weight = doc[some], ids[term[some]], weight[some]
        firsts = np.arange(0, len(b.keys), SLICE)
        cuts = np.searchsorted(doc, np.append(firsts, len(b.keys)))
        return pa.table([
            pa.array(np.full(len(firsts), table.column("block")[0].as_py()), pa.int32()), pa.ListArray.from_arrays(pa.array(np.append(firsts, len(b.keys)), pa.int32()), b.keys),
            _ranges(cuts, doc % SLICE, pa.int32()), _ranges(cuts, term, pa.int64()), _ranges(cuts, weight, pa.float64()),
        ], names=["block", "keys", "row", "term", "weight"])
    own = found.filter("block < 0").withColumn("block", -1 - F.col("block")) if asked else found.filter("block >= 0")
    return blocks.groupBy("block").cogroup(own.repartition(n, "block").groupBy("block")).applyInArrow(
        run, f"block int, keys array<{kind.simpleString()}>, row array<int>, term array<bigint>, weight array<double>")


def _unpacked(table: pa.Table) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    keys, row, term, weight = (table.column(c).combine_chunks() for c in ("keys", "row", "term", "weight"))
    sizes = pc.list_value_length(keys).to_numpy(zero_copy_only=False)
    start = np.repeat(np.cumsum(sizes) - sizes, pc.list_value_length(row).to_numpy(zero_copy_only=False))
    return keys.flatten(), start + row.flatten().to_numpy(), term.flatten().to_numpy(), weight.flatten().to_numpy()


def _scored(k: int, docs_as: pa.DataType, asked_as: pa.DataType, step: int = 1 << 21):
    """Best ``k`` documents of a block for each query of a block, from their postings alone."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        none = pa.table([pa.array([], asked_as), pa.array([], docs_as), pa.array([], pa.float64())], names=["q", "d", "score"])
        if not left.num_rows or not right.num_rows:
            return none
        (docs, row, term, weight), (asked, whose, theirs, qw) = _unpacked(left), _unpacked(right)
        n_asked, n_docs = len(asked), len(docs)
        by_term = np.argsort(theirs, kind="stable")
        whose, qw = whose[by_term], qw[by_term]
        names, first = np.unique(theirs[by_term], return_index=True)
        first = np.append(first, len(theirs))
        if not len(names):
            return none
        at = np.minimum(np.searchsorted(names, term), len(names) - 1)
        hit = np.flatnonzero(names[at] == term)
        term, row, weight = at[hit], row[hit], weight[hit]
        many = first[term + 1] - first[term]
        score, ends, start = np.zeros(n_docs * n_asked), np.cumsum(many), 0
        while start < len(term):
            # so many products at a time
            stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + step, side="right")))
            n = many[start:stop]
            place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[term[start:stop]], n)
            spots, product = np.repeat(row[start:stop], n) * n_asked + whose[place], np.repeat(weight[start:stop], n) * qw[place]
            # postings come by document, so the products lie within few documents
            low = int(row[start:stop].min()) * n_asked
            high = (int(row[start:stop].max()) + 1) * n_asked
            score[low:high] += np.bincount(spots - low, product, high - low)
            start = stop
        score = np.floor(score.reshape(n_docs, n_asked) * 100 * 100 + 0.5) / 100
        # ties go to the smaller document
        order = pc.sort_indices(docs).to_numpy()
        score, out = score[order], []
        for j in range(n_asked):
            own = score[:, j]
            last = np.partition(own, n_docs - min(k, n_docs))[n_docs - min(k, n_docs)]
            some = np.flatnonzero((own >= last) & (own > 0))
            some = some[np.argsort(-own[some], kind="stable")][:k]
            out.append((np.full(len(some), j), order[some], own[some]))
        q, d, s = (np.concatenate(c) for c in zip(*out))
        return pa.table([asked.take(pa.array(q)), docs.take(pa.array(d)), pa.array(s)], names=["q", "d", "score"])
    return run


def tfidf_search(queries: DataFrame, corpus: DataFrame, qkey: str, qtext: str, key: str, text_col: str, k: int = 5,
                 bigrams: bool = True, stop_words: list[str] | None = None, doc_block: int = 4096, query_block: int = 512) -> DataFrame:
    """Top ``k`` documents per query by TF-IDF cosine, as a percentage; ties to the smaller key.

    Blocks of documents and of queries send out each of their terms once. What comes back are counts over the corpus and
    the numbers of terms that some query has; only postings of these leave a block, some hundred documents in a row, and
    each block of documents scores a block of queries from them as a sparse product and keeps ``k`` documents per query.
    """
    (n_docs, nd), (_, nq) = _n_blocks(corpus, text_col, doc_block), _n_blocks(queries, qtext, query_block)
    docs, asks = _in_blocks(corpus, key, text_col, nd, stop_words), _in_blocks(queries, qkey, qtext, nq, stop_words)
    found = cut_lineage(_counts(_block_terms(docs, bigrams, nd).unionByName(_block_terms(asks, bigrams, nd, True)), nd))
    kinds = queries.schema[qkey].dataType, corpus.schema[key].dataType
    left = _postings(docs, found, kinds[1], bigrams, nd, n_docs, nd).withColumnRenamed("block", "db")
    right = _postings(asks, found, kinds[0], bigrams, nd, n_docs, nq, True).withColumnRenamed("block", "qb")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left, right = left.withColumn("qb", every(nq)), right.withColumn("db", every(nd))
    scored = left.groupBy("db", "qb").cogroup(right.groupBy("db", "qb")).applyInArrow(
        _scored(k, to_arrow_type(kinds[1]), to_arrow_type(kinds[0])), f"q {kinds[0].simpleString()}, d {kinds[1].simpleString()}, score double")
    top = topk(scored, ["q"], [F.desc("score"), F.col("d")], k, rank="rank")
    return top.select(F.col("q").alias(qkey), F.col("d").alias(key), F.col("score").alias("match_score"), "rank")


def _blocks(df: DataFrame, key: str, size: int) -> int:
    return max(1, ceil(df.select(key).count() / size))


def cosine_topk(queries: DataFrame, corpus: DataFrame, qkey: str, key: str, vec: str = "embedding", k: int = 5,
                query_block: int = 4096, corpus_block: int = 20_000) -> DataFrame:
    """Exact top ``k`` by cosine for every query.

    Both sides are hashed into blocks of bounded size. A task multiplies one query block with one corpus block and
    returns only its best ``k`` per query, so neither side is broadcast and no pair rows are shuffled. Each vector moves
    once for every block of the other side; within a task, 64 queries at a time are scored whatever the block.
    """
    nq, nc = _blocks(queries, qkey, query_block), _blocks(corpus, key, corpus_block)
    slot = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    q = queries.select(F.col(qkey).alias("q"), F.col(vec).alias("qv"), slot(qkey, nq).alias("qb")).withColumn("cb", every(nc))
    c = corpus.select(F.col(key).alias("c"), F.col(vec).alias("cv"), slot(key, nc).alias("cb")).withColumn("qb", every(nq))

    def unit(col: pd.Series) -> np.ndarray:
        m = np.stack([np.asarray(v, dtype=np.float64) for v in col])
        size = np.linalg.norm(m, axis=1, keepdims=True)
        return np.divide(m, size, out=np.zeros_like(m), where=size > 0)

    def best(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"q": left["q"][:0], "c": right["c"][:0], "score": pd.Series(dtype="float64")})
        qs, cs, ids = left["q"].to_numpy(), unit(right["cv"]), right["c"].to_numpy()
        out = []
        for start in range(0, len(qs), 64):
            sims = np.round(unit(left["qv"].iloc[start:start + 64]) @ cs.T, 12)
            for name, row in zip(qs[start:start + 64], sims):
                cut = np.partition(row, len(row) - min(k, len(row)))[len(row) - min(k, len(row))]
                near = np.flatnonzero(row >= cut)
                near = near[np.lexsort((ids[near], -row[near]))][:k]
                out.append(pd.DataFrame({"q": name, "c": ids[near], "score": row[near]}))
        return pd.concat(out, ignore_index=True)

    qtype, ctype = queries.schema[qkey].dataType.simpleString(), corpus.schema[key].dataType.simpleString()
    part = q.groupBy("qb", "cb").cogroup(c.groupBy("qb", "cb")).applyInPandas(best, f"q {qtype}, c {ctype}, score double")
    top = topk(part, ["q"], [F.desc("score"), F.col("c")], k, rank="rank")
    return top.select(F.col("q").alias(qkey if qkey != key else f"query_{qkey}"), F.col("c").alias(key), "rank",
                      F.round("score", 4).alias("match_score"))


def kb_retrieve(chat: DataFrame, kb: DataFrame, key: str, text_col: str, default_title: str,
                stop_words: list[str] | None = None) -> DataFrame:
    """Best knowledge item per routed utterance.

    ``kb`` has title, audience, tags (array) and text. Only items for the utterance's audience (or ``both``) compete.
    Tag hits add 0.04 each. An utterance that shares no word with any of them gets the first by title, a weak general
    question the default item.
    """
    counts = term_counts(kb, "title", "text", True, stop_words)
    n = kb.agg(F.count("*").alias("n")).scalar()
    idf = inverse_document_frequency(counts, "title", n)
    unit = lambda c, k: _unit(c.join(idf, "term").select(k, "term", (F.col("tf") * F.col("idf")).alias("raw")), k)
    items = unit(counts, "title").join(kb.select("title", F.col("audience").alias("item_audience"), "tags"), "title")
    asked = unit(term_counts(chat, key, "utterance", True, stop_words), key).withColumnRenamed("weight", "qw")
    asked = asked.join(chat.select(key, "audience"), key)
    fits = (F.col("audience") == "both") | F.col("item_audience").isin("both") | (F.col("item_audience") == F.col("audience"))
    scored = (
        asked.join(items, "term").filter(fits).groupBy(key, "title", "item_audience", "tags")
        .agg(F.sum(F.col("weight") * F.col("qw")).alias("score"))
    )
    best = topk(scored, [key], [F.desc(F.round("score", 9)), F.col("title")], 1)
    fallback = kb.filter(F.col("title") == default_title).select(F.struct("title", "audience").alias("s")).limit(1)
    # one item per audience, of which there are a few
    lead = kb.groupBy("audience").agg(F.min(F.struct("title", F.col("audience").alias("item_audience"), "tags")).alias("m"))
    lead = lead.agg(F.map_from_entries(F.collect_list(F.struct("audience", "m")))).scalar()
    own = F.when(F.col("audience") == "both", F.map_values("_lead")).otherwise(F.array(F.col("_lead")["both"], F.col("_lead")[F.col("audience")]))
    out = chat.join(best, key, "left").withColumn("_d", fallback.scalar()).withColumn("_lead", lead)
    out = out.withColumn("_first", F.array_min(F.filter(own, lambda m: m.isNotNull())))
    none = F.col("title").isNull()
    out = out.withColumns({c: F.when(none, F.col(f"_first.{c}")).otherwise(F.col(c)) for c in ("tags", "item_audience")}).withColumn(
        "title", F.coalesce("title", "_first.title")).drop("_lead", "_first")
    hits = F.size(F.filter(F.coalesce("tags", F.array().cast("array<string>")), lambda t: F.contains(F.col("utterance"), t)))
    base = F.coalesce("score", F.lit(0.0))
    boosted = F.when(hits > 0, F.least(F.lit(1.0), base + 0.04 * hits)).otherwise(base)
    out = out.withColumn("score", boosted)
    weak = F.col("title").isNull() | (F.coalesce(F.col("intent") == "general", F.lit(False)) & (F.col("score") < 0.12))
    out = out.withColumn("matched_topic", F.when(weak, F.col("_d.title")).otherwise(F.col("title"))).withColumn(
        "_aud", F.when(weak, F.col("_d.audience")).otherwise(F.col("item_audience")))
    conf = F.least(F.lit(0.97), 0.42 + F.col("score") * 2.0) + F.when(
        (F.col("audience") != "both") & (F.col("_aud") == F.col("audience")), 0.05).otherwise(0.0)
    return out.withColumn("confidence", F.round(F.least(conf, F.lit(0.97)), 2)).drop("_d", "_aud", "item_audience", "tags", "title")
