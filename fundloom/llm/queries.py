"""The registered queries of this package: each dealt operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..plans.registry import Tables
from ..session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
def _crc32_sql(text: str) -> str:
    """CRC-32 of an ASCII text, bit by bit."""
    bits = "list_reduce(list_concat([xor(c, b)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))"
    return f"xor(4294967295::BIGINT, list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split({text}, ''), lambda h: CAST(ascii(h) AS BIGINT))), lambda c, b: {bits}))"


def _merkle_sql(levels: int = 5) -> str:
    """The manifest with so many levels in each tree: a tree of one node stays as it is, so lower trees come out alike."""
    said = lambda v: f"coalesce(strlen({v}) || ':' || {v}, '-')"
    leaf = lambda text: "sha256(" + " || ".join(map(said, ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text])) + ")"
    low = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    out = [f"""le AS (SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, claimed) - 1 AS idx
 FROM (SELECT doc_id, source, {leaf('text')} AS leaf, CASE WHEN {_crc32_sql('CAST(doc_id AS VARCHAR)')} % 5 = 0 THEN {leaf(low)} ELSE {leaf('text')} END AS claimed FROM documents))""",
           "a0 AS (SELECT tree, idx, leaf AS h FROM le)", "w0 AS (SELECT doc_id, leaf, tree, idx AS pl, '' AS proof, claimed AS f FROM le)"]
    for name, last in (("a", "w0"), ("b", f"wa{levels}")):
        if name == "b":
            out += [f"su AS (SELECT tree, h AS subroot FROM a{levels})", "b0 AS (SELECT -1 AS tree, tree AS idx, subroot AS h FROM su)",
                    f"wb0 AS (SELECT doc_id, leaf, w.tree AS own, -1 AS tree, w.tree AS pl, proof, f FROM {last} w)"]
        for k in range(levels):
            before = f"wb{k}" if name == "b" else ("w0" if k == 0 else f"wa{k}")
            left, right = "coalesce(array_to_string(hs[1:pl % 16], ''), '')", "coalesce(array_to_string(hs[pl % 16 + 2:], ''), '')"
            out += [f"r{name}{k} AS (SELECT tree, idx // 16 AS run, list(h ORDER BY idx) AS hs FROM {name}{k} GROUP BY 1, 2)",
                    f"{name}{k + 1} AS (SELECT tree, run AS idx, CASE WHEN run = 0 AND len(hs) = 1 THEN hs[1] ELSE sha256(array_to_string(hs, '')) END AS h FROM r{name}{k})",
                    f"w{name}{k + 1} AS (SELECT doc_id, leaf, {'own, ' if name == 'b' else ''}w.tree, pl // 16 AS pl, proof || {left} || {right} AS proof, "
                    f"CASE WHEN run = 0 AND len(hs) = 1 THEN f ELSE sha256({left} || f || {right}) END AS f FROM {before} w JOIN r{name}{k} r ON r.tree = w.tree AND run = pl // 16)"]
    return ("WITH " + ",\n".join(out) + f"\nSELECT doc_id, leaf, subroot, h AS root, sha256(proof) AS proof_sha256, f AS folded_root, f = h AS verified FROM wb{levels} w "
            f"JOIN su ON su.tree = w.own, b{levels} b")


#: All pairs and all levels in SQL: for the small scales.
ORACLES: dict[str, str] = {
    "op12_merkle_manifest": _merkle_sql(),
    "op4_embedding_near_dedup": """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
ok AS (SELECT vec_id, e FROM v WHERE len(list_filter(e, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
li AS (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.9),
cc(id, low) AS (SELECT vec_id, vec_id FROM v UNION SELECT li.b, cc.low FROM cc JOIN li ON li.a = cc.id WHERE cc.low < li.b),
lo AS (SELECT id, min(low) AS low FROM cc GROUP BY 1), n AS (SELECT a, count(*) AS n FROM li GROUP BY 1)
SELECT vec_id, coalesce(n, 0) AS n_links, low AS component_id, low = vec_id AS kept FROM v JOIN lo ON lo.id = vec_id LEFT JOIN n ON n.a = vec_id""",
    "op9_minhash_near_dedup": r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ \t\n\v\f\r]+') AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 4 THEN list_transform(range(1, len(w) - 2), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3])
 WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM d),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY 1),
pa AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS hits FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
li AS (SELECT a, b FROM pa JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * hits >= 80 * (x.n + y.n - hits)),
ed AS (SELECT a, b FROM li UNION ALL SELECT b, a FROM li),
cc(id, low) AS (SELECT doc_id, doc_id FROM d UNION SELECT ed.b, cc.low FROM cc JOIN ed ON ed.a = cc.id WHERE cc.low < ed.b),
lo AS (SELECT id, min(low) AS low FROM cc GROUP BY 1)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, low AS component_id, low = d.doc_id AS kept FROM d JOIN lo ON lo.id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id""",
}


def llm_query(fn):
    """Registers a builder under its function name; rows of whole texts are large, so a batch holds few of them."""
    def run(spark: SparkSession, folder: str) -> DataFrame:
        tune(spark).conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
        return fn(Tables(spark, folder))

    QUERIES[fn.__name__] = run
    return fn


@llm_query
def op9_minhash_near_dedup(t: Tables) -> DataFrame:
    from .neardup import near_duplicates
    return near_duplicates(t.documents, width=4, percent=80)


@llm_query
def op1_packing(t: Tables) -> DataFrame:
    from .packing import pack
    return pack(t.documents, with_ids=False)


@llm_query
def op8_quality_classifier(t: Tables) -> DataFrame:
    from .quality import fit, score
    scored = score(t.documents.select("doc_id", "text"), fit(t.documents, t.labels), "score")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return scored.select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@llm_query
def op7_pii(t: Tables) -> DataFrame:
    from .pii import KINDS, find, fit
    docs = t.documents.select("doc_id", "text")
    marked = find(docs, fit(docs))
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    return marked.select(
        "doc_id", *[F.expr(f"cast(size(filter(base, s -> s.kind = '{k}')) as long)").alias(f"n_{k}") for k in KINDS],
        F.sha2(listed("base"), 256).alias("base_sha256"), listed("spans").alias("spans"))


@llm_query
def op2_chat_format(t: Tables) -> DataFrame:
    from .chat import digests, format_turns
    rows = t.conversations.select("conv_id", "turn", "role", "text")
    said = "\\### Assistant: </turn> ok"
    extra = t.spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return digests(format_turns(rows.union(extra)))


@llm_query
def op3_mixing(t: Tables) -> DataFrame:
    from .mixing import mix
    return mix(t.documents).select("doc_id", "source", "lang", "topic", "n_tokens", "weight", "probability")


@llm_query
def op4_embedding_near_dedup(t: Tables) -> DataFrame:
    from .embdedup import near_vectors
    return near_vectors(t.embeddings)


@llm_query
def op10_permutation_index(t: Tables) -> DataFrame:
    from .ann import nearest
    return nearest(t.embeddings, t.embeddings.filter("vec_id % 20 = 0"))


@llm_query
def op6_rans_tokens(t: Tables) -> DataFrame:
    from .common import scratch_path
    from .rans import read_tokens, write_tokens
    folder = scratch_path(t.spark, "tokens")
    write_tokens(t.documents, folder)
    return read_tokens(t.spark, folder, with_ids=False)


@llm_query
def op5_token_counts(t: Tables) -> DataFrame:
    from .tokencount import token_counts
    return token_counts(t.documents)


@llm_query
def op13_piece_encoding(t: Tables) -> DataFrame:
    from .pieces import digests
    return digests(t.documents)


@llm_query
def op12_merkle_manifest(t: Tables) -> DataFrame:
    from .merkle import document_leaf, prove
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return prove(t.documents, document_leaf(), F.when(hit, document_leaf(lower)).otherwise(document_leaf()))


@llm_query
def op11_conversation_repair(t: Tables) -> DataFrame:
    from .repair import audit_all, damaged
    return audit_all(damaged(t.conversations), t.conversations)
