"""The registered queries over their whole tables: columns, and a row for each document, vector, conversation or piece."""

import zlib

import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_packing": ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
    "op2_chat_format": ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
    "op3_mixing": ["doc_id", "source", "lang", "topic", "n_tokens", "weight", "probability"],
    "op4_embedding_near_dedup": ["vec_id", "n_links", "component_id", "kept"],
    "op5_token_counts": ["doc_id", "n_words", "n_tokens"],
    "op6_rans_tokens": ["doc_id", "start", "n_tokens", "ids_crc32"],
    "op7_pii": ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
    "op8_quality_classifier": ["doc_id", "held_out", "score", "predicted"],
    "op9_minhash_near_dedup": ["doc_id", "n_shingles", "component_id", "kept"],
    "op13_piece_encoding": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op11_conversation_repair": ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"],
    "op12_merkle_manifest": ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"],
    "op10_permutation_index": ["query_id", "rank", "vec_id", "score"],
}


def rows(spark, table):
    return spark.read.parquet(f"{FOLDER}/{table}.parquet")


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns_and_rows(spark, name):
    out = entry.queries()[name](spark, FOLDER)
    assert set(COLUMNS[name]) <= set(out.columns)
    got = out.collect()
    docs = {r.doc_id: r.text for r in rows(spark, "documents").collect()}
    if name == "op1_packing":
        assert {r.doc_id for r in got} == set(docs) and all(sum(p.length for p in got if p.doc_id == d) == next(p.doc_tokens for p in got if p.doc_id == d) for d in list(docs)[:20])
    elif name == "op2_chat_format":
        convs = {r.conv_id for r in rows(spark, "conversations").collect()}
        assert {r.conv_id for r in got} == convs | {-7}
        mine = next(r for r in got if r.conv_id == -7)
        assert mine.n_turns == 2 and mine.loss_chars == len(r"\### Assistant: </turn> ok") and mine.valid
    elif name == "op3_mixing":
        assert 0 < len(got) < len(docs) and len({r.doc_id for r in got}) == len(got)
    elif name == "op4_embedding_near_dedup":
        assert sorted(r.vec_id for r in got) == sorted(r.vec_id for r in rows(spark, "embeddings").collect())
    elif name == "op8_quality_classifier":
        assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.3) for r in got) and len(got) == len(docs)
    elif name == "op11_conversation_repair":
        assert sorted(r.conv_id for r in got) == sorted({r.conv_id for r in rows(spark, "conversations").collect()})
    elif name == "op10_permutation_index":
        ids = [r.vec_id for r in rows(spark, "embeddings").collect()]
        assert sorted({r.query_id for r in got}) == sorted(i for i in ids if i % 20 == 0) and len(got) == 20 * len({r.query_id for r in got})
    else:
        assert sorted(r.doc_id for r in got) == sorted(docs)
