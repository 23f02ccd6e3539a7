"""Piece encoding and decoding against the library, on its own model and on hard texts."""

import hashlib
import random

import pytest
from sentencepiece import SentencePieceProcessor

import __spark_entry__ as entry
from fundloom.llm import pieces

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_file=pieces.piece_bpe_path())


@pytest.fixture(scope="module")
def coder():
    return pieces.PieceCoder(pieces.piece_bpe_path())


def hard_texts(n, seed):
    r = random.Random(seed)
    some = [*" ▁\n\tabeéßñ日本ü.,-1239AZ²\x00​😀�<s>/ा", "  ", "    ", " " * 17, "the", "ing", "\r\n", "</s>", "<0x0A>", " "]
    return ["".join(r.choice(some) for _ in range(r.randrange(30))) for _ in range(n)]


def test_hard_texts(library, coder):
    assert coder.runs is not None and coder.library is None
    for x in ["", " ", "  ", *hard_texts(4000, 1)]:
        ids = list(coder.encode(x))
        assert ids == library.encode(x) and coder.decode(ids) == library.decode(ids)
        assert list(coder.encode(x, end=True)) == library.encode(x, add_eos=True)


def test_any_ids_decode(library, coder):
    r = random.Random(2)
    for _ in range(4000):
        ids = [r.choice([r.randrange(300), r.randrange(259, 32000), 28705, 2, 0, 1, 200]) for _ in range(r.randrange(9))]
        assert coder.decode(ids) == library.decode(ids)


def test_every_prefix_ends_in_the_stored_token(library, coder):
    for x in ("▁internationalisation", "▁aaaaaaaaaa", "▁▁▁▁▁▁▁▁▁▁▁▁▁▁▁▁▁▁▁▁▁x", "▁日本語é"):
        last = coder.last_tokens(x)
        for k in range(1, len(x) + 1):
            own = coder.merged(x[:k])[-1]
            assert last[k] == coder.piece.get(own, -2 - ord(own[-1]))


def test_long_texts_and_small_rooms(library, coder, monkeypatch):
    r = random.Random(3)
    monkeypatch.setattr(pieces, "ROOM", 50)
    monkeypatch.setattr(pieces, "PAIRS", 40)
    for x in ("".join(r.choice("abcdeé日") for _ in range(5_000)), " " * 10_001, "word " * 5_000, *hard_texts(200, 4)):
        ids = list(coder.encode(x))
        assert ids == library.encode(x) and coder.decode(ids) == x.replace("▁", " ")


def test_odd_rows(spark, few, none, library):
    for out in (pieces.encoded(none), pieces.digests(none), pieces.decoded(pieces.encoded(none))):
        assert out.count() == 0
    rows = few.collect()
    want = sorted(((r.doc_id, library.encode(r.text or "", add_eos=True)) for r in rows), key=repr)
    ids = pieces.encoded(few)
    assert sorted(((r.doc_id, list(r.ids)) for r in ids.collect()), key=repr) == want
    assert sorted(((r.doc_id, r.text) for r in pieces.decoded(ids).collect()), key=repr) == sorted(((r.doc_id, r.text or "") for r in rows), key=repr)
    assert all(r.ids == w[1][:-1] for r, w in zip(sorted(pieces.encoded(few, end=False).collect(), key=lambda r: repr((r.doc_id, list(r.ids) + [2]))), want))


def test_query(spark, library):
    got = {r.doc_id: r for r in entry.queries()["op13_piece_encoding"](spark, FOLDER).collect()}
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    assert len(got) == len(rows)
    for r in rows:
        ids = library.encode(r.text or "", add_eos=True)
        mine = got[r.doc_id]
        assert mine.n_tokens == len(ids)
        assert mine.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert mine.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
