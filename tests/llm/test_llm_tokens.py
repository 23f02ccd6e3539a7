"""Tokens, packing, token files and token counts against the library and plain versions."""

import random
import zlib
from itertools import groupby

import numpy as np
import pytest

from fundloom.llm import packing, rans, tokencount
from fundloom.llm.common import scratch_path
from fundloom.llm.tokens import Encoder, word_bpe_path

ODD = ["", " ", "It's <|endoftext|> don't", "Ünḯ é a b \t c\x1cd 12 3,4 --'s 'll x's", "日本語 テスト ΣΑΣ. İ ß ǅ ﬁ", "A'T b'S " + "x" * 300, "a‍b­c ª º µ", "…—“q” …",
       "don't,I'll... (see [1])", "ÀÉÎÕÜ çà-va? naïve/coöp", "é Éa ́b", "<|startoftext|>", "\n\n a\r\nb"]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(word_bpe_path())


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_words_give_the_library_s_ids(library, tables):
    mine = Encoder(word_bpe_path(), room=50)
    texts = ODD + [r.text for r in tables.documents.limit(40).collect()] + [r.text for r in tables.conversations.limit(40).collect()]
    assert mine.by_word
    for t in texts:
        assert np.frombuffer(mine.encode(t), "<u2").tolist() == ids_of(library, t), t


def test_other_tokenizers_get_whole_texts():
    import public_tokenizers
    from tokenizers import Tokenizer
    path = public_tokenizers.path("byte_bpe_50k.json")
    mine, theirs = Encoder(path), Tokenizer.from_file(path)
    assert not mine.by_word
    assert np.frombuffer(mine.encode("Hello  world, it's"), "<u2").tolist() == theirs.encode("Hello  world, it's", add_special_tokens=False).ids


def test_best_fit_finds_the_tightest_window():
    rng = random.Random(1)
    for _ in range(100):
        items = [(rng.randint(1, 63), i, 0) for i in range(rng.randint(0, 60))]
        plain = []
        for item in sorted(items, key=lambda x: -x[0]):
            fits = [b for b in plain if b[0] >= item[0]]
            into = min(fits, key=lambda b: b[0]) if fits else [64, []]
            if not fits:
                plain.append(into)
            into[0] -= item[0]
            into[1].append(item[0])
        got = [(room, sorted(x[0] for x in inside)) for room, inside in packing.best_fit(items, 64)]
        assert sorted(b[0] for b in plain) == sorted(r for r, _ in got)
        assert all(room + sum(inside) == 64 for room, inside in got)


@pytest.mark.parametrize("window,slack", [(2048, 8), (64, 0), (128, 5)])
def test_pack_keeps_every_id_once(spark, library, few, tables, window, slack):
    docs = few.select("doc_id", "text").distinct().union(tables.documents.select("doc_id", "text").filter("doc_id > 20").limit(60)).coalesce(2)
    rows = packing.pack(docs, window=window, slack=slack).collect()
    wanted = sorted((-1 if d is None else d, np.array([*ids_of(library, t), 1], "<u4").tobytes()) for d, t in docs.collect())
    got = []
    key = lambda r: (-1 if r.doc_id is None else r.doc_id, r.doc_tokens)
    for (d, n), parts in groupby(sorted(rows, key=lambda r: (*key(r), r.start)), key):
        parts = list(parts)
        assert all(zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in parts)
        got.append((d, b"".join(r.ids for r in parts)))
    assert sorted(got) == wanted
    assert sum(r.length for r in rows) == sum(len(b) // 4 for _, b in wanted)
    padding = 0
    for _, parts in groupby(sorted(rows, key=lambda r: (r.sequence_id, r.offset)), lambda r: r.sequence_id):
        at = 0
        for r in parts:
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= window
        padding += 0 if at & (at - 1) == 0 else window - at
        assert at & (at - 1) == 0 or window - at <= slack
    assert padding <= 0.01 * sum(r.length for r in rows) or slack


def test_pack_repeats_and_nothing(few, none):
    assert packing.pack(none).count() == 0
    starts = [r.start for r in packing.pack(few).filter("doc_id = 7").collect()]
    assert starts.count(0) == 2


def test_sequences(spark, few):
    pieces = packing.pack(few, window=256)
    out = packing.sequences(pieces).collect()
    assert all(len(r.ids) == 4 * r.length and r.length <= 256 for r in out)
    assert sum(r.length for r in out) == pieces.agg({"length": "sum"}).first()[0]


def test_blocks_round_trip():
    rng = np.random.default_rng(4)
    for size, kinds in [(1, 1), (5, 3), (1000, 2), (70_000, 30_000), (4097, 65_000)]:
        ids = np.minimum(rng.zipf(1.3, size), kinds) - 1
        table = rans.Table(*np.unique(ids, return_counts=True))
        assert int(table.freq.sum()) == 1 << table.bits and table.freq.min() >= 1
        table = rans.Table.stored(table.to_bytes()).ready()
        for lanes in (1, 7, 64):
            raw = rans.encode_block(ids, table, lanes)
            assert (rans.decode_block(raw, size, lanes, table) == ids).all()


def test_files_find_damage():
    docs = [(3, np.array([1, 2, 3, 1])), (None, np.array([], np.int64)), (9, np.arange(600_000) % 5)]
    flat = np.concatenate([d for _, d in docs])
    table = rans.Table(*np.unique(flat, return_counts=True)).ready()
    raw = rans.encode_file(docs, 100, table)
    back = list(rans.decode_file(raw, table))
    assert [(k, s, i.tolist()) for k, s, i in back] == [(3, 100, [1, 2, 3, 1]), (None, 104, []), (9, 104, docs[2][1].tolist())]
    for at in (50, len(raw) - 9):
        hurt = bytearray(raw)
        hurt[at] ^= 1
        with pytest.raises(Exception):  # noqa: B017
            list(rans.decode_file(bytes(hurt), table))


def test_token_files(spark, library, few, none):
    folder = scratch_path(spark, "test-tokens")
    files = rans.write_tokens(few, folder)
    assert files.count() >= 1
    got = [(r.doc_id, r.start, r.n_tokens, bytes(r.ids)) for r in rans.read_tokens(spark, folder).collect()]
    at, wanted = 0, []
    for d, t in sorted(((r.doc_id, r.text or "") for r in few.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        ids = np.array([*ids_of(library, t), 2], "<u4")
        wanted.append((d, at, len(ids), ids.tobytes()))
        at += len(ids)
    assert sorted(got, key=lambda r: r[1]) == wanted
    empty = scratch_path(spark, "test-tokens")
    rans.write_tokens(none, empty)
    assert rans.read_tokens(spark, empty).count() == 0


def plain_count(word, voc):
    """Best segmentation of a word by itself."""
    best = [(0.0, 0)]
    for at in range(1, len(word) + 1):
        size = len(word[at - 1].encode())
        tries = [(best[at - 1][0] + size * voc.byte, best[at - 1][1] - size)]
        tries += [(best[k][0] + voc.scores[word[k:at]], best[k][1] - 1) for k in range(at) if word[k:at] in voc.scores]
        best.append(max(tries))
    return -best[-1][1]


def test_counts_match_words_alone(spark, few, none, tables, monkeypatch):
    voc = tokencount.Vocabulary(tokencount.piece_path())
    docs = few.select("doc_id", "text").union(tables.documents.select("doc_id", "text").limit(40))
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.n_words, r.n_tokens) for r in tokencount.token_counts(docs).collect())
    known = {}
    wanted = []
    for d, t in docs.collect():
        words = (t or "").split()
        for w in words:
            known.setdefault(w, plain_count("▁" + w, voc))
        wanted.append((-1 if d is None else d, len(words), sum(known[w] for w in words)))
    assert got == sorted(wanted)
    assert tokencount.token_counts(none).count() == 0
    monkeypatch.setattr(tokencount, "NODES", 5)
    monkeypatch.setattr(tokencount, "WORDS", 3)
    small = tokencount.Trie(voc)
    for w in ("the", "then", "there", "日本", "the"):
        small.counts([w])
        assert small.words[w] == plain_count("▁" + w, voc)


def test_long_words_keep_no_nodes():
    voc = tokencount.Vocabulary(tokencount.piece_path())
    rng = random.Random(6)
    trie = tokencount.Trie(voc)
    for n in (1, 5, 255, 256, 257, 300, 900):
        word = "".join(rng.choice("abcdeé日thin") for _ in range(n))
        assert trie.walk("▁" + word) == plain_count("▁" + word, voc)
        trie.counts([word])
        assert trie.words[word] == plain_count("▁" + word, voc)
    assert len(trie.score) < 2 + 5 + 255 + 256 + 10
    before = len(trie.score)
    trie.counts(["x" * 100_000])
    assert len(trie.score) == before


def test_kept_characters_are_bounded(monkeypatch):
    monkeypatch.setattr(tokencount, "CHARS", 1000)
    trie = tokencount.Trie(tokencount.Vocabulary(tokencount.piece_path()))
    for k in range(30):
        trie.counts([f"{k}" + "y" * 100])
        assert sum(map(len, trie.words)) <= 1000
