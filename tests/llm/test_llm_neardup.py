"""MinHash near-duplicates against exact sets, and the components they share."""

import random

import numpy as np
import pytest

from fundloom.llm import neardup
from fundloom.llm.components import components
from fundloom.llm.shingles import shingle_sets, word_hashes


def words_of(text):
    return (text or "").encode().lower().split()


def exact(docs, width, percent):
    """Smallest doc_id that links reach, by comparing all pairs."""
    sets = {}
    for d, t in docs:
        w = words_of(t)
        sets[d] = {tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))} if w else set()
    low = {d: d for d in sets}
    ids = sorted(sets)
    while True:
        moved = False
        for a in ids:
            for b in ids:
                if a < b and sets[a] and sets[b] and low[a] != low[b]:
                    both = len(sets[a] & sets[b])
                    if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                        low[a] = low[b] = min(low[a], low[b])
                        moved = True
        if not moved:
            return low, {d: len(s) for d, s in sets.items()}


def made(seed):
    """Unrelated texts, a large group of near copies, chains of copies of copies, and a passage that many share."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(4000)]
    docs = [" ".join(rng.choices(vocabulary, k=rng.randint(0, 80))) for _ in range(60)]
    base, passage = rng.choices(vocabulary, k=60), rng.choices(vocabulary, k=40)
    for _ in range(50):
        copy = base[:]
        for _ in range(rng.randint(0, 4)):
            copy[rng.randrange(60)] = rng.choice(vocabulary)
        docs.append(" ".join(copy))
    for _ in range(50):
        docs.append(" ".join(passage + rng.choices(vocabulary, k=rng.randint(2, 12))))
    chain = rng.choices(vocabulary, k=70)
    for _ in range(15):
        chain = chain[:]
        chain[rng.randrange(70)] = rng.choice(vocabulary)
        docs.append(" ".join(chain))
    docs += [docs[3]] * 5 + ["", "alone", "Alone"]
    rng.shuffle(docs)
    return list(enumerate(docs))


@pytest.mark.parametrize("width,seed", [(4, 1), (5, 2)])
def test_components_match_all_pairs(spark, width, seed):
    docs = made(seed)
    got = {r.doc_id: r for r in neardup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), width=width).collect()}
    low, sizes = exact(docs, width, 80)
    assert {d: r.component_id for d, r in got.items()} == low
    assert {d: r.n_shingles for d, r in got.items()} == sizes
    assert all(r.kept == (r.component_id == d) for d, r in got.items())


def test_long_lists_go_through_tiles(spark, monkeypatch):
    monkeypatch.setattr(neardup, "SMALL", 3)
    monkeypatch.setattr(neardup, "HUBS", 1)
    monkeypatch.setattr(neardup, "TILE", 8)
    docs = made(5)
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), width=4).collect()}
    assert got == exact(docs, 4, 80)[0]


def test_odd_rows(few, none):
    got = {}
    for r in neardup.near_duplicates(few, width=4).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert got[1][0].component_id == got[2][0].component_id == got[3][0].component_id == 1
    assert got[5][0].n_shingles == 0 and got[5][0].kept and got[10][0].n_shingles == 0
    assert got[9][0].component_id == 8 and got[8][0].n_shingles == 1
    assert len(got[7]) == 2 and len(got[None]) == 2 and all(r.component_id is None and r.kept for r in got[None])
    assert neardup.near_duplicates(none).count() == 0


def test_keep_one(few, none):
    out = neardup.keep_one(few, width=4)
    assert out.columns == few.columns
    ids = [r.doc_id for r in out.collect()]
    assert sorted(i for i in ids if i) == [1, 5, 6, 7, 8, 10, 11] and ids.count(None) == 2
    assert neardup.keep_one(none).count() == 0


def test_two_texts_under_one_doc_id(spark):
    """Unlike texts stay although the other text of their doc_id is a near copy; repeated rows go."""
    rng = random.Random(8)
    words = [f"w{i}" for i in range(3000)]
    base = rng.choices(words, k=60)
    copies = []
    for i in range(40):
        copy = base[:]
        copy[rng.randrange(60)] = rng.choice(words)
        copies.append((i, " ".join(copy)))
    alone = [(i, " ".join(rng.choices(words, k=50))) for i in range(10, 20)] + [(0, " ".join(rng.choices(words, k=50)))]
    rows = copies + alone + alone[:3] + [(12, alone[2][1].upper())]
    out = neardup.keep_one(spark.createDataFrame(rows, "doc_id long, text string").repartition(6), width=4)
    got = sorted((r.doc_id, r.text.lower()) for r in out.collect())
    assert got == sorted([copies[0], *alone])
    seen = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), width=4).collect()
    assert len(seen) == len(rows) and sum(r.component_id == 0 for r in seen) == 41


def test_words_are_split_anywhere_alike():
    rng = random.Random(3)
    texts = ["".join(rng.choice("ab \n\té") for _ in range(rng.randint(0, 50))).encode() for _ in range(200)] + [b"x" * 3_000_000 + b" y", b""]
    hashes, counts = word_hashes(texts, {})
    assert counts.tolist() == [len(t.lower().split()) for t in texts]
    alone = np.concatenate([word_hashes([t], {})[0] for t in texts])
    assert (hashes == alone).all()
    seen = {}
    for h, w in zip(hashes.tolist(), [w for t in texts for w in t.split()]):
        assert seen.setdefault(h, w) == w


def test_sets_of_batches_match_single_texts():
    texts = [b"a b c d e f", b"A B c d", b"a b", b"", b"a b c d e f g a b c d e f g"]
    together = shingle_sets(texts, 4, {})
    assert [len(s) for s in together] == [3, 1, 1, 0, 7]
    assert all((s == shingle_sets([t], 4, {})[0]).all() for s, t in zip(together, texts))
    assert together[1][0] in together[0]


def test_components_of_paths_and_stars(spark):
    rng = random.Random(9)
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 200)] + [(5000, 5000), (7, 7)]
    rng.shuffle(edges)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long").repartition(7)).collect()}
    assert got == {**{i: 0 for i in range(301)}, **{1000 + i: 1000 for i in range(200)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
