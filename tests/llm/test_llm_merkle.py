"""The Merkle manifest against a plain tree over the whole table."""

import hashlib
import random
import zlib

import __spark_entry__ as entry
import pytest
from fundloom.llm import merkle
from pyspark.sql import functions as F

FOLDER = "/root/testdata/sf0.001"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row["doc_id"], row["source"], row["lang"], row["n_chars"], text)])


def tree(nodes):
    """Root, and for each leaf its siblings level by level."""
    ways, levels = [[] for _ in nodes], [nodes]
    while len(levels[-1]) > 1:
        now = levels[-1]
        for i, way in enumerate(ways):
            at = i // 16 ** (len(levels) - 1)
            way.append([(k, v) for k, v in enumerate(now) if k // 16 == at // 16 and k != at])
        levels.append([h(*now[k : k + 16]) for k in range(0, len(now), 16)])
    return levels[-1][0], ways


def fold(value, at, ways):
    for way in ways:
        value = h(*[v for _, v in sorted([*way, (at, value)])])
        at //= 16
    return value


def plain(rows, tamper):
    groups = {}
    for r in rows:
        groups.setdefault(r["source"], []).append((r["doc_id"], leaf(r, r["text"]), leaf(r, tamper(r))))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for g in groups.values():
        g.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2]))
    roots = {s: tree([x[1] for x in groups[s]]) for s in order}
    root, over = tree([roots[s][0] for s in order])
    out = []
    for k, s in enumerate(order):
        for i, (key, mine, said) in enumerate(groups[s]):
            way = roots[s][1][i]
            proof = h(*[v for level in way + over[k] for _, v in level])
            folded = fold(fold(said, i, way), k, over[k])
            out.append((key, mine, roots[s][0], root, proof, folded, folded == root))
    return sorted(out, key=repr)


def lowered(r):
    hit = r["text"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 and r["doc_id"] is not None
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in r["text"]) if hit else r["text"]


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_query(spark):
    rows = [r.asDict() for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    out = entry.queries()["op12_merkle_manifest"](spark, FOLDER)
    assert out.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert got(out) == plain(rows, lowered)


@pytest.mark.parametrize("block", [1, 7, 40, 4096])
def test_blocks_of_any_size(spark, block):
    """Groups from one row to several levels, a hot one, null groups and keys, ties and repeated rows."""
    r = random.Random(block)
    rows = [(i if i % 41 else None, r.choice(["hot", "hot", "é", "z", "", None, f"s{r.randrange(30)}"]), "en", i, f"Text {i % 50}") for i in range(900)]
    rows += [(5, "hot", "en", 5, "Text 5")] * 40 + [(7, "hot", None, None, None), (7, "hot", None, None, "")]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(5)
    low = F.lower("text")
    out = merkle.prove(df, merkle.document_leaf(), merkle.document_leaf(low), block=block)
    want = plain([dict(zip(df.columns, x)) for x in rows], lambda x: None if x["text"] is None else x["text"].lower())
    assert got(out) == want


def test_proof_folds_to_the_root_by_itself(spark):
    df = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for r in merkle.prove(df, merkle.document_leaf(), with_siblings=True).limit(50).collect():
        assert r.verified and r.root == r.folded_root and h(*r.siblings) == r.proof_sha256


def test_odd_rows(spark, few, none):
    rows = [r.asDict() for r in few.collect()]
    assert got(merkle.prove(few, merkle.document_leaf())) == plain(rows, lambda r: r["text"])
    assert merkle.prove(none, merkle.document_leaf()).count() == 0
    one = few.filter("doc_id = 1")
    r = merkle.prove(one, merkle.document_leaf()).first()
    assert r.leaf == r.subroot == r.root == r.folded_root and r.proof_sha256 == h("")
