"""The pipeline: each stage on its own input, and all of them together."""

import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from fundloom.llm.common import saved
from test_llm_neardup import exact

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = [spark.read.parquet(f"{FOLDER}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        docs.append(saved(stage(spark, docs[-1], FOLDER), name))
    return docs


def test_columns_and_rows(steps):
    names = steps[0].columns
    assert all(s.columns == names for s in steps[1:-1]) and len(corpus_pipeline.STAGES) == 5
    counts = [s.count() for s in steps[:-1]]
    assert counts[0] >= counts[1] >= counts[2] == counts[3] >= counts[4] > 0


def test_one_of_each_group_stays(steps):
    before = [(r.doc_id, r.text) for r in steps[1].collect()]
    low, _ = exact(before, 5, 80)
    assert sorted(r.doc_id for r in steps[2].collect()) == sorted(d for d in low if low[d] == d)


def test_only_spans_change(steps):
    before, after = ({r.doc_id: r for r in s.collect()} for s in steps[2:4])
    assert set(before) == set(after)
    assert all("@" not in r.text or "@" not in before[d].text or ".com" not in r.text for d, r in after.items())
    assert all(after[d] == r for d, r in before.items() if not any(c.isdigit() or c == "@" for c in r.text))


def test_every_id_is_packed(spark, steps):
    from fundloom.llm.tokens import Encoder, word_bpe_path
    coder = Encoder(word_bpe_path())
    pieces = {}
    for r in steps[5].collect():
        pieces.setdefault(r.doc_id, []).append((r.start, bytes(r.ids)))
    for r in steps[4].collect():
        ids = np.frombuffer(coder.encode(r.text or ""), "<u2").astype("<u4").tobytes() + np.array([1], "<u4").tobytes()
        assert b"".join(p for _, p in sorted(pieces.pop(r.doc_id))) == ids
    assert not pieces


def test_run_gives_the_stages_rows(spark, steps):
    key = lambda df: sorted((r.doc_id, r.start, r.length, r.ids_crc32) for r in df.select("doc_id", "start", "length", "ids_crc32").collect())
    assert sum(k[2] for k in key(entry.queries()["pipeline"](spark, FOLDER))) == sum(k[2] for k in key(steps[-1]))


@pytest.fixture(scope="module")
def odd(spark, steps):
    """The smallest scale with nulls in every column, empty and long texts, repeated rows and columns that clash with work columns."""
    extra = [(None, None, None, None, None), (90001, None, "en", "src0", 0), (90002, "", None, None, None), (90003, "", "xx", "src0", 0), (None, "a text of its own " * 9, "en", "src1", 9),
             (90004, "word " * 60_000, "en", "src0", 300_000), (90005, "z" * 200_000, "en", "src0", 200_000)]
    docs = steps[0].limit(60)
    rows = docs.union(docs.limit(5)).union(spark.createDataFrame(extra + extra[1:3], docs.schema))
    return rows.selectExpr("*", "7 AS _text", "'x' AS kept", "1 AS _rows", "2 AS base")


def test_stages_on_odd_rows(spark, odd):
    docs = odd
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs.count()
        docs = saved(stage(spark, docs, FOLDER), name)
        assert docs.columns == odd.columns and 0 < docs.count() <= before
        assert docs.filter("_text <> 7 OR kept <> 'x' OR _rows <> 1 OR base <> 2").count() == 0
        if name == "near_dedup":
            seen = docs.filter("doc_id IS NOT NULL").groupBy("doc_id").count()
            assert seen.filter("count > 1").count() == 0
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert pieces.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()


def test_stages_on_an_empty_table(spark, steps):
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, steps[0].limit(0), FOLDER)
        assert out.count() == 0 and (name == "pack" or out.columns == steps[0].columns)
