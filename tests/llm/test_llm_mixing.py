"""The weights that are raked are the tokens that packing sees."""

from fundloom.llm import mixing
from fundloom.llm.tokens import encoder, word_bpe_path


def test_tokens_of_texts_without_spaces_count(spark):
    texts = {1: "今天天气很好我们去公园散步" * 40, 2: "one two three four", 3: "iVBORw0KGgoAAAANSUhEUgAA" * 50, 4: " \t\n ", 5: "", 6: None}
    docs = spark.createDataFrame([(k, t, "en", "src0") for k, t in texts.items()], "doc_id long, text string, lang string, source string")
    tokens = encoder(word_bpe_path())
    got = {r.doc_id: r.n_tokens for r in mixing.mix(docs, keep=1.0).collect()}
    assert got == {k: len(tokens.encode(t or "")) // tokens.width for k, t in texts.items()}
    assert got[1] > 100 and got[3] > 100 and got[4] == got[5] == got[6] == 0
    assert {r.doc_id for r in mixing.mix(docs, keep=0.5).collect()} == {r.doc_id for r in mixing.mix(docs, keep=0.5, details=False).collect()} >= {4, 5, 6}


def test_a_source_of_texts_without_spaces_does_not_swamp_the_mix(spark):
    rows = [(i, "src0", "lorem ipsum dolor sit amet " * 8) for i in range(400)] + [(1000 + i, "src1", "今天天气很好我们去公园散步" * 6) for i in range(400)]
    docs = spark.createDataFrame([(k, s, t, "en") for k, s, t in rows], "doc_id long, source string, text string, lang string")
    out = mixing.mix(docs, {"source": {"src0": 0.5, "src1": 0.5}}, keep=0.5).collect()
    of = lambda s: sum(r.n_tokens for r in out if r.source == s)
    assert abs(of("src1") / (of("src0") + of("src1")) - 0.5) < 0.08
