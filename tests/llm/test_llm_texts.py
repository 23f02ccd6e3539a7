"""Chat formatting, personal data, quality scores and mixing against plain versions."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from fundloom.llm import chat, mixing, pii, quality

# ---- chat ------------------------------------------------------------------------------------


def test_template_reads_back():
    t = chat.Template()
    rng = random.Random(2)
    for _ in range(300):
        role, text = ("".join(rng.choice("\\#<: \n/ab") for _ in range(rng.randint(0, 12))) for _ in range(2))
        whole, start, end = t.turn(role, text)
        assert t.parse(whole) == (role, text) and t.plain(whole[start:end]) == text
        assert not re.search(r"(?<!\\)(?:\\\\)*[<#]", whole[start:end])


def walked(turns):
    """The machine by hand."""
    t, state, ok = chat.Template(), "start", []
    for role in turns:
        state, fine = t.step(state, role)
        ok.append(fine)
    return ok


@pytest.mark.parametrize("width", [1, 40])
def test_turns_and_digests(spark, monkeypatch, width):
    monkeypatch.setattr(chat, "shuffle_width", lambda _: width)
    rng = random.Random(5)
    rows = []
    for c in [*range(12), None]:
        for n in range(300 if c == 3 else rng.randint(1, 6)):
            rows.append((c, n, rng.choice(["user", "assistant", "system", "tool", "bot", None]) if c != 4 else ["user", "assistant"][n % 2],
                         rng.choice([None, "", "### x </turn>\n", "plain", "\\"]), c))
    rows += [(1, 0, "user", "tie", 1), (1, 0, "user", "tie", 1)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, allowed long")
    turns = chat.format_turns(df)
    assert turns.count() == len(rows)
    got = {r.conv_id: r for r in chat.digests(turns).collect()}
    order = {}
    for c, role in ((r.conv_id, r.role) for r in turns.orderBy("part", "pos").collect()):
        order.setdefault(c, []).append(role)
    flags = {}
    for r in turns.orderBy("part", "pos").collect():
        flags.setdefault(r.conv_id, []).append(r.allowed)
    for c in [*range(12), None]:
        mine = [("" if r is None else r, "" if t is None else t) for k, n, r, t, _ in rows if k == c]
        assert sorted(order[c]) == sorted(r for r, _ in mine)
        assert flags[c] == walked(order[c]) and got[c].valid == all(flags[c])
        if c != 1:
            assert order[c] == [r for r, _ in mine]
            assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in mine).encode()).hexdigest()
            learned = "".join(t for r, t in mine if r == "assistant")
            assert (got[c].loss_chars, got[c].loss_sha256) == (len(learned), hashlib.sha256(learned.encode()).hexdigest())
        assert got[c].n_turns == len(mine)
    assert chat.digests(chat.format_turns(df.limit(0))).count() == 0


# ---- personal data ---------------------------------------------------------------------------

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0


def plain_spans(text):
    out = []
    for at, kind in enumerate(pii.KINDS):
        for m in re.finditer(PLAIN[kind], text):
            d = re.sub("[^0-9]", "", m[0])
            if kind == "email" or kind == "ip" and all(int(o) <= 255 for o in m[0].split(".")) or kind == "card" and 12 <= len(d) <= 19 and luhn(d) or kind == "phone" and 9 <= len(d) <= 15:
                out.append((m.start(), at, kind, m.end(), m[0]))
    return [(k, s, e, t) for s, _, k, e, t in sorted(out)]


def noise(rng):
    some = ["a@b.co", "a@b", "@", "x.y+z@q-r.example.com", "+1 (988) 555-2485", "4111 1111 1111 1111", "4111111111111112", "1.2.3.4.5.6.7.8", "999.1.1.1", "é", "😀", " ", ".", "+", "-", "(", "12", "7",
            "00000000000000000000000000000000255.1.1.1", "b@c.d+e@f.g", "\n", "4984250489669609", "0", " - ", ". ", "+1 - 2 - 3 - 4 - 5 - 6 - 7 - 8 - 9", "+4 (5"]
    return "".join(rng.choice(some) for _ in range(rng.randint(0, 40)))


def test_base_spans_match_plain_search(spark, few, none):
    rng = random.Random(8)
    texts = [noise(rng) for _ in range(400)] + ["1" * 30_000 + "a@" * 2000, "a@b.c " * 3000, "", "a@b.c", "1 " * 20_000]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: [tuple(s) for s in r.base] for r in pii.base_spans(df).collect()}
    for i, t in enumerate(texts):
        assert got[i] == plain_spans(t), t[:200]
    assert pii.find(none.select("doc_id", "text"), pii.fit(none)).count() == 0


def test_phones_with_wide_gaps(spark):
    texts = ["call +1 - 2 - 3 - 4 - 5 - 6 - 7 - 8 - 9 now", "+1" + " " * 40 + "23456789", "+1 - 2 - 3", "1 - 2 - 3 - 4 - 5 - 6 - 7 - 8 - 9"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: [tuple(s) for s in r.base] for r in pii.base_spans(df).collect()} == {i: plain_spans(t) for i, t in enumerate(texts)}
    assert [len(plain_spans(t)) for t in texts] == [1, 1, 0, 0]


def test_columns_of_a_table_stay(spark):
    df = spark.sql("SELECT 1L AS doc_id, 'mail a@b.co' AS text, 7 AS _email, 'x' AS _row, 2 AS _text, 3 AS `a b`, 'old' AS spans, 'h' AS _hits, 5 AS n_chars")
    out = pii.find(df, pii.PiiModel(None, 2.0))
    assert out.columns == ["doc_id", "text", "_email", "_row", "_text", "a b", "_hits", "n_chars", "base", "spans"]
    r = out.first()
    assert (r._email, r._row, r._text, r["a b"], r._hits, r.spans[0].text) == (7, "x", 2, 3, "h", "a@b.co")
    red = pii.redact(df)
    assert red.columns == df.columns and red.first().text == "mail [EMAIL]" and red.first().spans == "old" and red.first()._text == 2


def test_sample_is_the_same_at_every_share(spark):
    df = spark.range(3000).selectExpr("id AS doc_id", "if(id % 50 = 0, concat('mail a', id, '@b.co and c@d.ef'), 'nothing') AS text")
    found = sorted(tuple(r) for r in pii._sampled(df, 20, 1).select("h", F.size("near")).collect())
    every = pii._sampled(df, 60, 64).select("h", F.size("near")).collect()
    low = sorted(every, key=lambda r: r[0])[:20]
    assert found == sorted((r[0], 1) for r in low) and all(r[1] == 2 for r in every) and len(every) == 60


def test_model_adds_and_leaves_alone(spark):
    rng = random.Random(4)
    number = lambda n: "".join(rng.choice("0123456789") for _ in range(n))

    def card():
        d = "4" + number(14)
        return next(d + c for c in "0123456789" if luhn(d + c))

    texts = []
    for i in range(300):
        texts.append([f"write to {number(3)}ab@mail{i}.example.com now", f"call +1 ({number(3)}) 555-{number(4)} today", f"card {card()} is mine", f"host {i % 250}.{i % 199}.7.9 is up"][i % 4])
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model = pii.fit(df, sample=200)
    assert model.expression
    hidden = card()
    others = [(1000, f"pay {hidden[:4]}.{hidden[4:8]}.{hidden[8:12]}.{hidden[12:]} soon"), (1001, "call (988) 555-2485 today"), (1002, "on 2021-03-04 12:30 we met"),
              (1003, "version 2.14 of 1234567 items"), (1004, "nothing here"), (1005, None), (1006, "")]
    got = {r.doc_id: r for r in pii.find(spark.createDataFrame(others, "doc_id long, text string"), model).collect()}
    assert any(s.kind == "card" and s.start == 4 for s in got[1000].spans)
    assert all(not got[k].spans for k in (1002, 1003, 1004, 1005, 1006)) and all(not got[k].base for k in (1000, 1001))
    found = {r.doc_id: r for r in pii.find(df, model).collect()}
    assert all({tuple(s) for s in r.base} <= {tuple(s) for s in r.spans} and len(r.base) == 1 for r in found.values())


def test_redaction(few, none):
    out = {r.doc_id: r for r in pii.redact(few.filter("doc_id IS NOT NULL")).collect()}
    assert pii.redact(few).columns == few.columns and pii.redact(few).count() == few.count()
    assert out[11].text == "Mail [EMAIL] or call [PHONE] from [IP] card [CARD]." and out[11].n_chars == len(out[11].text)
    assert out[5].text is None and out[6].text == "" and out[7].text == few.filter("doc_id = 7").first().text
    assert pii.redact(none).count() == 0


def test_overlapping_spans_are_replaced_once(spark):
    df = spark.sql("SELECT '0123456789' AS text, array(named_struct('kind', 'ip', 'start', 1L, 'end', 4L), named_struct('kind', 'card', 'start', 2L, 'end', 6L), "
                   "named_struct('kind', 'card', 'start', 3L, 'end', 4L), named_struct('kind', 'phone', 'start', 8L, 'end', 10L)) AS spans")
    assert df.select(pii.redacted().alias("t")).first().t == "0[IP]67[PHONE]"


# ---- quality ---------------------------------------------------------------------------------

def test_scores_rank_held_out_rows(spark, tables, folder):
    docs, labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    scored = {r.doc_id: r.p for r in quality.score(docs, quality.fit(docs, labels), "p").collect()}
    held = [(scored[r.doc_id], r.quality) for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    good, bad = [p for p, y in held if y], [p for p, y in held if not y]
    assert all(0 <= p <= 1 for p in scored.values())
    assert np.mean([[a > b for b in bad] for a in good]) > 0.95
    # labels of held-out rows never reach the model
    turned = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    again = {r.doc_id: r.p for r in quality.score(docs, quality.fit(docs, turned), "p").collect()}
    assert max(abs(again[k] - scored[k]) for k in scored) < 1e-9


def test_quality_of_odd_rows(spark, few, none):
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 0), (3, 0, 0), (4, None, None), (7, 0, 0), (None, 1, 1), (8, 0, 0), (8, 1, 0), (11, 1, 0)], "doc_id long, quality int, toxic int")
    out = quality.score(few, quality.fit(few, labels), "p")
    assert out.columns == [*few.columns, "p"] and out.count() == few.count() and out.filter("p IS NULL").count() == 0
    kept = quality.keep_good(few, labels)
    assert kept.columns == few.columns
    assert {r.p for r in quality.score(few, quality.fit(few, labels.limit(0)), "p").collect()} == {0.5}
    assert quality.keep_good(none, labels).count() == 0 and quality.keep_good(few, labels.limit(0)).count() == few.count()


def test_a_text_is_pooled_alike_however_it_is_cut(monkeypatch):
    rng = np.random.default_rng(2)
    vectors = rng.normal(size=(quality.BUCKETS, quality.DIMS)).astype(np.float32)
    text = " ".join(f"Word{i % 91}, it's {i}!" for i in range(3000))
    whole = quality._pooled(text, vectors, {})
    monkeypatch.setattr(quality, "PART", 1000)
    parts = quality._pooled(text, vectors, {})
    keep = [*range(2 * quality.DIMS), -1]
    assert np.allclose(whole[keep], parts[keep], atol=1e-3) and np.isfinite(quality._pooled("", vectors, {})).all()


# ---- mixing ----------------------------------------------------------------------------------

def test_rake_meets_margins():
    rng = np.random.default_rng(6)
    have = rng.integers(1, 1000, (5, 4, 3)).astype(float)
    targets = [rng.dirichlet(np.ones(n)) for n in have.shape]
    out = mixing.rake(have, targets)
    for k, t in enumerate(targets):
        assert np.allclose(out.sum(axis=tuple(a for a in range(3) if a != k)), t, atol=1e-8)
    # the inner structure stays: odds ratios are those of the counts
    odds = lambda m: m[0, 0, 0] * m[1, 1, 0] / (m[0, 1, 0] * m[1, 0, 0])
    assert np.isclose(odds(out), odds(have))
    have[:, 2] = 0
    out = mixing.rake(have, targets)
    t = targets[1].copy()
    t[2] = 0
    assert np.allclose(out.sum(axis=(0, 2)), t / t.sum(), atol=1e-8) and mixing.rake(have * 0, targets).sum() == 0


def test_probabilities_spend_the_budget():
    have, weights = np.array([100.0, 50, 10, 0]), np.array([0.1, 0.4, 0.5, 0])
    for keep in (0.05, 0.3, 0.9, 1.0):
        p = mixing.probabilities(have, weights, keep)
        assert (p <= 1).all() and np.isclose((p * have).sum(), keep * have.sum()) and p[3] == 0
    assert np.allclose(mixing.probabilities(have, weights, 0.05)[:2], 8 * np.array([0.001, 0.008]))


def test_mix(spark, few, none):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = mixing.mix(docs, keep=0.6)
    rows = out.collect()
    total = docs.agg(F.sum(mixing.words_of(F.col("text")))).first()[0]
    assert abs(sum(r.n_tokens for r in rows) / total - 0.6) < 0.08
    cells = {(r.source, r.lang, r.topic): r.probability for r in rows}
    assert all(0 < p <= 1 for p in cells.values())
    again = {r.doc_id for r in mixing.mix(docs.repartition(5), keep=0.6).collect()}
    assert again == {r.doc_id for r in rows}
    plain = mixing.mix(few, keep=1.0, details=False)
    assert plain.columns == few.columns and plain.count() == few.count()
    assert mixing.mix(none).count() == 0 and {"topic", "n_tokens", "weight", "probability"} <= set(mixing.mix(few).columns)
