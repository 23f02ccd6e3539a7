"""Candidates that reach beyond a base span are scored too, so no part of an address stays."""

import random

import pytest

from fundloom.llm import pii


@pytest.fixture(scope="module")
def model(spark):
    rng = random.Random(4)
    number = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    texts = [[f"write to {number(3)}ab@mail{i}.example.com now", f"mail bob.smith{i}@firma.de today", f"call +1 ({number(3)}) 555-{number(4)} today",
              f"host {i % 250}.{i % 199}.7.9 is up"][i % 4] for i in range(400)]
    return pii.fit(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), sample=300)


def test_addresses_with_letters_beyond_ascii_go_whole(spark, model):
    texts = ["Schreiben Sie an jürgen.müller@firma.de bitte", "Mail an info@sub.münchen.de heute", "mail bob.smith@firma.de now", "mail bob.smith@firma.de."]
    found = pii.find(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model)
    got = {r.doc_id: r.t for r in found.select("doc_id", pii.redacted().alias("t")).collect()}
    assert got == {0: "Schreiben Sie an [EMAIL] bitte", 1: "Mail an [EMAIL] heute", 2: "mail [EMAIL] now", 3: "mail [EMAIL]."}
    spans = {r.doc_id: r for r in found.collect()}
    # the base span is still listed, and a span that is a base span is listed once
    assert [s.text for s in spans[0].base] == ["ller@firma.de"] and "jürgen.müller@firma.de" in [s.text for s in spans[0].spans]
    assert [s.text for s in spans[2].spans] == ["bob.smith@firma.de"]
