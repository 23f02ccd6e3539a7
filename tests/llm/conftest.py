import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, score double, _rows int"


@pytest.fixture(scope="session")
def few(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows and columns whose names clash with results."""
    long = " ".join(f"word{i % 977}x{i % 13}" for i in range(40_000))
    clean = "The quick brown fox jumps over the lazy dog while seven wizards quietly count their coins near the old stone bridge."
    rows = [
        (1, clean, "en", "src0"), (2, clean, "en", "src1"), (3, clean.upper(), "de", None), (4, clean + " Again and again.", "xx", "src0"),
        (5, None, None, None), (6, "", "en", "src0"), (7, long, "en", "src0"), (7, long, "en", "src0"), (8, "one two", "fr", "src5"),
        (9, "one two", "fr", "src5"), (None, clean, None, "src0"), (None, None, None, None), (10, " \t\n ", "es", "zzz"),
        (11, "Mail bob.smith@example.org or call +1 (988) 555-2485 from 10.20.30.40 card 4111 1111 1111 1111.", "en", "src2"),
    ]
    return spark.createDataFrame([(*r, None if r[1] is None else len(r[1]), None, 0.5, 3) for r in rows], DOCS)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS)
