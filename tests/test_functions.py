import datetime as dt

import pytest
from pyspark.sql import functions as F

from fundloom.functions import rules as R, scalars as S, text as X, vectors as V, words as W


def one(spark, col, **values):
    types = {str: "string", int: "bigint", float: "double", bool: "boolean", type(None): "double", dt.datetime: "timestamp"}
    schema = ", ".join(f"{k} {types[type(v)]}" for k, v in values.items()) or "x int"
    row = tuple(values.values()) or (1,)
    return spark.createDataFrame([row], schema).select(col.alias("v")).first()["v"]


@pytest.mark.parametrize("text,want", [
    ("₹45L", 4_500_000.0), ("2.5 Cr", 25_000_000.0), ("10k", 10_000.0), ("12", 1_200_000.0), ("1,500", 1500.0), ("", 500_000.0), ("none", 500_000.0),
    ("5 lakh", 500_000.0)])
def test_investment(spark, text, want):
    assert one(spark, S.parse_investment_amount("t"), t=text) == want


@pytest.mark.parametrize("text,want", [("$1,234.50", 1234.5), ("12", 12.0), ("abc", None), ("", None)])
def test_currency(spark, text, want):
    assert one(spark, S.clean_currency("t"), t=text) == want


@pytest.mark.parametrize("text,amount,number", [("Rs 1,000 min", 1000.0, 0.0), ("-", 0.0, 0.0), ("12.5", 12.5, 12.5), ("1.2.3", 0.0, 0.0), (" 3,000 ", 3000.0, 3000.0)])
def test_amounts(spark, text, amount, number):
    assert one(spark, S.parse_amount("t"), t=text) == amount
    assert one(spark, S.to_float0("t"), t=text) == number


@pytest.mark.parametrize("p,strict,inclusive", [(0.85, "warm", "hot"), (0.8501, "hot", "hot"), (0.65, "cold", "warm"), (0.2, "cold", "cold")])
def test_tier_boundaries(spark, p, strict, inclusive):
    assert one(spark, R.lead_tier("p"), p=p) == strict
    assert one(spark, R.lead_tier("p", "inclusive"), p=p) == inclusive


def test_unknown_tier():
    with pytest.raises(ValueError):
        R.lead_tier("p", "other")


@pytest.mark.parametrize("s,opened,binned", [(50.0, "Medium", "High"), (20.0, "Low", "Medium"), (10.0, "Low", "Low"), (30.0, "Medium", "Medium"), (None, "Low", None)])
def test_engagement(spark, s, opened, binned):
    assert one(spark, R.engagement_tier("s"), s=s) == opened
    assert one(spark, R.engagement_tier("s", "binned"), s=s) == binned


@pytest.mark.parametrize("v,want", [(-1.0, None), (0.0, "New"), (5.0, "Active"), (15.0, "Engaged"), (16.0, "Hot"), (None, None)])
def test_age_bin(spark, v, want):
    assert one(spark, R.lead_age_bin("v0"), v0=v) == want


def test_zero_division_guards(spark):
    assert one(spark, R.engagement_velocity("p", "t"), p=3.0, t=0.0) == 0
    assert one(spark, R.debt_to_income("d", "i"), d=50.0, i=0.0) == 50
    assert one(spark, R.sip_future_value("m", "r", "y"), m=100.0, r=0.0, y=1.0) == 1200
    assert one(spark, S.safe_div("a", "b"), a=1.0, b=0.0) is None


def test_sip(spark):
    r = 0.01
    assert one(spark, R.sip_future_value("m", "r", "y"), m=5000.0, r=12.0, y=10.0) == pytest.approx(5000 * ((1 + r) ** 120 - 1) / r * (1 + r))


@pytest.mark.parametrize("c,want,label", [(6.0, 99.7, "Very Bullish"), (1.5, 85.0, "Bullish"), (0.5, 40.0, "Neutral"), (-2.0, -87.1, "Highly Bearish"), (-1.0, -62.5, "Bearish")])
def test_market_score(spark, c, want, label):
    assert one(spark, R.sentiment_score("c"), c=c) == want
    assert one(spark, R.sentiment_band("c"), c=c) == label


@pytest.mark.parametrize("at,is_open", [((2024, 1, 1, 3, 45), True), ((2024, 1, 1, 3, 44), False), ((2024, 1, 1, 10, 0), True), ((2024, 1, 1, 10, 1), False), ((2024, 1, 6, 5, 0), False)])
def test_market_hours(spark, at, is_open):
    ts = dt.datetime(*at, tzinfo=dt.timezone.utc)
    assert one(spark, R.market_open("ts"), ts=ts) is is_open


@pytest.mark.parametrize("s,i,c,want", [("positive", None, "0.5", 0.5), ("negative", "bearish", "2", -1.0), ("up", "bullish", "junk", 0.625), (None, "critical", "0.1", -0.075), ("neutral", None, None, 0.0)])
def test_signal_score(spark, s, i, c, want):
    df = spark.createDataFrame([(s, i, c)], "s string, i string, c string")
    assert df.select(R.signal_score("s", "i", "c")).first()[0] == pytest.approx(want)


def test_lexicon_is_substring_based(spark):
    # "up" inside "support" counts
    assert one(spark, R.lexicon_label("t"), t="Support desk") == "positive"
    assert one(spark, R.lexicon_label("t"), t="") == "neutral"


@pytest.mark.parametrize("cat,group", [("Liquid index", "conservative"), ("Nifty ETF", "passive"), ("Multi Asset", "balanced"), ("Large & Mid", "growth"), (None, "balanced")])
def test_fund_groups(spark, cat, group):
    df = spark.createDataFrame([(cat,)], "c string")
    assert df.select(R.fund_group("c")).first()[0] == group


def test_html(spark):
    html = "<html><script>var a = '<b>';</script><style>x</style><!-- no --><p>One&nbsp;&amp;\n two</p><br/>three</html>"
    assert one(spark, X.clean_html("h"), h=html) == "One & two three"


def test_bigrams(spark):
    df = spark.createDataFrame([("Red Fox jumps a lot",), ("one",), ("",)], "t string")
    got = [r[0] for r in df.select(X.with_bigrams(X.terms("t"))).collect()]
    assert got == [["red", "fox", "jumps", "lot", "red fox", "fox jumps", "jumps lot"], ["one"], []]


def test_routing(spark):
    assert one(spark, X.audience("t"), t="tax and portfolio of a lead") == "investor"
    assert one(spark, X.audience("t"), t="lead and tax") == "both"
    assert one(spark, X.intent(F.col("t")), t="sebi risk") == "compliance"
    assert one(spark, X.intent(F.col("t")), t="nothing") == "general"


def test_arrays_maps_json(spark):
    df = spark.sql("SELECT map('a', 0.5D, 'b', -0.9D, 'c', 0.1D) AS m, array('x', 'y', 'z') AS a")
    assert [e["key"] for e in df.select(S.top_entries("m", 2)).first()[0]] == ["b", "a"]
    assert [e["key"] for e in df.select(S.top_entries("m", 1, "low")).first()[0]] == ["b"]
    assert df.select(S.any_in("a", ["q", "z"])).first()[0] is True
    assert df.select(S.first_n("a", 2)).first()[0] == ["x", "y"]
    assert one(spark, S.bad_json("t"), t="{oops") is True
    assert one(spark, S.bad_json("t"), t='{"a": 1}') is False


def test_hashes(spark):
    import hashlib
    df = spark.createDataFrame([("a", None)], "x string, y string")
    assert df.select(S.signature(["x", "y"])).first()[0] == hashlib.sha1(b"a|").hexdigest()
    assert df.select(S.row_md5(["x", "y"])).first()[0] == hashlib.md5(b"a_").hexdigest()


@pytest.mark.parametrize("text", ["2024-03-05", "05-03-2024", "05-Mar-2024"])
def test_dates(spark, text):
    assert one(spark, S.parse_date("t"), t=text) == dt.date(2024, 3, 5)


def test_bad_date(spark):
    assert one(spark, S.parse_date("t"), t="soon") is None


def test_vectors(spark):
    df = spark.sql("SELECT array(3f, 4f) AS a, array(0f, 0f) AS z")
    assert df.select(V.norm("a"), V.cosine("a", "a"), V.cosine("a", "z")).first() == (5.0, 1.0, 0.0)


def test_half_even(spark):
    assert one(spark, S.round_even("x", 0), x=2.5) == 2.0
    assert one(spark, S.round_even("x", 1), x=0.25) == 0.2


def test_fixed_values_are_consistent():
    assert set(W.PERSONA_MULTIPLIER) == set(W.PERSONA_LIMITS)
    assert set(W.CATEGORY_BETA) == set(W.CATEGORY_RISK)


def test_number_zero_is_no_amount_but_its_text_is(spark):
    df = spark.createDataFrame([(0, 0.0, "0")], "a int, b double, c string")
    assert df.select(*[S.parse_investment_amount(c) for c in "abc"]).first()[:] == (500_000.0, 500_000.0, 0.0)


def test_epoch_units(spark):
    df = spark.createDataFrame([(86_400, 86_400_000)], "s long, ms long")
    assert df.select(S.epoch_ts("s") == S.epoch_ts("ms", "ms")).first()[0]
