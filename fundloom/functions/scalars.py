"""Scalar helpers: numbers, currency, dates, hashes, arrays, maps and JSON."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F, types as T


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---- numbers -------------------------------------------------------------------------------

def to_number(c, fill: float | None = None) -> Column:
    """Text to double; what does not parse becomes null, or ``fill``."""
    out = as_col(c).try_cast("double")
    return out if fill is None else F.coalesce(out, F.lit(float(fill)))


def clean_currency(c) -> Column:
    """``"$1,234.50"`` to 1234.5."""
    return F.regexp_replace(as_col(c).cast("string"), "[$,]", "").try_cast("double")


def parse_investment_amount(c) -> Column:
    """Rupee text (``45L``, ``2.5 Cr``, ``10k``, bare) to a number of rupees.

    Blank text, text without digits and the number 0 (not its text) count as five lakh; a bare number below 1000 is in
    lakhs.
    """
    zero = (F.typeof(as_col(c)) != "string") & (as_col(c).cast("string").try_cast("double") == 0)
    text = F.lower(F.regexp_replace(as_col(c).cast("string"), "[ ,]", ""))
    number = F.regexp_extract(text, r"(\d+\.?\d*)", 1).try_cast("double")
    return (
        F.when(number.isNull() | zero, F.lit(500_000.0))
        .when(text.contains("cr"), number * 1e7)
        .when(text.contains("l"), number * 1e5)
        .when(text.contains("k"), number * 1e3)
        .when(number < 1000, number * 1e5)
        .otherwise(number)
    )


def parse_amount(c) -> Column:
    """First run of digits and dots once commas are gone; 0 when there is none or it is no number."""
    text = F.regexp_replace(as_col(c).cast("string"), ",", "")
    return F.coalesce(F.regexp_extract(text, r"([0-9.]+)", 1).try_cast("double"), F.lit(0.0))


def to_float0(c) -> Column:
    """Number with thousands commas; null, ``''``, ``'-'`` and junk are 0."""
    text = F.trim(F.regexp_replace(as_col(c).cast("string"), ",", ""))
    return F.coalesce(text.try_cast("double"), F.lit(0.0))


def launch_year(c) -> Column:
    """Leading four characters as a year, null when they are not one."""
    text = as_col(c).cast("string")
    return F.when(F.length(text) >= 4, F.substring(text, 1, 4).try_cast("int"))


def clamp(c, lo: float, hi: float) -> Column:
    """Nulls stay null (``least``/``greatest`` alone would skip them)."""
    c = as_col(c)
    return F.when(c.isNotNull(), F.greatest(F.lit(float(lo)), F.least(c, F.lit(float(hi)))))


def round_even(c, digits: int) -> Column:
    """Half-to-even rounding; noise in the last bits (below 1e-9) does not decide a tie."""
    return F.bround(F.round(as_col(c), 9), digits)


def safe_div(a, b, default: float | None = None) -> Column:
    out = F.try_divide(as_col(a), as_col(b))
    return out if default is None else F.coalesce(out, F.lit(float(default)))


def default(c, value) -> Column:
    return F.coalesce(as_col(c), F.lit(value))


def nan_to_null(c) -> Column:
    c = as_col(c)
    return F.when(~F.isnan(c), c)


# ---- text ----------------------------------------------------------------------------------

def squash_ws(c) -> Column:
    return F.trim(F.regexp_replace(as_col(c), r"\s+", " "))


def clean_text(c) -> Column:
    """Lower case, single spaces, trimmed; null counts as empty."""
    return squash_ws(F.lower(default(c, "")))


def contains_any(c, words: list[str]) -> Column:
    """True when any of the words occurs as a substring."""
    c = as_col(c)
    return reduce(lambda a, b: a | b, [c.contains(w) for w in words], F.lit(False))


def hit_count(c, words: list[str]) -> Column:
    """How many of the words occur as substrings, each counted once."""
    c = as_col(c)
    return reduce(lambda a, b: a + b, [c.contains(w).cast("int") for w in words], F.lit(0))


def first_number(c) -> Column:
    return F.regexp_extract(as_col(c), r"(\d+\.?\d*)", 1).try_cast("double")


def tokens(c, min_len: int = 1) -> Column:
    """Lower-case alphanumeric runs of at least ``min_len`` characters."""
    parts = F.split(F.lower(as_col(c)), "[^a-z0-9]+")
    return F.filter(parts, lambda t: F.length(t) >= min_len)


def safe_name(c, width: int = 50) -> Column:
    """A title as a file name: odd characters dropped, cut to ``width``, spaces to underscores."""
    kept = F.regexp_replace(as_col(c), r"(?U)[^\w\s-]", "")
    return F.regexp_replace(F.substring(kept, 1, width), " ", "_")


# ---- hashes --------------------------------------------------------------------------------

def _joined(cols, sep: str) -> Column:
    return F.concat_ws(sep, *[F.coalesce(as_col(c).cast("string"), F.lit("")) for c in cols])


def row_md5(cols, sep: str = "_") -> Column:
    return F.md5(_joined(cols, sep))


def signature(cols) -> Column:
    """SHA-1 over ``|``-joined fields, missing ones as empty text."""
    return F.sha1(_joined(cols, "|"))


# ---- dates ---------------------------------------------------------------------------------

DATE_FORMATS = ("yyyy-MM-dd", "dd-MM-yyyy", "dd-MMM-yyyy")


def parse_date(c, formats=DATE_FORMATS) -> Column:
    return F.coalesce(*[F.try_to_timestamp(as_col(c), F.lit(f)).cast("date") for f in formats])


def parse_ts(c, formats=("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", *DATE_FORMATS)) -> Column:
    return F.coalesce(*[F.try_to_timestamp(as_col(c), F.lit(f)) for f in formats])


def epoch_ts(c, unit: str = "s") -> Column:
    """Time stamp of an epoch number in seconds (``s``) or milliseconds (``ms``)."""
    n = as_col(c).cast("bigint")
    return {"s": F.timestamp_seconds, "ms": F.timestamp_millis}[unit](n)


def minute_of_day(c) -> Column:
    c = as_col(c)
    return F.hour(c) * 60 + F.minute(c)


# ---- arrays and maps -----------------------------------------------------------------------

def any_in(arr, values: list) -> Column:
    return F.arrays_overlap(as_col(arr), F.array(*[F.lit(v) for v in values]))


def first_n(arr, n: int) -> Column:
    return F.slice(as_col(arr), 1, n)


def keep(*conditional: Column) -> Column:
    """Array of the given columns without the nulls, in order."""
    return F.array_compact(F.array(*conditional))


def top_entries(m, n: int, by: str = "abs") -> Column:
    """The ``n`` map entries largest by absolute value, highest or lowest value; ties by key order."""
    rank = {"abs": lambda v: -F.abs(v), "high": lambda v: -v, "low": lambda v: v}[by]
    entries = F.transform(
        F.map_entries(as_col(m)),
        lambda e: F.struct(rank(e["value"]).alias("rank"), e["key"].alias("key"), e["value"].alias("value")),
    )
    return F.transform(
        F.slice(F.array_sort(entries), 1, n), lambda e: F.struct(e["key"].alias("key"), e["value"].alias("value"))
    )


# ---- JSON ----------------------------------------------------------------------------------

def parse_json(c, schema: T.StructType | str) -> Column:
    """Permissive parse: text that is not JSON gives a null struct field by field."""
    return F.from_json(as_col(c), schema)


def bad_json(c) -> Column:
    """True for text that does not parse at all (for a quarantine filter)."""
    c = as_col(c)
    return c.isNotNull() & F.try_parse_json(c).isNull()
