"""Text clean-up, tokens and chat routing."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from . import words as W
from .scalars import as_col, contains_any, default, hit_count, squash_ws

WORD = r"[\p{L}\p{N}_]{2,}"
ENTITIES = {"&nbsp;": " ", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&amp;": "&"}


def clean_html(c) -> Column:
    """Visible text of a page: no scripts, styles, comments or tags, single spaces; null is empty."""
    text = default(c, "")
    for pattern in (r"(?is)<(script|style)\b.*?</\1\s*>", r"(?s)<!--.*?-->", r"(?s)<[^>]*>"):
        text = F.regexp_replace(text, pattern, " ")
    for entity, char in ENTITIES.items():
        text = F.replace(text, F.lit(entity), F.lit(char))
    return squash_ws(text)


def terms(c) -> Column:
    """Lower-case words of two or more letters, digits or underscores, in order."""
    return F.regexp_extract_all(F.lower(default(c, "")), F.lit(WORD), F.lit(0))


def with_bigrams(words: Column) -> Column:
    """The words followed by the pairs of neighbours."""
    pairs = F.zip_with(
        F.slice(words, F.lit(1), F.greatest(F.size(words) - 1, F.lit(0))),
        F.slice(words, F.lit(2), F.greatest(F.size(words) - 1, F.lit(0))),
        lambda a, b: F.concat_ws(" ", a, b),
    )
    return F.concat(words, pairs)


def article_body(body, title) -> Column:
    """Body, else title, else empty: the first that is not blank."""
    return F.coalesce(F.nullif(as_col(body), F.lit("")), F.nullif(as_col(title), F.lit("")), F.lit(""))


def utterance(c) -> Column:
    return squash_ws(F.lower(default(c, "")))


def audience(text, forced_distributor: Column | None = None) -> Column:
    t = as_col(text)
    inv, dist = hit_count(t, W.INVESTOR_TERMS), hit_count(t, W.DISTRIBUTOR_TERMS)
    found = F.when(dist > inv, "distributor").when(inv > dist, "investor").otherwise("both")
    if forced_distributor is None:
        return found
    return F.when(forced_distributor, "distributor").otherwise(found)


def intent(text) -> Column:
    expr = F
    for name, keys in W.INTENTS:
        expr = expr.when(contains_any(text, keys), F.lit(name))
    return expr.otherwise("general")


def asks_about_screen(text) -> Column:
    return contains_any(text, W.SCREEN_TERMS)
