"""Lookups, merges, matching and correlation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import words as W
from ..functions.scalars import round_even
from ..session import shuffle_width


def with_market(df: DataFrame, market: DataFrame, on: str | None = None, name: str = "market") -> DataFrame:
    """Each row with its market snapshot: the single current one as a scalar, or the one with the same key."""
    packed = market.select(*([on] if on else []), F.struct(*[c for c in market.columns if c != on]).alias(name))
    if on:
        return df.join(packed, on, "left")
    return df.withColumn(name, packed.limit(1).scalar())


def investor_profiles(users: DataFrame, spend: DataFrame) -> DataFrame:
    return (
        users.join(spend, users["id"] == spend["client_id"], "left").drop("client_id")
        .fillna({"behavior_spend_sum": 0.0, "behavior_spend_count": 0})
    )


def lookup(df: DataFrame, dim: DataFrame, on: str, defaults: dict | None = None) -> DataFrame:
    """Left join with a dimension, with defaults on a miss. Spark broadcasts the dimension only if it is small."""
    out = df.join(dim, on, "left")
    return out.fillna(defaults) if defaults else out


def spread_lookup(df: DataFrame, dim: DataFrame, on: str, salts: int = 16) -> DataFrame:
    """Left join with a table of one row per value of ``on``, each value spread over ``salts`` tasks; columns stay in order.

    For columns where one value may hold a large part of all rows: the table is copied ``salts`` times, the rows are not.
    """
    copies = dim.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns], F.monotonically_increasing_id()), F.lit(salts)).cast("int"))
    extra = [c for c in dim.columns if c != on]
    return salted.join(copies, [on, "_salt"], "left").select(*[F.col(f"`{c}`") for c in [*df.columns, *extra]])


def exclude(df: DataFrame, seen: DataFrame, keys: list[str]) -> DataFrame:
    return df.join(seen.select(*keys), keys, "left_anti")


def fetch_ids(df: DataFrame, ids: DataFrame | list, key: str) -> DataFrame:
    """Rows with a requested id, given as a short list or as a table."""
    if isinstance(ids, list):
        return df.filter(F.col(key).isin(ids))
    return df.join(ids.select(key), key, "left_semi")


#: Rows of a list that is joined in place of its rows.
LIST = 4096

NEW_LEAD = {"status": "New", "notes": "", "assignee": "", "next_step_at": ""}


def upsert(base: DataFrame, updates: DataFrame, key: str = "lead_id", defaults: dict | None = None) -> DataFrame:
    """Non-null update cells replace those of an existing key; a new key starts from the defaults.

    A new row's ``name`` comes from first and last name when the updates carry one of them, else stays as given, else
    ``Lead <key>``.
    """
    defaults = NEW_LEAD if defaults is None else defaults
    cols = list(dict.fromkeys([*base.columns, *updates.columns, *defaults]))
    b = base.select(key, F.struct(*base.columns).alias("b"))
    u = updates.select(key, F.struct(*updates.columns).alias("u"))
    both = b.join(u, key, "full_outer")

    def cell(c: str) -> Column:
        if c == key:
            return F.col(key)
        parts = [F.col(f"u.`{c}`")] if c in updates.columns else []
        parts += [F.col(f"b.`{c}`")] if c in base.columns else []
        out = F.coalesce(*parts) if parts else F.lit(None).cast("string")
        if c in defaults:
            out = F.when(F.col("b").isNull(), F.coalesce(out, F.lit(defaults[c]))).otherwise(out)
        return out.alias(c)

    out = both.select(F.col("b").isNull().alias("_new"), *[cell(c) for c in cols])
    if "name" in cols:
        given = [c for c in ("first_name", "last_name") if c in updates.columns]
        name = F.coalesce("name", F.concat(F.lit("Lead "), F.col(key).cast("string")))
        if given:
            full = F.trim(F.concat_ws(" ", *[F.coalesce(F.col(c), F.lit("")) for c in given]))
            named = F.greatest(*[F.col(c).isNotNull() for c in given]) if len(given) > 1 else F.col(given[0]).isNotNull()
            name = F.when(named, full).otherwise(name)
        out = out.withColumn("name", F.when(F.col("_new"), name).otherwise(F.col("name")))
    return out.drop("_new")


def override(base: DataFrame, custom: DataFrame, key: str) -> DataFrame:
    """Whole rows of ``custom`` replace those of the same key."""
    return base.join(custom.select(key), key, "left_anti").unionByName(custom, allowMissingColumns=True)


def match_distributors(
    investors: DataFrame, key: str, matched: str = "distributor", fund_type: str = "fund_type", n: int = 5,
    fallback: list[tuple] = W.FALLBACK_DISTRIBUTORS,
) -> DataFrame:
    """The matched distributor first, then the standing list without it at a lower score; ``n`` in all."""
    item = lambda name, score, fund: F.struct(
        name.alias("distributor_name"), score.cast("double").alias("match_score"), fund.alias("offered_fund_type"))
    hit = F.col(matched).isNotNull()
    first = F.when(hit, F.array(item(F.col(matched), F.lit(0.98), F.col(fund_type))))
    standing = F.array(*[item(F.lit(d), F.lit(s), F.lit(t)) for d, s, t in fallback])
    rest = F.transform(
        F.filter(standing, lambda d: ~F.coalesce(d["distributor_name"] == F.col(matched), F.lit(False))),
        lambda d: item(d["distributor_name"],
                       F.when(hit, round_even(d["match_score"] - 0.05, 2)).otherwise(d["match_score"]),
                       d["offered_fund_type"]),
    )
    offers = F.slice(F.concat(F.coalesce(first, F.slice(standing, 1, 0)), rest), 1, n)
    return investors.select(key, F.posexplode(offers).alias("pos", "o")).select(
        key, (F.col("pos") + 1).alias("rank"), "o.*")


def distributors_for(investors: DataFrame, distributors: DataFrame, persona: str = "persona") -> DataFrame:
    """Distributors of the investor's own persona (95) and balanced ones (75): an equi-join on the wanted personas.

    The result is far larger than both tables. So investors are dealt over four tasks for each of a shuffle's, where a
    small file would be one, and a persona's distributors are joined as a few lists of about ``LIST`` rows.
    """
    wanted = investors.repartition(4 * shuffle_width(investors.sparkSession)).withColumn(
        "_want", F.explode(F.array_distinct(F.array(F.col(persona), F.lit("balanced")))))
    d = distributors.withColumnRenamed(persona, "_want")
    others = [f"`{c}`" for c in d.columns if c != "_want"]
    lists = d.agg(F.ceil(F.count("*") / LIST)).scalar()
    part = F.pmod(F.xxhash64(*others) if others else F.lit(0), F.greatest(F.col("_lists"), F.lit(1)))
    packed = d.withColumn("_lists", lists).groupBy("_want", part.alias("_part")).agg(F.collect_list(F.struct(*others)).alias("_d")).drop("_part")
    return (
        wanted.join(packed, "_want").select(*[f"`{c}`" for c in wanted.columns], F.inline("_d"))
        .withColumn("match_score", F.when(F.col("_want") == F.col(persona), 95).otherwise(75))
        .withColumnRenamed("_want", "distributor_persona")
    )


def pair_corr(a: DataFrame, b: DataFrame, on: list[str], x: str, y: str, by: list[str] = ()) -> DataFrame:
    """Correlation of two series aligned on their common dates."""
    return a.join(b, on).groupBy(*by).agg(F.count("*").alias("n"), F.corr(x, y).alias("corr"))
