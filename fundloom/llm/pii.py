"""Personal data in texts: high-recall candidate spans, boosted trees over format and context, calibrated selection.

Everything is DataFrame and SQL functions. Spans of a text are arrays in its row, so nothing is shuffled; the trees are
fitted by Spark's own gradient boosting on a bounded table of candidates and then evaluated as a SQL expression.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from .common import saved, text_of

KINDS = ("email", "ip", "card", "phone")
#: What counts as personal data in any case. A match starts where a run of its characters starts or where
#: the match before it ended, and no part gives back what it took, so one pass over the text finds the same matches as
#: plain leftmost search.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Candidates by kind: wider patterns that also take what only looks alike.
WIDE = {
    "email": r"(?<![^\s<>(),;:\x22'])[^\s@<>(),;:\x22']++(?:@|\x20?[\[(](?:at|AT)[\])]\x20?)[^\s@<>(),;:\x22']++",
    "ip": r"(?<![A-Za-z0-9.:])[0-9]++(?:[.:][0-9]++)++(?![A-Za-z0-9])",
    "card": r"(?<![A-Za-z0-9])[0-9](?:[\x20./-]?[0-9]){11,18}+(?![A-Za-z0-9])",
    "phone": r"(?<![A-Za-z0-9])[+(]?[0-9](?:[\x20()./-]{0,2}[0-9]){6,14}+(?![A-Za-z0-9])",
}
#: Marks that are cut off the ends of a wide e-mail match, as it stands in a SQL string.
MARKS = r"[\\[\\]{}*|!?.`]"
#: A text that lacks this has no wide match of the kind, and no base match either but for phones, whose base pattern allows any gap.
NEEDS = {"email": r"@|[\[(](?:at|AT)[\])]", "ip": r"[0-9][.:][0-9]", "card": r"[0-9][\x20./-]?[0-9]", "phone": r"[0-9][\x20()./-]{0,2}[0-9]"}
BASE_NEEDS = {**NEEDS, "phone": r"\+[0-9]"}
#: Words near a span that speak for a kind, and how far before it they may stand.
WORDS = {
    "email": "mail|contact|write to|@", "ip": r"\bip\b|host|server|address|addr", "card": "card|visa|master|amex|credit|debit|karte|carte|tarjeta",
    "phone": r"phone|call|tel|mobile|fax|cell|\bfon\b",
}
CONTEXT = 32
FEATURES = ["is_email", "is_ip", "is_card", "is_phone", "chars", "digits", "letters", "groups", "longest", "plus", "bracket", "luhn", "octets", "dots", "seps",
            "tld", "odd_before", "odd_after", "said_kind", "said_other"]


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def running(array: str, block: int = 256) -> str:
    """SQL for the running sums of an array of long: within blocks, then over blocks, so that long arrays stay cheap."""
    inner = f"transform(sequence(0, cast(ceil(size({array}) / {block}.0) as int) - 1), k -> slice({array}, k * {block} + 1, {block}))"
    grow = "aggregate({}, array(0L), (s, v) -> concat(s, array(element_at(s, -1) + v)))"
    sums = f"transform({inner}, b -> slice({grow.format('b')}, 2, size(b)))"
    whole = f"zip_with(p, slice({grow.format('transform(p, x -> element_at(x, -1))')}, 1, size(p)), (q, o) -> transform(q, v -> v + o))"
    return f"if(size({array}) = 0, cast(array() as array<bigint>), element_at(transform(array({sums}), p -> flatten({whole})), 1))"


def _matches(df: DataFrame, text: str, kind: str, pattern: str, needs: str, out: str) -> DataFrame:
    """Adds ``out``: kind, start, end (code points, end exclusive) and text of every leftmost match; a text without ``needs`` has none.

    The pieces between matches come from splitting at the same pattern; running lengths give the places.
    """
    has = f"rlike({text}, {_quoted(needs)})"
    df = df.withColumns({
        "_hits": F.expr(f"if({has}, regexp_extract_all({text}, {_quoted(pattern)}, 0), cast(array() as array<string>))"),
        "_gaps": F.expr(f"if({has}, split({text}, {_quoted(pattern)}, -1), cast(array() as array<string>))"),
    })
    df = df.withColumn("_ends", F.expr("zip_with(_hits, slice(_gaps, 1, size(_hits)), (h, g) -> cast(length(h) + length(g) as bigint))"))
    df = df.withColumn("_ends", F.expr(running("_ends")))
    spans = f"zip_with(_hits, _ends, (h, e) -> named_struct('kind', '{kind}', 'start', e - length(h), 'end', e, 'text', h))"
    return df.withColumn(out, F.expr(spans)).drop("_hits", "_gaps", "_ends")


def _digits(of: str) -> str:
    return f"regexp_replace({of}, '[^0-9]', '')"


def _luhn(digits: str) -> str:
    """Whether the digits pass the check sum."""
    doubled = "if(i % 2 = 0, cast(d as int), if(cast(d as int) > 4, 2 * cast(d as int) - 9, 2 * cast(d as int)))"
    return f"(length({digits}) > 0 AND aggregate(transform(filter(split(reverse({digits}), ''), c -> c != ''), (d, i) -> {doubled}), 0, (s, v) -> s + v) % 10 = 0)"


def _octets(of: str) -> str:
    return f"forall(split({of}, '[^0-9]+'), o -> length(trim(LEADING '0' FROM o)) <= 3 AND coalesce(try_cast(o as int), 0) <= 255)"


def _valid(kind: str, x: str) -> str:
    """What a base match must also satisfy."""
    return {
        "email": "true", "ip": _octets(f"{x}.text"),
        "card": f"length({_digits(f'{x}.text')}) BETWEEN 12 AND 19 AND {_luhn(_digits(f'{x}.text'))}",
        "phone": f"length({_digits(f'{x}.text')}) BETWEEN 9 AND 15",
    }[kind]


def _beside(docs: DataFrame, text: str, work, *new: str) -> DataFrame:
    """``docs`` with the columns ``new`` that ``work`` adds to a frame of the text alone; no column of ``docs`` is in its way."""
    held = "_row"
    done = work(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(held), text_of(f"`{text}`").alias("_text")))
    lower = {c.lower() for c in new}
    return done.select(*[F.col("_text").alias(c) if c == text else F.col(held)[c].alias(c) for c in docs.columns if c.lower() not in lower], *new)


def base_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``base``, the base spans in order of start and then of kind as in ``KINDS``.

    Null texts become empty and have none; repeated rows and ties each have theirs; an empty table stays empty. A column
    of that name is replaced, all others stay as they are. A very long text is one row with all its spans.
    """
    return _beside(docs, text, lambda df: _base_spans(df, "_text", "base"), "base")


def _base_spans(docs: DataFrame, text: str, out: str) -> DataFrame:
    for kind in KINDS:
        docs = _matches(docs, text, kind, BASE[kind], BASE_NEEDS[kind], f"_{kind}")
        docs = docs.withColumn(f"_{kind}", F.expr(f"filter(_{kind}, x -> {_valid(kind, 'x')})"))
    order = "array_position(array('email', 'ip', 'card', 'phone'), {0}.kind)"
    both = f"(a, b) -> if(a.start != b.start, if(a.start < b.start, -1, 1), if({order.format('a')} < {order.format('b')}, -1, if({order.format('a')} > {order.format('b')}, 1, 0)))"
    return docs.withColumn(out, F.expr(f"array_sort(concat(_email, _ip, _card, _phone), {both})")).drop(*[f"_{k}" for k in KINDS])


def _candidates(docs: DataFrame, text: str, out: str) -> DataFrame:
    """Adds ``out``: wide matches other than the base spans themselves, with the text around them; they may overlap base spans and each other."""
    for kind in KINDS:
        docs = _matches(docs, text, kind, WIDE[kind], NEEDS[kind], f"_{kind}")
    # what closes a sentence or marks up an address is not part of it
    docs = docs.withColumn("_email", F.expr(
        f"transform(_email, c -> named_struct('kind', c.kind, 'start', c.start + length(regexp_extract(c.text, '^{MARKS}++', 0)), "
        f"'end', c.end - length(regexp_extract(c.text, '(?<!{MARKS}){MARKS}++$', 0)), 'text', regexp_replace(c.text, '^{MARKS}++|(?<!{MARKS}){MARKS}++$', '')))"))
    # as sets, so that texts with many spans stay cheap
    new = "array_except(concat(_email, _ip, _card, _phone), base)"
    return _around(docs.withColumn(out, F.expr(new)).drop(*[f"_{k}" for k in KINDS]), text, out, out)


def _around(docs: DataFrame, text: str, spans: str, out: str) -> DataFrame:
    near = (f"named_struct('kind', c.kind, 'start', c.start, 'end', c.end, 'text', c.text, "
            f"'before', substring({text}, cast(greatest(c.start - {CONTEXT}, 0) + 1 as int), cast(least(c.start, {CONTEXT}) as int)), "
            f"'after', substring({text}, cast(c.end + 1 as int), 1))")
    return docs.withColumn(out, F.expr(f"transform({spans}, c -> {near})"))


def _features(x: str) -> dict[str, str]:
    """Format and context of a candidate, each as a SQL number; none of them is whether it is a base span."""
    t, digits = f"{x}.text", _digits(f"{x}.text")
    said = lambda kind: f"rlike({x}.before, {_quoted('(?i)' + WORDS[kind])})"
    f = {f"is_{k}": f"{x}.kind = '{k}'" for k in KINDS}
    f |= {
        "chars": f"length({t})", "digits": f"length({digits})", "letters": f"length(regexp_replace({t}, '[^A-Za-z]', ''))",
        "groups": f"size(regexp_extract_all({t}, '[0-9]+', 0))", "longest": f"coalesce(array_max(transform(regexp_extract_all({t}, '[0-9]+', 0), g -> length(g))), 0)",
        "plus": f"startswith({t}, '+')", "bracket": f"contains({t}, '(') AND contains({t}, ')')", "luhn": _luhn(digits),
        "octets": f"{_octets(t)} AND size(split({t}, '[.]')) = 4", "dots": f"length({t}) - length(replace({t}, '.', ''))",
        "seps": f"length(regexp_replace({t}, '[A-Za-z0-9+]', ''))", "tld": f"length(regexp_extract({t}, '[.]([A-Za-z]+)$', 1))",
        "odd_before": f"rlike({x}.before, '[^\\\\s(\\\\[\\\\x22:]$')", "odd_after": f"rlike({x}.after, '[^\\\\s)\\\\].,;:!?\\\\x22]')",
        "said_kind": "CASE " + " ".join(f"WHEN {x}.kind = '{k}' THEN {said(k)}" for k in KINDS) + " ELSE false END",
        "said_other": "CASE " + " ".join(f"WHEN {x}.kind = '{k}' THEN " + " OR ".join(said(o) for o in KINDS if o != k) for k in KINDS) + " ELSE false END",
    }
    return {k: f"cast({f[k]} as double)" for k in FEATURES}


def _variants() -> str:
    """SQL for labelled rows (kind, text, y) made from a base span: other ways to write it, and what only looks like it.

    For look-alikes its digits are arranged as a date, a time stamp, a price, a version or a serial number, or one part
    breaks a check.
    """
    x, d = "s", _digits("s.text")
    row = lambda kind, text, y: f"named_struct('kind', {kind}, 'text', {text}, 'y', {y})"
    own = row("s.kind", "s.text", "1.0")
    some = {
        "email": [own, row("'email'", "upper(s.text)", "1.0"), row("'email'", "regexp_replace(s.text, '@', ' (at) ')", "1.0"),
                  row("'email'", "regexp_replace(s.text, '[.][A-Za-z0-9.-]*$', '')", "0.0"), row("'email'", "regexp_replace(s.text, '@.*', '@')", "0.0"),
                  row("'email'", "concat(regexp_extract(s.text, '@(.*)$', 1), '@', substring(s.text, 1, 2))", "0.0")],
        "ip": [own, row("'ip'", "concat(s.text, ':8080')", "1.0"), row("'ip'", "concat('4', lpad(s.text, 16, '5'))", "0.0"),
               row("'ip'", "regexp_replace(s.text, '[.][0-9]+$', '')", "0.0"), row("'ip'", "concat(s.text, '.1.2')", "0.0"),
               row("'phone'", "s.text", "0.0"), row("'card'", "s.text", "0.0"), row("'ip'", "concat(substring(s.text, 1, 2), ':30:15')", "0.0")],
        "card": [own, row("'card'", f"regexp_replace({d}, '(.{{4}})(?=.)', '$1.')", "1.0"), row("'card'", f"regexp_replace({d}, '(.{{4}})(?=.)', '$1/')", "1.0"),
                 row("'card'", f"concat(substring({d}, 1, length({d}) - 1), cast((cast(right({d}, 1) as int) + 3) % 10 as string))", "0.0"),
                 row("'card'", f"concat(substring({d}, 1, 4), '-', substring({d}, 5, 2), '-', substring({d}, 7, 2), ' ', substring({d}, 9, 4))", "0.0"),
                 row("'phone'", d, "0.0"), row("'phone'", f"substring({d}, 1, 8)", "0.0"), row("'phone'", f"substring({d}, 1, 10)", "0.0"),
                 row("'ip'", f"concat(substring({d}, 1, 2), '.', substring({d}, 3, 3))", "0.0")],
        "phone": [own, row("'phone'", "regexp_replace(s.text, '^[+][0-9]+ ', '')", "1.0"), row("'phone'", "regexp_replace(s.text, '^[+]', '00 ')", "1.0"),
                  row("'phone'", f"concat(substring({d}, 1, 4), '-', substring({d}, 5, 2), '-', substring({d}, 7, 2))", "0.0"),
                  row("'phone'", f"concat(substring({d}, 1, 2), '.', substring({d}, 3, 2), '.', substring({d}, 5, 4))", "0.0"),
                  row("'phone'", f"concat(substring({d}, 1, 4), '-', substring({d}, 5, 2), '-', substring({d}, 7, 2), ' ', substring({d}, 9, 2))", "0.0"),
                  row("'phone'", f"regexp_replace({d}, '(.{{3}})(?=.)', '$1 ')", "0.0"), row("'phone'", f"substring({d}, 1, 7)", "0.0"), row("'card'", "s.text", "0.0")],
    }
    return "CASE " + " ".join(f"WHEN {x}.kind = '{k}' THEN array({', '.join(v)})" for k, v in some.items()) + " END"


@dataclass
class PiiModel:
    """Boosted trees as a SQL expression over the features, and the score from which a candidate is personal data."""

    expression: str | None
    threshold: float


def _tree_sql(node) -> str:
    if node.subtreeDepth() == 0:
        return f"{float(node.prediction()):.17g}D"
    split = node.split()
    return f"if(f.{FEATURES[split.featureIndex()]} <= {float(split.threshold()):.17g}D, {_tree_sql(node.leftChild())}, {_tree_sql(node.rightChild())})"


def _sampled(docs: DataFrame, sample: int, per_text: int) -> DataFrame:
    """h and near (spans with what stands around them) of the ``sample`` documents with base spans whose hashes are least.

    Documents are searched by slices of their hash until there are enough, each document once at most, so that few texts
    are matched where spans are common; the outcome is that of a search over all.
    """
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).withColumn("h", F.xxhash64("doc_id", "text"))
    mixed = "transform(array_sort(transform(base, s -> named_struct('o', xxhash64(s.start, s.kind), 's', s))), x -> x.s)"
    low, high, taken, n = 0.0, min(1.0, 4 * sample / max(1, docs.count())), None, 0
    place = lambda share: int(share * 2**64) - 2**63
    while True:
        some = plain.filter(F.col("h") >= place(low)) if low else plain
        some = some.filter(F.col("h") < place(high)) if high < 1 else some
        found = _base_spans(some, "text", "base").filter("size(base) > 0")
        near = _around(found, "text", f"slice({mixed}, 1, {per_text})", "near").select("h", "doc_id", "near")
        part = saved(near.orderBy("h", "doc_id").limit(sample), "spans")
        taken = part if taken is None else taken.union(part)
        n += part.count()
        if high >= 1 or n >= sample:
            return taken.orderBy("h", "doc_id").limit(sample).select("h", "near")
        # as far as the share of documents with spans so far says, and a little further
        low, high = high, min(1.0, high * max(1.2, 1.1 * sample / max(1, n)))


def fit(docs: DataFrame, sample: int = 4_000, per_text: int = 64, trees: int = 8, depth: int = 4, precision: float = 0.995, seed: int = 3) -> PiiModel:
    """Boosted trees from base spans, other ways to write them and look-alikes of them.

    At most ``sample`` documents with base spans give the rows, each by at most ``per_text`` of its spans, both chosen by
    hash; a fifth of them set the threshold: the lowest at which the selected rows are right with ``precision``. Without
    such rows, as in an empty table, nothing but base spans is found. Null texts count as empty; rows that repeat count
    as often as they come; other columns than doc_id and text are not read.
    """
    spans = _sampled(docs, sample, per_text).select("h", F.explode("near").alias("s"))
    rows = spans.withColumn("v", F.explode(F.expr(_variants()))).select(
        F.expr("pmod(h, 5) = 0").alias("held"), F.col("v.y").alias("y"),
        F.expr("named_struct('kind', v.kind, 'text', v.text, 'before', s.before, 'after', s.after)").alias("c"))
    rows = rows.select("held", "y", *[F.expr(e).alias(k) for k, e in _features("c").items()])
    # bounded by ``sample``; one partition, so that each round of the trees is one small task
    table = saved(rows.coalesce(1), "pii")
    seen = table.filter("NOT held").agg(F.min("y"), F.max("y")).first()
    if seen[0] is None or seen[0] == seen[1]:
        return PiiModel(None, 2.0)
    data = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(table).coalesce(1).persist()
    try:
        model = GBTClassifier(labelCol="y", featuresCol="features", maxIter=trees, maxDepth=depth, stepSize=0.3, seed=seed).fit(data.filter("NOT held"))
        scored = model.transform(data.filter("held")).select("y", vector_to_array("probability")[1].alias("p"))
        right = scored.groupBy("p").agg(F.sum("y").alias("good"), F.count("*").alias("n")).orderBy(F.desc("p")).collect()
    finally:
        data.unpersist()
    good = n = 0
    threshold = 2.0
    for r in right:
        good, n = good + r.good, n + r.n
        if good >= precision * n:
            threshold = float(r.p)
    margin = " + ".join(f"{float(w):.17g}D * {_tree_sql(t._java_obj.rootNode())}" for t, w in zip(model.trees, model.treeWeights))
    return PiiModel(f"1 / (1 + exp(-2 * ({margin})))", threshold - 1e-9)


def find(docs: DataFrame, model: PiiModel, text: str = "text") -> DataFrame:
    """Adds ``base`` and ``spans`` (all, base ones among them), both in order of start and then of kind.

    A span has kind, start, end (code points, end exclusive) and text. Null texts become empty and have none; repeated
    rows each have theirs; an empty table stays empty; a very long text is one row with all its spans. Columns named
    ``base`` and ``spans`` are replaced, all others stay as they are.
    """
    return _beside(docs, text, lambda df: _found(df, model), "base", "spans")


def _found(docs: DataFrame, model: PiiModel) -> DataFrame:
    text = "_text"
    docs = _base_spans(docs, text, "base")
    order = "array_position(array('email', 'ip', 'card', 'phone'), {0}.kind)"
    if model.expression is None:
        return docs.withColumn("spans", F.col("base"))
    docs = _candidates(docs, text, "_cands")
    features = ", ".join(f"'{k}', {e}" for k, e in _features("c").items())
    docs = docs.withColumn("_cands", F.expr(f"transform(_cands, c -> named_struct('s', named_struct('kind', c.kind, 'start', c.start, 'end', c.end, 'text', c.text), 'f', named_struct({features})))"))
    docs = docs.withColumn("_cands", F.expr(f"filter(transform(_cands, c -> named_struct('s', c.s, 'p', element_at(transform(array(c.f), f -> {model.expression}), 1))), c -> c.p >= {model.threshold:.17g}D)"))
    both = f"(a, b) -> if(a.start != b.start, if(a.start < b.start, -1, 1), if({order.format('a')} < {order.format('b')}, -1, if({order.format('a')} > {order.format('b')}, 1, 0)))"
    return docs.withColumn("spans", F.expr(f"array_sort(concat(base, transform(_cands, c -> c.s)), {both})")).drop("_cands")


def redacted(text: str = "text", spans: str = "spans") -> Column:
    """The text with each span replaced by its kind in brackets; spans that overlap are replaced together."""
    step = (f"if(x.end <= z.at, z, named_struct('at', x.end, 'out', if(x.start >= z.at, concat(z.out, substring({text}, cast(z.at + 1 as int), cast(x.start - z.at as int)), '[', upper(x.kind), ']'), z.out)))")
    return F.expr(f"if(size({spans}) = 0, {text}, aggregate({spans}, named_struct('at', 0L, 'out', ''), (z, x) -> {step}, "
                  f"z -> concat(z.out, substring({text}, cast(z.at + 1 as int), length({text})))))")


def redact(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with personal data in ``text`` replaced; all rows and columns stay, also repeated ones, and null texts stay null.

    Where there is a column n_chars, it follows texts that changed. An empty table stays empty.
    """
    held = "_row"
    marked = _found(docs.select(F.struct(*docs.columns).alias(held), text_of().alias("_text")), fit(docs, **options)).withColumn("_new", redacted("_text"))
    hit = F.size("spans") > 0
    new = {"text": F.when(hit, F.col("_new")).otherwise(F.col(held)["text"])}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(hit, F.length("_new").cast(docs.schema["n_chars"].dataType)).otherwise(F.col(held)["n_chars"])
    return marked.select(*[new.get(c, F.col(held)[c]).alias(c) for c in docs.columns])
