"""Personal data: base patterns plus information-theoretic sanitisation.

Base kinds (email, ip, card, phone) are found by patterns. On top, corpus
co-occurrence estimates how much a term tells about a protected value: over
all documents, with ``n`` documents, ``c(e)`` of them holding the value ``e``,
``c(t)`` the term and ``c(t, e)`` both,

    disclosure(t, e) = pmi(t, e) / information(e)
                     = ln(c(t, e) * n / (c(t) * c(e))) / ln(n / c(e)),

which is 1 when the term implies the value and 0 when it tells nothing. Terms
over ``threshold`` that stand with the value in at least ``min_support``
pieces of evidence are added as
spans of kind ``term``: replaced by ``[TERM]`` at or over ``remove_at``, cut
to their first letter (generalised) below it. Copies of one text, and texts
linked to it by at least half of their five-word shingles (met under one of
eight minhash values), are one piece of evidence.

Only DataFrame functions are used. Patterns are written without nested
retries (possessive runs that start where no earlier character of the run
stands, or where the last match ended), so they find the same leftmost
matches in linear time on long runs.

Defined cases: NULL text counts as empty and has no spans; repeated rows are
judged row by row; what reveals is a matter of the term alone, so every text
that holds it gets its spans; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratelake.llm.common import staged
from ratelake.llm.components import components

#: Fixed: order of the kinds.
KINDS = ("email", "ip", "card", "phone")
#: Fixed: patterns of the kinds (same matches as the plain forms, see above).
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
TERM = r"\p{L}{3,}"
#: Minhash values by which near copies meet.
SKETCH = 8
_SPAN = "struct<kind:string,start:bigint,end:bigint,value:string>"


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        part = lambda p: F.length(F.regexp_replace(p, "^0+", "")) <= 3
        small = lambda p: F.when(part(p), F.regexp_replace(p, "^0+(?=.)", "").cast("int") <= 255).otherwise(False)
        return F.forall(F.split(value, r"\."), small)
    if kind == "card":
        n = F.length(_digits(value))
        return F.when((n >= 13) & (n <= 19), F.call_function("luhn_check", _digits(value))).otherwise(False)
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    return F.lit(True)


def _check(kind: str):
    return lambda s: _valid(kind, s["value"])


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, also where lambdas use it many times."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _walk(items: Column, step, spans: str = f"array<{_SPAN}>") -> Column:
    """Spans that ``step`` makes from items and the position so far, in order.

    Appending to an array copies it, so items are walked in blocks of about
    the root of their number: inside a block few spans are copied, and the
    whole array only once a block.
    """
    none = F.array().cast(spans)
    zero = F.struct(F.lit(0).cast("bigint").alias("pos"), none.alias("spans"))

    def over(acc: Column, some: Column) -> Column:
        inside = F.aggregate(some, F.struct(acc["pos"].alias("pos"), none.alias("spans")), step)
        return _bound(inside, lambda x: F.struct(x["pos"].alias("pos"), F.concat(acc["spans"], x["spans"]).alias("spans")))

    def walk(all_: Column) -> Column:
        size = F.size(all_)
        block = F.greatest(F.ceil(F.sqrt(size)), F.lit(1)).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), F.floor((size - 1) / block).cast("int")), lambda b: F.slice(all_, b * block + 1, block))
        return F.when(size > 0, F.aggregate(blocks, zero, over)["spans"]).otherwise(none)

    return _bound(items, walk)


def _found(text: Column, pattern: Column, kind: str, when: Column) -> Column:
    """All matches of a pattern as spans, in order, before validation.

    The pieces between matches and the matches themselves give the positions:
    each match starts after the pieces and matches before it.
    """
    empty = F.array().cast("array<string>")
    m = F.when(when, F.regexp_extract_all(text, pattern, F.lit(0))).otherwise(empty)
    gaps = F.when(when, F.split(text, pattern, -1)).otherwise(empty)
    pairs = F.arrays_zip(m.alias("m"), F.slice(gaps, F.lit(1), F.size(m)).alias("g"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["pos"] + F.char_length(x["g"])
        end = start + F.char_length(x["m"])
        span = F.struct(F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"), x["m"].alias("value"))
        return F.struct(end.alias("pos"), F.concat(acc["spans"], F.array(span)).alias("spans"))

    return _walk(pairs, step)


def _replaced(text: Column, spans: Column) -> Column:
    """``text`` with each span (start, end, tag) replaced by its tag, at its place
    only; of spans that overlap the later one stands for what is left of it."""
    piece = "struct<start:bigint,end:bigint,tag:string>"

    def step(acc: Column, x: Column) -> Column:
        left = F.struct(F.greatest(x["start"], acc["pos"]).alias("start"), x["end"].alias("end"), x["tag"].alias("tag"))
        more = F.when(x["end"] > acc["pos"], F.array(left)).otherwise(F.array().cast(f"array<{piece}>"))
        return F.struct(F.greatest(acc["pos"], x["end"]).alias("pos"), F.concat(acc["spans"], more).alias("spans"))

    # By start, the longer one first.
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("back"), s["tag"].alias("tag"))))
    ordered = F.transform(ordered, lambda s: F.struct(s["start"].alias("start"), (-s["back"]).alias("end"), s["tag"].alias("tag")))
    cut = _walk(ordered, step, f"array<{piece}>")
    before = lambda c: F.concat(F.array(F.lit(0).cast("bigint")), F.transform(c, lambda s: s["end"]))

    def joined(held: Column) -> Column:
        # Each piece of text between two spans, then the tag of the second one.
        upto = F.arrays_zip(held["cut"].alias("s"), before(held["cut"]).alias("before"))
        between = lambda a, n: F.array_join(F.slice(held["chars"], (a + 1).cast("int"), n.cast("int")), "")

        def part(x: Column) -> Column:
            rest = between(x["before"], F.size(held["chars"]) - x["before"])
            return F.when(x["s"].isNull(), rest).otherwise(F.concat(between(x["before"], x["s"]["start"] - x["before"]), x["s"]["tag"]))

        return F.array_join(F.transform(upto, part), "")

    held = F.struct(cut.alias("cut"), F.split(text, "").alias("chars"))
    return F.when(F.size(spans) > 0, _bound(held, joined)).otherwise(text)


def base_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``base``: valid spans by kind as listed, then start."""
    t = F.coalesce(F.col(text), F.lit(""))
    digits = t.rlike("[0-9]")
    when = {
        "email": F.contains(t, F.lit("@")),
        "ip": digits & F.contains(t, F.lit(".")),
        "card": digits,
        "phone": F.contains(t, F.lit("+")),
    }
    out = docs
    for kind in KINDS:
        out = out.withColumn(f"_{kind}", _found(t, F.lit(PATTERNS[kind]), kind, when[kind]))
    parts = [F.filter(F.col(f"_{k}"), _check(k)) for k in KINDS]
    return out.withColumn("base", F.concat(*parts)).drop(*[f"_{k}" for k in KINDS])


def _near_copies(texts: DataFrame) -> DataFrame:
    """(copy, component) of the texts (copy, w: words) that are near copies of another one.

    Under each minhash value all texts are held against one of them, so work
    stays linear in a group of near copies.
    """
    piece = F.transform(F.sequence(F.lit(1), F.greatest(F.size("w") - 4, F.lit(1))), lambda i: F.xxhash64(F.slice("w", i, 5)))
    sets = staged(texts.where(F.size("w") > 0).select("copy", F.array_distinct(piece).alias("s")), "pii-shingles")
    low = [F.array_min(F.transform("s", lambda h, j=j: F.xxhash64(h, F.lit(j)))) for j in range(SKETCH)]
    keys = sets.select("copy", F.posexplode(F.array(*low)).alias("j", "low"))
    hub = keys.groupBy("j", "low").agg(F.min("copy").alias("v"), F.max("copy").alias("hi")).where("v < hi").drop("hi")
    pairs = staged(keys.join(hub, ["j", "low"]).where("copy != v").select(F.col("copy").alias("u"), "v").distinct(), "pii-near")
    both = pairs.join(sets.select(F.col("copy").alias("u"), F.col("s").alias("a")), "u").join(
        sets.select(F.col("copy").alias("v"), F.col("s").alias("b")), "v"
    )
    shared = F.size(F.array_intersect("a", "b"))
    links = both.where(3 * shared >= F.size("a") + F.size("b")).select("u", "v")  # half of the union
    return components(links).withColumnRenamed("node", "copy")


def _words(c: Column) -> Column:
    return F.regexp_extract_all(F.lower(c), F.lit(TERM), F.lit(0))


def revealing_terms(
    docs: DataFrame,
    text: str = "text",
    base: DataFrame | None = None,
    threshold: float = 0.8,
    min_support: int = 3,
) -> DataFrame:
    """(term, disclosure): the terms that give a protected value away.

    Every count runs over all documents. Pairs (value, term) are counted only
    for values in at least ``min_support`` different texts, as others cannot
    pass; counts are pre-aggregated before each shuffle, so a value or a copied
    text in a third of all documents arrives as one row per map task.
    """
    base = base_spans(docs, text) if base is None else base
    n = docs.count()
    values = base.where(F.size("base") > 0).select(
        F.xxhash64(text).alias("copy"),
        F.aggregate("base", F.col(text), lambda acc, b: F.replace(acc, b["value"], F.lit(" "))).alias("_t"),
        F.explode(F.array_distinct(F.transform("base", lambda s: F.lower(s["value"])))).alias("value"),
    )
    per_text = values.groupBy("value", "copy").agg(F.count("*").alias("k"))
    common = per_text.groupBy("value").agg(F.sum("k").alias("c_e"), F.count("*").alias("texts")).where(F.col("texts") >= min_support)
    common = staged(common.select("value", "c_e"), "pii-values")
    # Copies of one text are read once, near copies are one piece of evidence.
    holds = values.join(common, "value")
    texts = staged(holds.groupBy("copy").agg(F.regexp_extract_all(F.lower(F.first("_t")), F.lit(TERM), F.lit(0)).alias("w")), "pii-texts")
    rows = holds.groupBy("value", "c_e", "copy").agg(F.count("*").alias("k"))
    rows = rows.join(texts.select("copy", F.array_distinct("w").alias("w")), "copy").join(_near_copies(texts), "copy", "left")
    rows = rows.select("value", "c_e", "k", F.coalesce("component", "copy").alias("evidence"), F.explode("w").alias("term"))
    rows = rows.groupBy("value", "c_e", "term", "evidence").agg(F.sum("k").alias("k"))
    pairs = rows.groupBy("value", "c_e", "term").agg(F.sum("k").alias("c_te"), F.count("*").alias("support"))
    pairs = staged(pairs.where(F.col("support") >= min_support), "pii-pairs")
    # Documents per term, of all terms, summed up in each task first.
    held = docs.where(F.col(text).isNotNull()).select(F.explode(F.array_distinct(_words(F.col(text)))).alias("term"))
    seen = held.groupBy("term").agg(F.count("*").alias("c_t"))
    total = F.lit(float(n))
    pmi = F.log(F.col("c_te") * total / (F.col("c_t") * F.col("c_e")))
    info = F.log(total / F.col("c_e"))
    score = F.when(info > 0, pmi / info).otherwise(0.0)
    return pairs.join(seen, "term").where(score >= threshold).groupBy("term").agg(F.max(score).alias("disclosure"))


def _term_spans(texts: DataFrame, terms: DataFrame) -> DataFrame:
    """(doc_id, copy, terms): where texts hold revealing terms.

    A text's distinct words meet the revealing terms; texts that hold some are
    searched for those alone, by a pattern of their own.
    """
    words = texts.select("doc_id", "copy", F.explode(F.array_distinct(_words(F.col("text")))).alias("term"))
    hits = words.join(terms, "term").groupBy("doc_id", "copy").agg(F.collect_set(F.struct("term", "disclosure")).alias("t"))
    hits = staged(hits, "pii-hits").select(F.col("doc_id").alias("_i"), F.col("copy").alias("_c"), "t")
    # By the ids alone first, a small table: other texts then take no part in the shuffle.
    ids = staged(hits.select(F.col("_i").alias("_d")).distinct().sort("_d"), "pii-ids")
    own = texts.join(ids, F.col("doc_id").eqNullSafe(F.col("_d")), "left_semi")
    own = own.join(hits, F.col("doc_id").eqNullSafe(F.col("_i")) & (F.col("copy") == F.col("_c")))
    either = F.array_join(F.transform("t", lambda t: t["term"]), "|")
    pattern = F.concat(F.lit(r"(?iu)(?<!\p{L})(?:"), either, F.lit(r")(?!\p{L})"))
    rows = own.select("doc_id", "copy", "t", _found(F.col("text"), pattern, "term", F.lit(True)).alias("s"))
    known = F.map_from_entries(F.transform("t", lambda t: F.struct(t["term"], t["disclosure"])))
    rows = rows.withColumn("known", known).dropDuplicates(["doc_id", "copy"])  # repeated rows
    span = lambda s: F.struct(*[s[c].alias(c) for c in ("kind", "start", "end", "value")], F.try_element_at("known", F.lower(s["value"])).alias("disclosure"))
    spans = F.filter(F.transform("s", span), lambda s: s["disclosure"].isNotNull())
    return rows.select("doc_id", "copy", spans.alias("terms"))


def _all_spans(docs: DataFrame, doc_id: str, text: str, threshold: float, min_support: int) -> DataFrame:
    """(doc_id, copy, base, terms) of every row; terms with their disclosure, outside of base spans."""
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    texts = texts.withColumn("copy", F.xxhash64("text"))
    base = base_spans(texts)
    stored = base.select("doc_id", "copy", "base", F.when(F.size("base") > 0, F.col("text")).alias("text"))
    stored = staged(stored, "pii-base")
    terms = staged(revealing_terms(texts, "text", base=stored, threshold=threshold, min_support=min_support), "pii-terms")
    spans = staged(_term_spans(texts, terms), "pii-spans").select(F.col("doc_id").alias("_i"), F.col("copy").alias("_c"), "terms")
    out = stored.select("doc_id", "copy", "base").join(spans, F.col("doc_id").eqNullSafe(F.col("_i")) & (F.col("copy") == F.col("_c")), "left")
    inside = lambda t: F.exists("base", lambda b: (t["start"] < b["end"]) & (b["start"] < t["end"]))
    terms = F.coalesce(F.filter("terms", lambda t: ~inside(t)), F.array().cast(spans.schema["terms"].dataType))
    return out.select("doc_id", "copy", "base", terms.alias("terms"))


def find_personal_data(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = 0.8, min_support: int = 3
) -> DataFrame:
    """(doc_id, base, terms): base spans and spans of revealing terms.

    Texts are read three times (patterns, term counts, places of terms) and
    never shuffled whole: only ids, spans and terms are.
    """
    out = _all_spans(docs, doc_id, text, threshold, min_support)
    plain = lambda t: F.struct(t["kind"].alias("kind"), t["start"].alias("start"), t["end"].alias("end"), t["value"].alias("value"))
    return out.select("doc_id", "base", F.transform("terms", plain).alias("terms"))


def sanitise(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", remove_at: float = 0.95, threshold: float = 0.8, min_support: int = 3
) -> DataFrame:
    """``docs`` with personal data replaced by its kind and revealing terms
    generalised to their first letter (or removed at ``remove_at`` and over),
    each at its place."""
    spans = _all_spans(docs, doc_id, text, threshold, min_support)
    spans = spans.groupBy(F.col("doc_id").alias("_i"), F.col("copy").alias("_c")).agg(F.first("base").alias("_b"), F.first("terms").alias("_t"))
    span = lambda s, tag: F.struct(s["start"].alias("start"), s["end"].alias("end"), tag.alias("tag"))
    base = F.transform("_b", lambda s: span(s, F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))))
    cut = lambda t: F.when(t["disclosure"] >= remove_at, F.lit("[TERM]")).otherwise(F.concat(F.substring(t["value"], 1, 1), F.lit(".")))
    terms = F.transform("_t", lambda t: span(t, cut(t)))
    plain = F.coalesce(F.col(text), F.lit(""))
    out = docs.join(spans, F.col(doc_id).eqNullSafe(F.col("_i")) & (F.xxhash64(plain) == F.col("_c")), "left")
    return out.withColumn(text, F.when(F.col(text).isNotNull(), _replaced(plain, F.concat(base, terms)))).drop("_i", "_c", "_b", "_t")


def digest_rows(found: DataFrame) -> DataFrame:
    """The columns of the registered query from spans."""
    join = lambda c: F.array_join(
        F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("bigint").alias(f"n_{k}")
    return found.select(
        "doc_id",
        *[count(k) for k in KINDS],
        F.sha2(join(F.col("base")), 256).alias("base_sha256"),
        join(F.concat("base", "terms")).alias("spans"),
    )
