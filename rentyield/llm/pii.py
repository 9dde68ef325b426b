"""Personal data by patterns, and terms that give it away by corpus co-occurrence; DataFrame functions only.

Base spans are e-mail addresses, IPv4 addresses, payment cards and phone numbers. A match that fails
its check (range, Luhn, number of digits) is dropped. Their distinct values are the protected
entities. No pattern matches a line feed, so lines are the contexts of co-occurrence:

* information content of an entity e: ic = ln(N / n(e)) over the corpus's N lines with a word;
* mutual information of a term t and e: pmi = ln(N * n(t, e) / (n(t) * n(e))), n counting lines;
* t discloses e if pmi reaches a share of ic: from ``generalise`` on its occurrences are replaced by
  a general word, from ``remove`` on they are taken out. At least ``support`` different lines must
  hold t and e together, so that a single line, however often copied, is no evidence.

Terms are runs of letters outside the base spans, lower-cased. They are treated in the texts that hold the
entity, wherever base spans do not already cover them. Texts without base spans are left alone.

Term counts come from all lines of all texts; the counts are summed in the map tasks before the
shuffle. Only rows with base spans meet the table of disclosing terms, by the hash of their text.

Patterns are possessive or anchored at the start of a run, so that no text makes them backtrack or
recurse; the matches are those of the plain patterns.

Defined results: a null text counts as empty and stays null in ``sanitise``; repeated rows are treated alike;
texts of any length are searched whole; an empty table gives an empty result; other columns are
ignored (``find``) or kept (``sanitise``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rentyield.llm.tables import durable

GENERALISE = 0.8
REMOVE = 0.95
SUPPORT = 3
#: Kinds of base spans in their order, what they become, and the patterns. ``\G`` is the end of
#: the previous match: a match may begin there or where no earlier character could begin it.
KINDS = ["email", "ip", "card", "phone"]
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}+",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
MASKS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]", "general": "[TERM]", "remove": ""}
_SPAN = "array<struct<begin:int,end:int,value:string>>"


def spans_of(text: Column, pattern: Column) -> Column:
    """Begin, end (code points) and value of each match: match lengths and the lengths between them add up."""
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    between = F.split(text, pattern, -1)
    both = F.arrays_zip(F.transform(between, F.length).alias("gap"), found.alias("value"))     # one gap more: value null
    empty = F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("made"))

    def step(done: Column, x: Column) -> Column:
        begin = done["at"] + x["gap"]
        end = begin + F.coalesce(F.length(x["value"]), F.lit(0))
        one = F.array(F.struct(begin.alias("begin"), end.alias("end"), x["value"].alias("value")))
        return F.struct(end.alias("at"), F.when(x["value"].isNull(), done["made"]).otherwise(F.concat(done["made"], one)).alias("made"))

    return F.aggregate(both, empty, step, lambda done: done["made"])


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    n = F.length(digits)

    def step(total: Column, i: Column) -> Column:       # i counts from the right, from 0
        d = F.substring(digits, n - i, F.lit(1)).cast("int")
        doubled = F.when(d * 2 > 9, d * 2 - 9).otherwise(d * 2)
        return total + F.when(i % 2 == 1, doubled).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), step) % 10 == 0


def _passes(kind: str, value: Column) -> Column:
    if kind == "ip":
        part = lambda p: F.regexp_replace(p, "^0+(?=.)", "")
        return F.forall(F.split(value, r"\."), lambda p: F.when(F.length(part(p)) > 3, False).otherwise(part(p).cast("int") <= 255))
    if kind == "card":
        digits = _digits(value)
        return F.when(F.length(digits).between(13, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    return F.lit(True)


def base_spans(kind: str, text: Column) -> Column:
    """Spans of one kind; texts that lack what the pattern needs are not searched."""
    possible = {"email": text.contains("@"), "phone": text.contains("+"), "ip": text.rlike(r"[0-9]\.[0-9]"),
                "card": text.rlike(r"[0-9][\x20-]?[0-9]")}[kind]
    found = F.filter(spans_of(text, F.lit(PATTERNS[kind])), lambda s: _passes(kind, s["value"]))
    return F.when(possible, found).otherwise(F.array().cast(_SPAN))


def _with_base(df: DataFrame, text: str) -> DataFrame:
    for kind in KINDS:
        df = df.withColumn(f"_{kind}", base_spans(kind, F.col(text)))
    return df


def _any_base() -> Column:
    return reduce(lambda a, b: a | b, [F.size(f"_{kind}") > 0 for kind in KINDS])


def _entities() -> Column:
    """Distinct protected values of the spans at hand, with their kind."""
    value = {"email": F.lower, "ip": lambda v: v, "card": _digits, "phone": _digits}

    def named(kind: str) -> Column:
        return F.transform(f"_{kind}", lambda s: F.concat(F.lit(f"{kind}:"), value[kind](s["value"])))

    return F.array_distinct(F.concat(*map(named, KINDS)))


def _terms(line: Column) -> Column:
    return F.filter(F.array_distinct(F.split(F.lower(line), r"[^\p{L}]+")), lambda t: t != "")


def _text_key(text: str) -> list[Column]:
    return [F.xxhash64(text).alias("_h1"), F.crc32(F.col(text).cast("binary")).alias("_h2")]


def disclosing(docs: DataFrame, text: str = "text", generalise: float = GENERALISE, remove: float = REMOVE,
               support: int = SUPPORT) -> DataFrame:
    """(entity, term, action): the terms that give an entity away, and whether to generalise or remove them."""
    lines = docs.select(F.explode(F.split(text, "\n")).alias("line")).filter(F.col("line").rlike(r"\S"))
    held = _with_base(lines.filter(F.col("line").rlike("[@0-9]")), "line").filter(_any_base())
    outside = F.col("line")
    for kind in KINDS:      # a base span's own letters are no terms
        outside = F.when(F.size(f"_{kind}") > 0, F.regexp_replace(outside, F.lit(PATTERNS[kind]), F.lit(" "))).otherwise(outside)
    held = durable(held.select(F.xxhash64("line").alias("line"), _entities().alias("entities"), _terms(outside).alias("terms")))
    entities = held.select("line", F.explode("entities").alias("entity"), "terms")
    n_e = entities.groupBy("entity").agg(F.count("*").alias("n_e"), F.min("line").alias("lo"), F.max("line").alias("hi"))
    # an entity seen in a single line, however often, has no terms with support
    n_e = n_e.filter("lo < hi").select(F.col("entity").alias("_e"), "n_e")
    both = (entities.join(n_e.select("_e"), F.col("entity") == F.col("_e"), "left_semi")
            .select("entity", "line", F.explode("terms").alias("term"))
            .groupBy("entity", "term", "line").agg(F.count("*").alias("n"))
            .groupBy("entity", "term").agg(F.sum("n").alias("n_te"), F.count("*").alias("lines")).filter(F.col("lines") >= support))
    both = durable(both)
    # every line of the corpus: once for each of its distinct terms, and once for itself (the empty term)
    counted = lines.select(F.explode(F.concat(F.array(F.lit("")), _terms(F.col("line")))).alias("_t")).groupBy("_t").agg(F.count("*").alias("n_t"))
    wanted = both.select(F.col("term").alias("_w")).distinct().unionByName(docs.sparkSession.range(1).select(F.lit("").alias("_w")))
    counted = durable(counted.join(wanted, F.col("_t") == F.col("_w"), "left_semi"))
    total = counted.filter("_t = ''").agg(F.sum("n_t")).first()[0] or 0      # one number
    rated = (both.join(n_e, F.col("entity") == F.col("_e")).join(counted, F.col("term") == F.col("_t"))
             .withColumn("n_all", F.lit(int(total)).cast("long")))
    pmi = F.log(F.col("n_all") * F.col("n_te") / (F.col("n_t") * F.col("n_e")))
    share = F.when(F.col("n_all") > F.col("n_e"), pmi / F.log(F.col("n_all") / F.col("n_e"))).otherwise(F.lit(0.0))
    rated = rated.withColumn("share", share).filter(F.col("share") >= generalise)
    return rated.select("entity", "term", F.when(F.col("share") >= remove, "remove").otherwise("general").alias("action"))


def _term_spans(text: str) -> Column:
    """Spans of the terms in ``_found`` (maps term to action) that do not touch a base span; value is the action."""
    pattern = F.concat(F.lit(r"(?iu)(?<!\p{L})(?:"), F.array_join(F.map_keys("_found"), "|"), F.lit(r")(?!\p{L})"))
    base = F.concat(*[F.col(f"_{kind}") for kind in KINDS])
    spans = F.filter(spans_of(F.col(text), pattern), lambda s: ~F.exists(base, lambda b: (b["begin"] < s["end"]) & (s["begin"] < b["end"])))
    named = F.transform(spans, lambda s: F.struct(s["begin"].alias("begin"), s["end"].alias("end"), F.element_at("_found", F.lower(s["value"])).alias("value")))
    return F.filter(named, lambda s: s["value"].isNotNull())


def _with_terms(docs: DataFrame, text: str, **options) -> DataFrame:
    """``docs`` with the base spans (``_email`` ...) and the spans of disclosing terms (``_terms``)."""
    plain = docs.filter(~F.coalesce(F.col(text).rlike("[@0-9]"), F.lit(False)))          # can hold no base span
    other = _with_base(docs.filter(F.col(text).rlike("[@0-9]")), text)
    none = F.array().cast(_SPAN)
    plain = plain.select("*", *[none.alias(f"_{kind}") for kind in KINDS], none.alias("_terms"))
    clean = other.filter(~_any_base()).withColumn("_terms", none)
    held = other.filter(_any_base()).select("*", *_text_key(text))
    terms = disclosing(docs.select(text), text, **options)
    found = (held.select("_h1", "_h2", F.explode(_entities()).alias("_entity")).distinct()
             .join(terms, F.col("_entity") == F.col("entity"))
             .groupBy("_h1", "_h2", "term").agg(F.max("action").alias("action"))        # "remove" is above "general"
             .groupBy("_h1", "_h2").agg(F.map_from_entries(F.collect_list(F.struct("term", "action"))).alias("_found")))
    # a table of its own: else the plan that masks the texts also holds all of the counting, each time it is adapted
    found = durable(found.select(F.col("_h1").alias("_k1"), F.col("_h2").alias("_k2"), "_found"))
    held = held.join(found, (F.col("_h1") == F.col("_k1")) & (F.col("_h2") == F.col("_k2")), "left")
    held = held.withColumn("_terms", F.when(F.col("_found").isNull(), none).otherwise(_term_spans(text)))
    return plain.unionByName(clean).unionByName(held.drop("_h1", "_h2", "_k1", "_k2", "_found"))


def _listed(spans: Column, kind: Column | None = None) -> Column:
    name = (lambda s: s["value"]) if kind is None else (lambda s: kind)
    return F.transform(spans, lambda s: F.concat_ws(":", name(s), s["begin"].cast("string"), s["end"].cast("string")))


def find(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """(key, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_terms) per row."""
    docs = docs.select(F.col(key).cast("long").alias(key), F.coalesce(F.col(text).cast("string"), F.lit("")).alias(text))
    made = _with_terms(docs, text, **options)
    base = F.concat(*[_listed(F.col(f"_{kind}"), F.lit(kind)) for kind in KINDS])
    every = F.concat(base, _listed(F.filter("_terms", lambda s: s["value"] == "general")), _listed(F.filter("_terms", lambda s: s["value"] == "remove")))
    return made.select(key, *[F.size(f"_{kind}").cast("long").alias(f"n_{kind}") for kind in KINDS],
                       F.sha2(F.array_join(base, ","), 256).alias("base_sha256"), F.array_join(every, ",").alias("spans"),
                       F.size("_terms").cast("long").alias("n_terms"))


def sanitise(docs: DataFrame, text: str = "text", chars: str = "n_chars", **options) -> DataFrame:
    """``docs`` with base spans masked, disclosing terms generalised or removed; ``chars``, where there
    is such a column, is the new length of a changed text."""
    made = _with_terms(docs, text, **options)

    def masked(kind: str) -> Column:
        return F.transform(f"_{kind}", lambda s: F.struct(s["begin"], s["end"], F.lit(MASKS[kind]).alias("mask")))

    each = [*map(masked, KINDS)]
    mask = lambda s: F.when(s["value"] == "general", MASKS["general"]).otherwise(MASKS["remove"])
    each.append(F.transform("_terms", lambda s: F.struct(s["begin"], s["end"], mask(s).alias("mask"))))
    spans = F.array_sort(F.concat(*each))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("made"))

    def step(done: Column, s: Column) -> Column:        # spans of different kinds may overlap: the first one masks
        more = F.array(F.substring(text, done["at"] + 1, s["begin"] - done["at"]), s["mask"])
        later = F.struct(s["end"].alias("at"), F.concat(done["made"], more).alias("made"))
        inside = F.struct(F.greatest(done["at"], s["end"]).alias("at"), done["made"].alias("made"))
        return F.when(s["begin"] >= done["at"], later).otherwise(inside)

    rest = lambda done: F.concat(F.array_join(done["made"], ""), F.substring(text, done["at"] + 1, F.length(text)))
    some = _any_base() | (F.size("_terms") > 0)
    made = made.withColumn("_new", F.when(some, F.aggregate(spans, start, step, rest)).otherwise(F.col(text)))
    if chars in docs.columns:
        made = made.withColumn(chars, F.when(some, F.length("_new").cast(docs.schema[chars].dataType)).otherwise(F.col(chars)))
    return made.withColumn(text, F.col("_new")).select(*docs.columns)
