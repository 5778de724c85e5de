"""Information-theoretic sanitisation of personal data (operator 4); DataFrame functions only.

Protected entities are e-mail addresses, IP addresses, card numbers and phone numbers, found by
fixed patterns. Other terms can give an entity away: with document frequencies ``n``,

    disclosure(t, e) = PMI(t; e) / IC(e) = log(n(t,e) N / (n(t) n(e))) / log(N / n(e))

is 1 for a term that the corpus never shows without the entity, and falls as the term is used
elsewhere. Terms are the words outside all entities, also those that an entity contains (a name in
its address). ``n(t,e)`` counts documents in which the term stands in the entity's line or in the
next line with text above or below. A term whose disclosure reaches ``threshold``, seen with the
entity in documents of at least two different texts, is treated as personal data in every document
of that entity. ``sanitise`` generalises entities and terms to the name of their kind.

Patterns give positions without Python: the matches and the gaps between them alternate, so a
start is a sum of lengths. Possessive repetition and a look-behind at the start keep the
patterns linear; they match exactly what the plain patterns match.

Counts are partial aggregates. Terms and entities are joined by broadcast only below a checked
size, else by shuffle.

Defined results: a null text is empty; rows with equal ids and texts are separate documents with
equal results; null ids are kept; other columns are kept by ``sanitise`` and ignored else.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkrisk.llm.common import join_small, let, stage

# Kinds in order, and their patterns.
KINDS = ("email", "ip", "card", "phone")
TERM = "term"
_LOCAL = "A-Za-z0-9._%+-"
PATTERNS = {
    "email": rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
IP_VALID = rf"^{_PART}(?:\.{_PART}){{3}}$"
_PUNCTUATION = ".,;:!?()[]{}<>#*$%&|=\"'"
THRESHOLD = 0.9
MAX_BROADCAST_ROWS = 100_000


def _luhn(digits: Column) -> Column:
    def doubled(i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        return F.when(i % 2 == 0, d).otherwise(F.when(d > 4, 2 * d - 9).otherwise(2 * d))

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), lambda a, i: a + doubled(i)) % 10 == 0


def _valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        return match.rlike(IP_VALID)
    if kind == "card":
        digits = F.translate(match, " -", "")
        return F.length(digits).between(14, 19) & F.when(F.length(digits).between(14, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(F.translate(match, "+ ().-", "")).between(10, 15)
    return F.lit(True)


def _validity(kind: str):
    return lambda s: _valid(kind, s["value"])


_SPAN = "array<struct<start:int,kind:int,end:int,value:string>>"


def _located(text: Column, pattern: Column, kind: int) -> Column:
    """Spans (code points, end exclusive) of all matches, leftmost and non-overlapping."""

    def placed(m: Column, gaps: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), F.lit(None).cast(_SPAN).alias("out"))

        def step(acc, i):
            a = acc["at"] + F.length(F.get(gaps, i))
            z = a + F.length(F.get(m, i))
            span = F.struct(a.alias("start"), F.lit(kind).alias("kind"), z.alias("end"), F.get(m, i).alias("value"))
            return F.struct(z.alias("at"), F.concat(F.coalesce(acc["out"], F.array().cast(_SPAN)), F.array(span)).alias("out"))

        return F.aggregate(F.sequence(F.lit(0), F.size(m) - 1), start, step, lambda acc: acc["out"])

    none = F.array().cast(_SPAN)
    found = let(F.regexp_extract_all(text, pattern, F.lit(0)),
                lambda m: F.when(F.size(m) > 0, let(F.split(text, pattern, -1), lambda gaps: placed(m, gaps))).otherwise(none))
    return F.coalesce(found, none)


def base_spans(text: Column) -> Column:
    """All valid spans of the four kinds, by start, then kind."""
    worth = {"email": F.contains(text, F.lit("@")), "ip": text.rlike(r"[0-9]\.[0-9]+\.[0-9]"),
             "card": text.rlike("[0-9](?:[ -]?[0-9]){13}"), "phone": F.contains(text, F.lit("+"))}
    parts = []
    for number, kind in enumerate(KINDS):
        found = F.filter(_located(text, F.lit(PATTERNS[kind]), number), _validity(kind))
        parts.append(F.when(worth[kind], found).otherwise(F.array().cast(_SPAN)))
    return F.array_sort(F.concat(*parts))


def _words(text: Column) -> Column:
    """Distinct lower-case words without punctuation at their ends."""
    trimmed = F.transform(F.split(F.lower(text), "[\\x20\\x09-\\x0D]+"), lambda w: F.btrim(w, F.lit(_PUNCTUATION)))
    return F.array_distinct(F.filter(trimmed, lambda w: w != ""))


def _with_text(lines: Column) -> Column:
    return F.filter(lines, lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))


def _outside(text: Column, spans: Column) -> Column:
    """The text with a mark that is no word in place of every span."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc, s):
        gap = F.substring(text, acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
        new = F.when(s["start"] >= acc["at"], F.concat(acc["out"], gap, F.lit(" * "))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), new.alias("out"))

    return F.aggregate(spans, start, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))


def _entity(span: Column) -> Column:
    return F.concat(span["kind"].cast("string"), F.lit(":"), F.lower(span["value"]))


def _term_pattern(terms: Column) -> Column:
    """One pattern for any of the terms, as whole words; every character but letters and digits
    is escaped."""
    quoted = F.transform(terms, lambda t: F.regexp_replace(t, r"([^\p{L}\p{N}\s])", r"\\$1"))
    # Longer terms first: alternatives are tried in order.
    ordered = F.transform(F.array_sort(F.transform(quoted, lambda q: F.struct((-F.length(q)).alias("n"), q.alias("q")))), lambda s: s["q"])
    edge = r"\s\p{Punct}"
    return F.concat(F.lit(rf"(?iu)(?<![^{edge}])(?:"), F.array_join(ordered, "|"), F.lit(rf")(?![^{edge}])"))


def disclosing_terms(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(id, mark, terms): the terms to hide in each document that has any; ``mark`` is a hash of
    the text, as ids may repeat. Estimated from all of ``docs``."""
    rows = docs.select(docs[key].alias("id"), F.coalesce(docs[text], F.lit("")).alias("t"))
    found = rows.withColumn("spans", base_spans(F.col("t"))).filter(F.size("spans") > 0)

    def context(span: Column, lines: Column) -> Column:
        above = F.split(F.substring(F.col("t"), F.lit(1), span["start"]), "\n")
        line = F.size(_with_text(F.slice(above, F.lit(1), F.size(above) - 1)))  # from 0
        first = F.greatest(line, F.lit(1))
        words = _words(F.array_join(F.slice(lines, first, line + 3 - first), "\n"))
        own = F.lower(span["value"])
        return F.struct(_entity(span).alias("entity"), F.filter(words, lambda w: w != own).alias("terms"))

    # A line with an entity keeps a mark in its place, so lines are counted alike in both texts.
    contexts = let(_with_text(F.split(_outside(F.col("t"), F.col("spans")), "\n")),
                   lambda lines: F.transform("spans", lambda s: context(s, lines)))
    seen = stage(found.select("id", F.xxhash64("t").alias("mark"), contexts.alias("c")), "contexts")
    entities = seen.select("id", "mark", F.explode(F.array_distinct(F.transform("c", lambda c: c["entity"]))).alias("entity"))
    pairs = seen.select("id", "mark", F.explode("c").alias("c")).select("id", "mark", "c.entity", F.explode("c.terms").alias("term"))
    # Once per document (rows with equal id and text count once), then over documents.
    per_doc = pairs.select("id", "mark", "entity", "term").distinct()
    joint = per_doc.groupBy("entity", "term").agg(F.count(F.lit(1)).alias("n_te"), F.min("mark").alias("lo"), F.max("mark").alias("hi"))
    joint = stage(joint.filter("lo <> hi").select("entity", "term", "n_te"), "pairs")
    n_e = entities.groupBy("entity").agg(F.count(F.lit(1)).alias("n_e"))
    terms = stage(joint.select("term").distinct(), "terms")
    words = _words(let(base_spans(F.col("t")), lambda b: F.when(F.size(b) > 0, _outside(F.col("t"), b)).otherwise(F.col("t"))))
    uses = join_small(rows.select(F.explode(words).alias("term")), terms, "term", "left_semi", MAX_BROADCAST_ROWS)
    n_t = uses.groupBy("term").agg(F.count(F.lit(1)).alias("n_t"))
    total = rows.agg(F.count(F.lit(1)).alias("n_docs"))
    # One row with the number of documents, as a scalar for every pair.
    scored = joint.join(n_e, "entity").join(n_t, "term").withColumn("n_docs", F.lit(float(total.first()["n_docs"])))
    share = F.log(F.col("n_te") * F.col("n_docs") / (F.col("n_t") * F.col("n_e"))) / F.log(F.col("n_docs") / F.col("n_e"))
    hidden = scored.filter((F.col("n_docs") > F.col("n_e")) & (share >= threshold)).select("entity", "term")
    # One row per entity, so that a document meets its entities, not all their terms.
    of_entity = hidden.groupBy("entity").agg(F.collect_set("term").alias("terms"))
    found_in = entities.join(of_entity, "entity").groupBy("id", "mark").agg(F.collect_set("terms").alias("terms"))
    return stage(found_in.select("id", "mark", F.array_sort(F.array_distinct(F.flatten("terms"))).alias("terms")), "hidden")


def _spans(text: Column, terms: Column) -> Column:
    """Base spans and those of terms outside them, by start, then kind."""

    def all_spans(base: Column) -> Column:
        own = F.filter(_located(text, _term_pattern(terms), len(KINDS)),
                       lambda s: ~F.exists(base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
        return F.when(F.size(terms) > 0, F.array_sort(F.concat(base, own))).otherwise(base)

    return let(base_spans(text), all_spans)


def _with_terms(docs: DataFrame, key: str, text: str, threshold: float) -> DataFrame:
    """``docs`` and the column ``__terms``."""
    hidden = disclosing_terms(docs, key, text, threshold).select(
        F.col("id").alias("__id"), F.col("mark").alias("__mark"), F.col("terms").alias("__hidden"))
    on = docs[key].eqNullSafe(F.col("__id")) & (F.xxhash64(F.coalesce(docs[text], F.lit(""))) == F.col("__mark"))
    out = join_small(docs, hidden, on, "left", MAX_BROADCAST_ROWS)
    return out.withColumn("__terms", F.coalesce("__hidden", F.array().cast("array<string>"))).drop("__id", "__mark", "__hidden")


def _listed(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in (*KINDS, TERM)])
    return F.array_join(F.transform(spans, lambda s: F.concat(F.get(names, s["kind"]), F.lit(":"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string"))), ",")


def find_spans(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(key, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_term) of every whole text."""
    rows = _with_terms(docs.select(docs[key].alias(key), docs[text].alias(text)), key, text, threshold)
    t = F.coalesce(F.col(text), F.lit(""))
    out = rows.select(key, _spans(t, F.col("__terms")).alias("s"))
    of = lambda n: F.size(F.filter("s", lambda x: x["kind"] == n)).cast("long")
    base = F.filter("s", lambda x: x["kind"] < len(KINDS))
    return out.select(key, *[of(i).alias(f"n_{k}") for i, k in enumerate(KINDS)], F.sha2(_listed(base), 256).alias("base_sha256"),
                      _listed(F.col("s")).alias("spans"), of(len(KINDS)).alias("n_term"))


def sanitise(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """All columns of ``docs``; in ``text`` every span is replaced by its kind in brackets. Spans
    that overlap become one, named after the first. A null text stays null."""
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in (*KINDS, TERM)])
    t = F.col(text)

    def rebuilt(spans: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

        def step(acc, s):
            gap = F.substring(t, acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
            new = F.when(s["start"] >= acc["at"], F.concat(acc["out"], gap, F.get(names, s["kind"]))).otherwise(acc["out"])
            return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), new.alias("out"))

        return F.aggregate(spans, start, step, lambda acc: F.concat(acc["out"], F.substring(t, acc["at"] + 1, F.length(t))))

    rows = _with_terms(docs, key, text, threshold)
    clean = let(_spans(t, F.col("__terms")), lambda s: F.when(F.size(s) > 0, rebuilt(s)).otherwise(t))
    return rows.select(*[F.when(t.isNull(), t).otherwise(clean).alias(text) if c == text else F.col(c) for c in docs.columns])
