"""Personal data: patterns, and terms that disclose it; DataFrame operations only.

Patterns find the protected entities themselves (an address, a number). The corpus then tells which
words give such an entity away: from how many documents hold the entity, the word, and both close
together, the pointwise mutual information of word and entity is taken as a share of the entity's
information content. A word at or above a threshold discloses the entity. It is removed where it
says as much as the entity itself, and generalised below that.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored, whole_row

#: The patterns and their order. Possessive quantifiers and the look-behind change no
#: match; they keep long runs of characters linear.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = (*PATTERNS, "linked")
OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
TERM = r"\p{L}{3,}"
SUM_BLOCK = 64
#: Terms are looked up in a bit table of this fixed size before any row is made for them.
TABLE_WORDS = 1 << 14


@dataclass(frozen=True)
class Disclosure:
    """``reach``: characters on either side of an entity that count as its surroundings.

    ``texts``: different texts that must hold word and entity together. ``generalise``, ``remove``:
    shares of the entity's information content from which a word is generalised or removed.
    """

    reach: int = 80
    texts: int = 3
    generalise: float = 0.95
    remove: float = 1.0 - 1e-9


def _bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` worked out once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _sums(values: Column) -> Column:
    """Running sums of an array: by blocks, so that long arrays stay cheap."""
    add = lambda part: F.aggregate(part, F.lit(0), lambda a, b: a + b)
    block = lambda i: F.floor(i / SUM_BLOCK).cast("int")

    def summed(steps: Column) -> Column:
        last = block(F.greatest(F.size(steps) - 1, F.lit(0)))
        blocks = F.transform(
            F.sequence(F.lit(0), last), lambda b: add(F.slice(steps, b * SUM_BLOCK + 1, F.lit(SUM_BLOCK)))
        )
        inside = lambda i: add(F.slice(steps, block(i) * SUM_BLOCK + 1, i % SUM_BLOCK + 1))
        before = lambda sums: F.transform(sums, lambda _, b: add(F.slice(sums, F.lit(1), b)))
        ends = lambda starts: F.transform(steps, lambda _, i: F.get(starts, block(i)) + inside(i))
        return _bound(blocks, lambda sums: _bound(before(sums), ends))

    return _bound(values, summed)


def _located(text: Column, pattern: str) -> Column:
    """Matches in order as (start, end, value), in code points, end exclusive."""
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), F.length)

    def spans(pair: Column) -> Column:
        steps = F.transform(pair["values"], lambda v, i: F.get(pair["gaps"], i) + F.length(v))
        return _bound(
            _sums(steps),
            lambda ends: F.transform(
                pair["values"],
                lambda v, i: F.struct(
                    (F.get(ends, i) - F.length(v)).alias("start"), F.get(ends, i).alias("end"), v.alias("value")
                ),
            ),
        )

    none = F.array().cast("array<struct<start:int,end:int,value:string>>")
    return F.when(F.size(values) > 0, _bound(F.struct(values.alias("values"), gaps.alias("gaps")), spans)).otherwise(none)


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "card":
        return F.length(digits).between(14, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(digits).between(10, 15)
    return F.lit(True)


def _span(kind: str, place: Column) -> Column:
    order = F.lit(KINDS.index(kind))
    return F.struct(
        place["start"].alias("start"),
        order.alias("kind_order"),
        place["end"].alias("end"),
        F.lit(kind).alias("kind"),
        place["value"].alias("value"),
    )


def _of_kind(kind: str, places: Column) -> Column:
    return F.transform(F.filter(places, lambda m: _valid(kind, m["value"])), lambda m: _span(kind, m))


def base_spans(text: Column) -> Column:
    """Spans of all kinds by start, then kind: (start, kind_order, end, kind, value)."""
    text = F.coalesce(text, F.lit(""))
    found = []
    for kind, pattern in PATTERNS.items():
        found.append(_of_kind(kind, _located(text, pattern)))
    return F.array_sort(F.concat(*found))


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def _text_key(text: Column) -> Column:
    return F.md5(F.coalesce(text, F.lit("")).cast("binary"))


def _terms_near(text: Column, spans: Column, reach: int) -> Column:
    """(entity, kind, term) for each different term around each entity; words cut by the edge stay out."""

    def around(s: Column) -> Column:
        start, end = s["start"], s["end"]
        left = F.substring(text, F.greatest(start - reach, F.lit(0)) + 1, F.least(start, F.lit(reach)))
        left = F.when(start > reach, F.regexp_replace(left, r"^\p{L}+", "")).otherwise(left)
        right = F.substring(text, end + 1, F.lit(reach))
        right = F.when(F.length(right) == reach, F.regexp_replace(right, r"\p{L}+$", "")).otherwise(right)
        words = F.regexp_extract_all(F.concat(left, F.lit(" "), right), F.lit(TERM), F.lit(0))
        return F.transform(
            words,
            lambda w: F.struct(
                F.xxhash64(s["kind"], F.lower(s["value"])).alias("entity"), s["kind"].alias("kind"), F.lower(w).alias("term")
            ),
        )

    return F.array_distinct(F.flatten(F.transform(spans, around)))


def _bit_table(terms: DataFrame) -> Column:
    """A scalar array of ``TABLE_WORDS`` longs with the bit of each hashed term set."""
    place = F.pmod(F.xxhash64("term"), F.lit(TABLE_WORDS * 64))
    bit = F.expr("shiftleft(1L, cast(place % 64 as int))")
    words = terms.select(place.alias("place")).groupBy(F.floor(F.col("place") / 64).alias("id")).agg(F.bit_or(bit).alias("bits"))
    every = terms.sparkSession.range(TABLE_WORDS).join(words, "id", "left")
    rows = F.array_sort(F.collect_list(F.struct("id", F.coalesce("bits", F.lit(0)).alias("bits"))))
    return every.agg(rows.getField("bits").alias("bits")).scalar()


def _may_hold(table: Column, term: Column) -> Column:
    place = F.pmod(F.xxhash64(term), F.lit(TABLE_WORDS * 64))
    return F.getbit(F.get(table, F.floor(place / 64).cast("int")), (place % 64).cast("int")) == 1


def disclosing_terms(docs: DataFrame, found: DataFrame, rule: Disclosure) -> DataFrame:
    """``(term, kind, share)`` of terms whose disclosure reaches ``rule.generalise``.

    ``found`` has ``text_key``, ``near`` (see ``_terms_near``) for every document. Probabilities are
    shares of all documents; the share is that of the entity which the term discloses most.
    """
    total = F.lit(float(max(1, found.count())))
    near = found.filter(F.size("near") > 0).select("text_key", F.explode("near").alias("n")).select("text_key", "n.*")
    pairs = (
        near.groupBy("entity", "kind", "term", "text_key")
        .agg(F.count("*").alias("docs"))
        .groupBy("entity", "kind", "term")
        .agg(F.sum("docs").alias("together"), F.count("*").alias("texts"))
        .filter(F.col("texts") >= rule.texts)
    )
    entities = (
        found.filter(F.size("spans") > 0)
        .select(F.explode(F.array_distinct(F.transform("spans", lambda s: F.xxhash64(s["kind"], F.lower(s["value"]))))).alias("entity"))
        .groupBy("entity")
        .agg(F.count("*").alias("entity_docs"))
    )
    # A term is in at least the documents that hold it near some entity. Where it discloses too
    # little even if it is in no other, its documents need not be counted: most words end here.
    beside = (
        found.filter(F.size("near") > 0)
        .select(F.explode(F.array_distinct(F.transform("near", lambda n: n["term"]))).alias("term"))
        .groupBy("term")
        .agg(F.count("*").alias("near_docs"))
    )
    content = -F.log2(F.col("entity_docs") / total)
    mutual = lambda docs: F.log2(F.col("together") * total / (F.col("entity_docs") * F.col(docs)))
    reaches = (content > 0) & (mutual("near_docs") / content >= rule.generalise)
    pairs = stored(pairs.join(entities, "entity").join(beside, "term").filter(reaches), "pairs")
    looked = docs.select("text", _bit_table(pairs.select("term").distinct()).alias("bits"))
    words = F.transform(F.regexp_extract_all("text", F.lit(TERM), F.lit(0)), F.lower)
    held = F.array_distinct(F.filter(words, lambda w: _may_hold(F.col("bits"), w)))
    held = looked.select(F.explode(held).alias("term"))
    counts = held.groupBy("term").agg(F.count("*").alias("term_docs"))
    shares = pairs.join(counts, "term").withColumn("share", mutual("term_docs") / content)
    best = F.max(F.struct("share", "kind"))
    return (
        shares.filter(F.col("share") >= rule.generalise)
        .groupBy("term")
        .agg(best.alias("best"))
        .select("term", "best.kind", "best.share")
    )


def _with_found(docs: DataFrame, rule: Disclosure) -> DataFrame:
    spans = docs.select("doc_id", "text", _text_key(F.col("text")).alias("text_key"), base_spans(F.col("text")).alias("spans"))
    near = F.when(F.size("spans") > 0, _terms_near(F.col("text"), F.col("spans"), rule.reach)).otherwise(F.array())
    return stored(spans.withColumn("near", near.cast("array<struct<entity:bigint,kind:string,term:string>>")).drop("text"), "found")


def _linked(docs: DataFrame, found: DataFrame, rule: Disclosure) -> DataFrame:
    """``(text_key, linked)``: spans of disclosing terms for each different text that holds any."""
    terms = stored(disclosing_terms(docs, found, rule), "terms")
    looked = docs.select("text", _bit_table(terms).alias("bits"))
    text, table = F.col("text"), F.col("bits")
    held = F.exists(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)), lambda w: _may_hold(table, F.lower(w)))
    places = F.filter(_located(text, TERM), lambda m: _may_hold(table, F.lower(m["value"])))
    hits = looked.select(_text_key(text).alias("text_key"), F.explode(F.when(held, places)).alias("m"))
    span = _span("linked", F.col("m"))
    label = F.when(F.col("share") >= rule.remove, F.lit("")).otherwise(F.lit("[TERM]"))
    hits = hits.withColumn("term", F.lower("m.value")).join(terms, "term")
    return hits.groupBy("text_key").agg(F.collect_set(F.struct(*(span[c].alias(c) for c in SPAN), label.alias("label"))).alias("linked"))


SPAN = ("start", "kind_order", "end", "kind", "value")


def find(docs: DataFrame, rule: Disclosure | None = None) -> DataFrame:
    """``(doc_id, spans, linked)`` for every row of ``docs``.

    ``spans`` are the pattern matches, ``linked`` the disclosing terms with the label that replaces
    them. Null text counts as empty and has neither. Repeated rows count as documents of their own
    and come out as often; texts that occur once more do not raise ``Disclosure.texts``. An empty
    table gives none. Columns other than ``doc_id`` and ``text`` are not read.
    """
    rule = rule or Disclosure()
    docs = docs.select("doc_id", "text")
    found = _with_found(docs, rule)
    linked = _linked(docs, found, rule)
    none = F.array().cast(linked.schema["linked"].dataType)
    return found.select("doc_id", "text_key", "spans").join(linked, "text_key", "left").select(
        "doc_id", "spans", F.array_sort(F.coalesce("linked", none)).alias("linked")
    )


def _merged(spans: Column) -> Column:
    """Overlapping spans joined; the first one's label stays."""
    kind = "array<struct<start:int,end:int,label:string>>"

    def add(done: Column, s: Column) -> Column:
        last = F.element_at(done, -1)
        piece = F.struct(s["start"].alias("start"), s["end"].alias("end"), s["label"].alias("label"))
        longer = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"), last["label"].alias("label"))
        joined = F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(longer))
        apart = (F.size(done) == 0) | (s["start"] >= F.try_element_at(done, F.lit(-1))["end"])
        return F.when(apart, F.concat(done, F.array(piece))).otherwise(joined)

    return F.aggregate(spans, F.array().cast(kind), add)


def redacted(text: Column, spans: Column) -> Column:
    """``text`` with every span replaced by its label; ``spans`` have start, end and label."""

    def rebuilt(parts: Column) -> Column:
        end = lambda i: F.when(i > 0, F.get(parts, i - 1)["end"]).otherwise(0)
        pieces = F.transform(
            parts, lambda s, i: F.concat(F.substring(text, end(i) + 1, s["start"] - end(i)), s["label"])
        )
        tail = F.substring(text, F.element_at(parts, -1)["end"] + 1, F.length(text))
        return F.concat(F.array_join(pieces, ""), tail)

    return F.when(F.size(spans) > 0, _bound(_merged(spans), rebuilt)).otherwise(text)


def sanitise(docs: DataFrame, rule: Disclosure | None = None) -> DataFrame:
    """``docs`` with its columns, the text freed of personal data and of terms that disclose it.

    Entities become ``[EMAIL]``, ``[IP]``, ``[CARD]``, ``[PHONE]``; disclosing terms ``[TERM]`` or
    nothing. Null and empty texts stay as they are.
    """
    rule = rule or Disclosure()
    slim = docs.select("doc_id", "text")
    linked = _linked(slim, _with_found(slim, rule), rule)
    keyed = docs.select(whole_row(docs).alias("row"), "text", _text_key(F.col("text")).alias("text_key"))
    both = keyed.join(linked, "text_key", "left")
    label = lambda s: F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))
    base = F.transform(base_spans(F.col("text")), lambda s: F.struct(*(s[c].alias(c) for c in SPAN), label(s).alias("label")))
    none = F.array().cast(linked.schema["linked"].dataType)
    spans = F.array_sort(F.concat(base, F.coalesce("linked", none)))
    clean = both.withColumn("spans", spans).withColumn("text", redacted(F.col("text"), F.col("spans")))
    return clean.select(F.col("row").withField("text", F.col("text")).alias("row")).select("row.*")
