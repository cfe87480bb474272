"""Personal data: base patterns, and terms that disclose what the patterns protect.

Protected entities are the matches of four patterns (mail address, IP address, card, phone).  Over the whole corpus,
each letter word (term) is weighed against each entity that it shares a document with, wherever in it both stand:

    IC(e)      = -log2 p(e)                         information in learning the entity
    PMI(e, t)  = log2 p(e, t) / (p(e) p(t))         information that the term gives about it
    disclosure = PMI / IC,  1 when the term occurs only in documents that hold the entity

p counts documents, p(e, t) those that hold both.  In documents that hold the entity, terms that disclose `generalise`
or more of it become the class of word they are, and terms that disclose `remove` or more go.  A pair must be seen in
`support` different texts: one sighting is no estimate, and a copy of a text to the letter is no other sighting.

Everything is built-in functions: no Python runs on executors.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.frames import text_key
from tallyloom.session import stored

KINDS = ("email", "ip", "card", "phone")
#: The four base patterns.  Possessive and anchored forms of them that match the same and never back up,
#: so that very long runs of fitting characters take linear time and no stack.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A cheap necessary condition for each pattern.
_HINTS = {"email": r"@[A-Za-z0-9-]", "ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){12}", "phone": r"\+[0-9]"}
_BYTE = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_PART = rf"(?:0++{_BYTE}?|{_BYTE})"
LABELS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]"}
_LETTERS = r"\p{L}+"
_BLOCK = 128
_SPAN = "array<struct<kind:string,first:int,end:int,value:string>>"


@dataclass(frozen=True)
class Disclosure:
    """Settings of the disclosure estimate (see the module's text)."""

    support: int = 4
    generalise: float = 0.8
    remove: float = 0.95


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is worked out once, however often the body and its lambdas use it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _before(lengths: Column) -> Column:
    """Sums of all earlier elements of an int array; two levels, so a long array costs little more than its length."""

    def total(part):
        return F.aggregate(part, F.lit(0), lambda a, x: a + x)

    def sums(own):
        firsts = F.sequence(F.lit(0), F.size(own) - 1, F.lit(_BLOCK))
        blocks = F.transform(firsts, lambda i: total(F.slice(own, i + 1, _BLOCK)))
        offsets = lambda all_blocks: F.transform(all_blocks, lambda _, i: total(F.slice(all_blocks, F.lit(1), i)))

        def each(offset):
            place = lambda i: (F.floor(i / _BLOCK) + 1).cast("int")
            return F.transform(
                own, lambda _, i: F.element_at(offset, place(i)) + total(F.slice(own, i - i % _BLOCK + 1, i % _BLOCK))
            )

        return F.when(F.size(own) > 0, _let(blocks, lambda x: _let(offsets(x), each))).otherwise(F.array().cast("array<int>"))

    return _let(lengths, sums)


def _firsts(matches: Column, pieces: Column) -> Column:
    """Where each match begins: all earlier matches and pieces lie before it."""
    lengths, gaps = F.transform(matches, F.length), F.transform(pieces, F.length)
    ends = _let(gaps, lambda g: F.zip_with(_before(g), g, lambda a, b: a + b))
    return _let(ends, lambda e: F.zip_with(_before(lengths), F.slice(e, F.lit(1), F.size(matches)), lambda a, b: a + b))


def _matches(text: Column, kind: str) -> Column:
    found = F.regexp_extract_all(text, F.lit(PATTERNS[kind]), F.lit(0))
    return F.when(text.rlike(_HINTS[kind]), found).otherwise(F.array().cast("array<string>"))


def _pieces(text: Column, kind: str) -> Column:
    return F.split(text, PATTERNS[kind], -1)


def _holds(kind: str, value: Column) -> Column:
    """Whether a match is valid for its kind."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        return value.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")
    if kind == "card":
        return F.when(F.length(digits).between(13, 19), F.call_function("luhn_check", digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def with_matches(df: DataFrame) -> DataFrame:
    """Adds `_matches_<kind>` and `_pieces_<kind>` (the text between) for a column `_text`."""
    df = df.withColumns({f"_matches_{k}": _matches(F.col("_text"), k) for k in KINDS})
    none = F.array(F.col("_text"))
    return df.withColumns(
        {f"_pieces_{k}": F.when(F.size(f"_matches_{k}") > 0, _pieces(F.col("_text"), k)).otherwise(none) for k in KINDS}
    )


def _base_spans(kind: str) -> Column:
    matches, pieces = F.col(f"_matches_{kind}"), F.col(f"_pieces_{kind}")
    spans = F.zip_with(
        matches,
        _firsts(matches, pieces),
        lambda m, first: F.struct(
            F.lit(kind).alias("kind"), first.alias("first"), (first + F.length(m)).alias("end"), m.alias("value")
        ),
    )
    valid = F.filter(spans, lambda s: _holds(kind, s["value"]))
    return F.when(F.size(matches) > 0, valid).otherwise(F.array().cast(_SPAN))


def base_spans(df: DataFrame) -> DataFrame:
    """Adds `_base`: the spans of the four kinds in their order, then by place, for a column `_text`."""
    found = with_matches(df)
    found = found.withColumns({f"_spans_{k}": _base_spans(k) for k in KINDS})
    return found.withColumn("_base", F.concat(*[F.col(f"_spans_{k}") for k in KINDS])).select(*df.columns, "_base")


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}]+", -1), lambda w: F.length(w) > 1)


def _entities_of(base: Column) -> Column:
    """The distinct entities of spans, by one name each however they are written."""
    names = F.transform(
        base,
        lambda s: F.concat(
            s["kind"],
            F.lit(":"),
            F.when(s["kind"] == "email", F.lower(s["value"]))
            .when(s["kind"] == "ip", s["value"])
            .otherwise(F.regexp_replace(s["value"], "[^0-9]", "")),
        ),
    )
    return F.array_distinct(names)


def _held(texts: DataFrame) -> DataFrame:
    """The different texts that hold an entity, stored: key, copies, entities and words of each, for a column `_text`."""
    spans = base_spans(texts.where(F.col("_text").rlike("|".join(_HINTS.values()))))
    entities, words = _entities_of(F.col("_base")), F.array_distinct(_words(F.col("_text")))
    rows = spans.select(text_key(F.col("_text")).alias("_key"), entities.alias("entities"), words.alias("terms"))
    rows = rows.where(F.size("entities") > 0).groupBy("_key", "entities", "terms").agg(F.count("*").alias("copies"))
    return stored(rows, "pii-held")


def _disclosing(texts: DataFrame, held: DataFrame, setting: Disclosure) -> DataFrame:
    """(entity, term, disclosure) of the texts in a column `_text`, of which `held` are those with an entity.

    Only entities of `support` texts can disclose anything by the definition, so only they meet the words of their texts;
    the pairs are summed by each task, by its different texts, before they meet.  An entity's count travels with it, and
    the words' counts are stored, so that a word beside very many entities can be split where they are joined.
    """
    named = held.select("_key", "copies", F.explode("entities").alias("entity"))
    known = named.groupBy("entity").agg(F.sum("copies").alias("entity_documents"), F.count("*").alias("texts"))
    known = known.where(F.col("texts") >= setting.support)
    listed = named.join(known, "entity").groupBy("_key").agg(F.collect_list(F.struct("entity", "entity_documents")).alias("known"))
    met = held.select("_key", "copies", "terms").join(listed, "_key").select("copies", "terms", F.explode("known").alias("e"))
    met = met.select("e.*", "copies", F.explode("terms").alias("term"))
    together = met.groupBy("entity", "entity_documents", "term").agg(F.sum("copies").alias("both"), F.count("*").alias("texts"))
    together = together.where(F.col("texts") >= setting.support)
    terms = texts.select(F.explode(F.array_distinct(_words(F.col("_text")))).alias("term"))
    terms = terms.groupBy("term").agg(F.count("*").alias("term_documents")).where(F.col("term_documents") >= setting.support)
    total = texts.agg(F.count("*").alias("documents"))
    n = F.col("documents").cast("double")
    information = F.log2(n / F.col("entity_documents"))
    mutual = F.log2(n * F.col("both") / (F.col("entity_documents") * F.col("term_documents")))
    pairs = together.join(stored(terms, "pii-terms"), "term").withColumn("documents", total.scalar())
    # An entity of every document holds no information that a term could give away.
    pairs = pairs.where(F.col("documents") > F.col("entity_documents"))
    pairs = pairs.withColumn("disclosure", F.round(mutual / information, 9))
    return pairs.where(F.col("disclosure") >= setting.generalise).select("entity", "term", "disclosure")


def disclosures(df: DataFrame, text: str = "text", setting: Disclosure = Disclosure()) -> DataFrame:
    """(entity, term, disclosure): every pair of the corpus that discloses `generalise` or more.

    Null texts count as documents without words; repeated rows count each as a document; an empty corpus gives no rows.
    """
    texts = df.select(F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_text"))
    return _disclosing(texts, _held(texts), setting)


def _term_pattern(terms: Column) -> Column:
    return F.concat(F.lit(r"(?iu)(?<!\p{L})(?:"), F.array_join(terms, "|"), F.lit(r")(?!\p{L})"))


def find(df: DataFrame, text: str = "text", setting: Disclosure = Disclosure()) -> DataFrame:
    """Adds `spans`, an array of (kind, first, end, value, action): base spans by kind and place, then disclosing terms.

    Places are code points, the end is exclusive.  The action is `mask` for base spans, `generalise` or `remove` for
    terms.  Null and empty texts have no spans; repeated rows are found alike; a column named `spans` gives way.
    Only texts with a base span and a disclosing term are shuffled.
    """
    kept = [c for c in df.columns if c.lower() != "spans"]
    source = df.select(*[F.col(f"`{c}`") for c in kept], F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_text"))
    found = base_spans(source)
    held = _held(source)
    pairs = _disclosing(source.select("_text"), held, setting)
    holding = found.where(F.size("_base") > 0)
    named = held.select("_key", F.explode("entities").alias("entity"))
    terms = named.join(pairs, "entity").groupBy("_key", "term").agg(F.max("disclosure").alias("disclosure"))
    terms = terms.groupBy("_key").agg(F.sort_array(F.collect_list(F.struct("term", "disclosure"))).alias("_terms"))
    holding = holding.withColumn("_key", text_key(F.col("_text"))).join(terms, "_key", "left")
    holding = _with_term_spans(holding, setting)
    masked = F.transform("_base", lambda s: F.struct(s["kind"], s["first"], s["end"], s["value"], F.lit("mask").alias("action")))
    with_terms = holding.select(*[F.col(f"`{c}`") for c in kept], F.concat(masked, F.col("_found")).alias("spans"))
    none = F.array().cast("array<struct<kind:string,first:int,end:int,value:string,action:string>>")
    without = found.where(F.size("_base") == 0).select(*[F.col(f"`{c}`") for c in kept], none.alias("spans"))
    return with_terms.unionByName(without)


def _with_term_spans(df: DataFrame, setting: Disclosure) -> DataFrame:
    none = F.array().cast("array<struct<kind:string,first:int,end:int,value:string,action:string>>")
    names = F.transform("_terms", lambda t: t["term"])
    pattern = _term_pattern(names)
    df = df.withColumn("_pattern", F.when(F.size("_terms") > 0, pattern))
    df = df.withColumn("_hits", F.when(F.col("_pattern").isNotNull(), F.regexp_extract_all("_text", F.col("_pattern"), F.lit(0))))
    df = df.withColumn("_gaps", F.when(F.size("_hits") > 0, F.split(F.col("_text"), F.col("_pattern"), -1)))
    df = df.withColumn("_sure", F.transform(F.filter("_terms", lambda t: t["disclosure"] >= setting.remove), lambda t: t["term"]))

    def span(hit, first):
        action = F.when(F.array_contains("_sure", F.lower(hit)), "remove").otherwise("generalise")
        return F.struct(
            F.lit("term").alias("kind"), first.alias("first"), (first + F.length(hit)).alias("end"), hit.alias("value"),
            action.alias("action"),
        )

    spans = F.zip_with("_hits", _firsts(F.col("_hits"), F.col("_gaps")), span)
    free = F.filter(spans, lambda s: ~F.exists("_base", lambda b: (b["first"] < s["end"]) & (s["first"] < b["end"])))
    return df.withColumn("_found", F.when(F.size("_hits") > 0, free).otherwise(none))


def sanitise(df: DataFrame, text: str = "text", setting: Disclosure = Disclosure()) -> DataFrame:
    """The rows with `text` made safe, and `spans` as found: base spans become their label, generalised terms the class
    of word they are ([NAME] if capitalised, else [TERM]), removed terms go.

    Spans that overlap are replaced as one, by the label of the first.  Null texts stay null.
    """
    found = find(df, text, setting)
    ordered = F.sort_array(F.transform("spans", lambda s: F.struct(s["first"], s["end"], s["kind"], s["value"], s["action"])))
    found = found.withColumn("_ordered", ordered)
    # End of all earlier spans: a span that begins before it belongs to the stretch of an earlier one.
    found = found.withColumn(
        "_reach",
        F.transform("_ordered", lambda s, i: F.coalesce(F.array_max(F.transform(F.slice("_ordered", 1, i), lambda p: p["end"])), F.lit(0))),
    )
    found = found.withColumn("_heads", F.filter(F.arrays_zip("_ordered", "_reach"), lambda z: z["_ordered"]["first"] >= z["_reach"]))
    body = F.col(f"`{text}`")

    def label(s):
        base = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in LABELS.items() for x in kv]), s["kind"]), F.lit(""))
        word = F.when(s["value"].rlike(r"^\p{Lu}"), "[NAME]").otherwise("[TERM]")
        return F.when(s["kind"] != "term", base).when(s["action"] == "remove", "").otherwise(word)

    def piece(z, i):
        """The label of a stretch and the plain text behind it."""
        last = i + 1 == F.size("_heads")
        until = F.when(last, F.length(body)).otherwise(F.get("_heads", i + 1)["_ordered"]["first"])
        reach = F.when(last, F.array_max(F.transform("_ordered", lambda s: s["end"]))).otherwise(F.get("_heads", i + 1)["_reach"])
        return F.concat(label(z["_ordered"]), F.substring(body, reach + 1, until - reach))

    head = F.substring(body, F.lit(1), F.get("_heads", F.lit(0))["_ordered"]["first"])
    clean = F.concat(head, F.array_join(F.transform("_heads", piece), ""))
    safe = F.when(F.size("spans") > 0, clean).otherwise(body)
    return found.select(*[safe.alias(c) if c == text else F.col(f"`{c}`") for c in df.columns if c.lower() != "spans"], "spans")


def digest(df: DataFrame, id_column: str = "doc_id", text: str = "text", setting: Disclosure = Disclosure()) -> DataFrame:
    """One row per document: counts of each base kind, SHA-256 of the base spans, and all spans as text."""
    spans = find(df.select(F.col(f"`{id_column}`").alias("doc_id"), F.col(f"`{text}`").alias("text")), "text", setting)
    show = lambda s: F.concat(s["kind"], F.lit(":"), s["first"].cast("string"), F.lit(":"), s["end"].cast("string"))
    base = F.filter("spans", lambda s: s["kind"] != "term")
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return spans.select(
        "doc_id",
        *[count(k) for k in KINDS],
        F.sha2(F.array_join(F.transform(base, show), ",").cast("binary"), 256).alias("base_sha256"),
        F.array_join(F.transform("spans", show), ",").alias("spans"),
    )


__all__: Sequence[str] = ("Disclosure", "base_spans", "digest", "disclosures", "find", "sanitise")
