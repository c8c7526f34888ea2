"""Personal data: pattern spans and information-theoretic sanitisation, with
DataFrame functions only.

Base spans come from four patterns with their checks.  Positions are code
points: the text is cut at the matches, and lengths of the pieces between
matches and of the matches add up to starts and ends.

A term in the document of a protected entity may give the entity away although it is no
personal data itself.  The corpus tells how strongly: with N documents, the
disclosure of entity e by term t is

    1 + log2 P(e | t) / -log2 P(e),    P(e | t) = n(e, t) / n(t)

the share of the entity's information content that the term reveals
(pointwise mutual information over information content; 1: the term stands
for the entity, 0: independent).  All counts are of different texts, so copies
of a document are one observation: N of all, n(t) with the term, n(e) with the
entity, n(e, t) with both, wherever they stand.  A term is a word outside base
spans.  A pair needs ``MIN_CONTEXTS`` different contexts before anything can be
estimated; the context of a pair in a text is the words around the first place
of the term and the first place of the entity.  Throughout every document that
holds the entity, terms whose disclosure reaches ``GENERALISE`` become
``[TERM]``, those that reach ``REMOVE`` are removed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import materialize

# Kinds in the order of results, their patterns with possessive
# repetition (same matches, no recursion on long runs), and a cheap pattern
# that every text with a match contains.  A match of the first two cannot
# start inside a run of their first characters unless the last match ended
# there (\\G), so a long run is tried once, not from each of its characters.
KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}+",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
GATES = {"email": "@", "ip": r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){15}", "phone": r"\+[0-9]"}

CONTEXT_CHARS = 60  # around an entity, up to the end of the word
CONTEXT_WORDS = 5  # on each side of a term
MIN_CONTEXTS = 3
GENERALISE = 0.85
REMOVE = 0.95
SALTS = 32  # shares of the rows that hold one text
_HIDDEN = "\ufdd0"  # a noncharacter in place of every character of a base span
_TERM = rf"(?<![\p{{L}}{_HIDDEN}])\p{{L}}{{3,}}+(?!{_HIDDEN})"


def _valid(kind: str, found: Column) -> Column:
    if kind == "ip":
        parts = F.transform(F.split(found, r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", ""))
        return F.forall(parts, lambda p: (F.length(p) < 3) | ((F.length(p) == 3) & (p <= "255")))
    digits = F.regexp_replace(found, "[^0-9]", "")
    if kind == "phone":
        return F.length(digits).between(8, 15)
    if kind == "card":
        # from the right, every second digit counts double, less nine above nine
        back = F.reverse(digits)

        def worth(i: Column) -> Column:
            d = F.substr(back, i, F.lit(1)).cast("int")
            doubled = d * 2
            return F.when(i % 2 == 1, d).otherwise(F.when(doubled > 9, doubled - 9).otherwise(doubled))

        total = F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda acc, i: acc + worth(i))
        return F.when(F.length(digits).between(16, 19), total % 10 == 0).otherwise(False)
    return F.lit(True)


_SPANS = "array<struct<kind:string,start:int,end:int,value:string>>"


def _spans(text: Column, kind: str) -> Column:
    """All matches of a kind that pass its check, as ``_SPANS``."""
    pattern = F.lit(PATTERNS[kind])
    both = F.struct(F.regexp_extract_all(text, pattern, F.lit(0)).alias("m"), F.split(text, PATTERNS[kind], -1).alias("p"))
    empty = F.array().cast(_SPANS)

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["p"])
        end = start + F.length(x["m"])
        span = F.struct(F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"), x["m"].alias("value"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))

    def locate(x: Column) -> Column:
        zipped = F.zip_with(x["m"], F.slice(x["p"], F.lit(1), F.size(x["m"])), lambda m, p: F.struct(m.alias("m"), p.alias("p")))
        return F.aggregate(zipped, F.struct(F.lit(0).alias("at"), empty.alias("out")), step, lambda acc: acc["out"])

    located = F.transform(F.array(both), locate)[0]
    checked = F.filter(located, lambda s: _valid(kind, s["value"]))
    gate = text.contains("@") if kind == "email" else text.rlike(GATES[kind])
    return F.when(gate, checked).otherwise(empty)


def find_spans(docs: DataFrame, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, text_hash, spans`` for every row: base spans by kind, then start.
    ``text_hash`` tells apart rows that share an id.  A null text is empty."""
    t = F.coalesce(F.col(text), F.lit(""))
    src = docs.select(F.col(ident).alias("id"), t.alias("text"))
    src = src.select("id", "text", F.xxhash64("text").alias("text_hash"), *[_spans(F.col("text"), k).alias(k) for k in KINDS])
    return src.withColumn("spans", F.concat(*KINDS)).drop(*KINDS)


def _open(text: Column, spans: Column) -> Column:
    """``text`` with the characters of base spans hidden, places unchanged."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def hide(acc: Column, s: Column) -> Column:
        gap = F.substr(text, acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
        hidden = F.repeat(F.lit(_HIDDEN), F.greatest(s["end"] - F.greatest(acc["at"], s["start"]), F.lit(0)))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.concat(acc["out"], gap, hidden).alias("out"))

    places = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))))
    hidden = F.aggregate(places, start, hide, lambda acc: F.concat(acc["out"], F.substr(text, acc["at"] + 1)))
    return F.when(F.size(spans) > 0, hidden).otherwise(text)


def _words(text: Column) -> Column:
    return F.transform(F.regexp_extract_all(text, F.lit(_TERM), F.lit(0)), F.lower)


def _texts(docs: DataFrame, text: str) -> DataFrame:
    """``text, text_hash, spans, open`` of every different text."""
    each = docs.select(F.coalesce(F.col(text), F.lit("")).alias("text")).distinct()
    return find_spans(each, "text").drop("id").withColumn("open", _open(F.col("text"), F.col("spans")))


def _mentions(held: DataFrame) -> DataFrame:
    """``text_hash, entity, near`` for every entity of a text; ``near`` is a
    hash of the characters around its first place, cut at word ends."""

    def around(s: Column) -> Column:
        left = F.greatest(s["start"] - CONTEXT_CHARS, F.lit(0))
        before = F.regexp_replace(F.substr(F.col("text"), left + 1, s["start"] - left), r"^\S+\s", "")
        after = F.regexp_replace(F.substr(F.col("text"), s["end"] + 1, F.lit(CONTEXT_CHARS)), r"\s\S+$", "")
        entity = F.concat(s["kind"], F.lit(":"), F.lower(s["value"]))
        return F.struct(entity.alias("entity"), s["start"].alias("start"), F.xxhash64(before, after).alias("near"))

    rows = held.select("text_hash", F.explode(F.transform("spans", around)).alias("s"))
    return rows.groupBy("text_hash", "s.entity").agg(F.min(F.struct("s.start", "s.near")).alias("first")).select("text_hash", "entity", F.col("first.near").alias("near"))


def _together(held: DataFrame, mentions: DataFrame) -> DataFrame:
    """``text_hash, entity, near, term, around`` for every entity of
    ``mentions`` and term of a text; ``around`` is a hash of the words around
    the first place of the term."""
    own = mentions.groupBy("text_hash").agg(F.collect_list(F.struct("entity", "near")).alias("entities"))
    rows = held.join(own, "text_hash").select("text_hash", "entities", _words(F.col("open")).alias("words"), F.split("open", _TERM, -1).alias("gaps"))

    def place(word: Column, i: Column) -> Column:
        # single elements, as a slice of an array reads all of it
        near = range(-CONTEXT_WORDS, CONTEXT_WORDS + 1)
        words = [F.get("words", i + d) for d in near]
        gaps = [F.when(i + d >= 1, F.get("gaps", i + d)) for d in near[1:]]
        around = F.xxhash64(*[F.coalesce(x, F.lit("")) for x in [*words, *gaps]])
        return F.struct(word.alias("term"), i.alias("i"), around.alias("around"))

    # sorted by term and place, the first place of a term follows another term
    rows = rows.select("text_hash", "entities", F.sort_array(F.transform("words", place)).alias("places"))
    firsts = F.filter("places", lambda p, j: ~F.get("places", j - 1)["term"].eqNullSafe(p["term"]))
    rows = rows.select("text_hash", "entities", F.explode(firsts).alias("p"))
    return rows.select("text_hash", F.explode("entities").alias("e"), "p.term", "p.around").select("text_hash", "e.entity", "e.near", "term", "around")


def disclosing_terms(held: DataFrame, docs: DataFrame, text: str = "text", min_contexts: int = MIN_CONTEXTS, threshold: float = GENERALISE) -> DataFrame:
    """``entity, term, disclosure`` for the pairs that reach ``threshold``.
    ``held`` is a written frame of the different texts with base spans; terms
    and entities are counted over all different texts of ``docs``."""
    mentions = _mentions(held)
    # an entity of fewer texts has no pair with the support
    entities = materialize(mentions.groupBy("entity").agg(F.count(F.lit(1)).alias("n_e")).where(F.col("n_e") >= min_contexts), "entities")
    near = _together(held, mentions.join(entities.select("entity"), "entity"))
    pairs = near.groupBy("entity", "term", F.xxhash64("near", "around").alias("context")).agg(F.count(F.lit(1)).alias("n"))
    pairs = pairs.groupBy("entity", "term").agg(F.sum("n").alias("n_et"), F.count(F.lit(1)).alias("contexts"))
    pairs = pairs.where(F.col("contexts") >= min_contexts).drop("contexts")
    texts = _texts(docs, text)
    words = texts.select(F.explode(F.array_distinct(_words(F.col("open")))).alias("term"))
    frequency = words.groupBy("term").agg(F.count(F.lit(1)).alias("n_t"))
    rows = materialize(pairs, "pairs").join(entities, "entity").join(frequency, "term")
    n = docs.select(F.count_distinct(F.xxhash64(F.coalesce(F.col(text), F.lit("")))).alias("n")).first()["n"]
    information = -F.log2(F.col("n_e") / F.lit(max(n, 1)))
    disclosure = F.when(information > 0, 1 + F.log2(F.col("n_et") / F.col("n_t")) / information).otherwise(F.lit(0.0))
    return rows.select("entity", "term", disclosure.alias("disclosure")).where(F.col("disclosure") >= threshold)


def _places(words: Column, gaps: Column, strong: Column) -> Column:
    """Every place of the words that ``strong`` maps to what to do."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("out"))

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + F.length(x["gap"])
        end = begin + F.length(x["raw"])
        do = F.element_at(strong, F.lower(x["raw"]))
        place = F.struct(F.lit("term").alias("kind"), begin.alias("start"), end.alias("end"), do.alias("value"))
        return F.struct(end.alias("at"), F.when(do.isNull(), acc["out"]).otherwise(F.concat(acc["out"], F.array(place))).alias("out"))

    both = F.zip_with(words, F.slice(gaps, F.lit(1), F.size(words)), lambda w, g: F.struct(w.alias("raw"), g.alias("gap")))
    return F.aggregate(both, start, step, lambda acc: acc["out"])


def sanitise_spans(docs: DataFrame, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, text_hash, spans, terms`` for every row of ``docs``: base spans
    and the disclosing terms (``kind`` is ``term``, ``value`` what to do:
    ``[TERM]`` or nothing).  Other columns are ignored; an empty table gives
    an empty one; repeated rows get the same spans each."""
    base = find_spans(docs, ident, text)
    found = materialize(base.drop("text"), "spans")
    # hidden characters are made once, after equal texts are merged
    held = base.where(F.size("spans") > 0).select("text").distinct()
    held = materialize(_texts(held, "text"), "held")
    strong = materialize(disclosing_terms(held, docs, text), "strong")
    mentions = _mentions(held).join(strong.select("entity").distinct(), "entity")
    near = _together(held, mentions).join(strong, ["entity", "term"])
    action = F.when(F.max("disclosure") >= REMOVE, F.lit("")).otherwise(F.lit("[TERM]"))
    added = near.groupBy("text_hash", "term").agg(action.alias("value")).groupBy("text_hash").agg(F.map_from_entries(F.collect_list(F.struct("term", "value"))).alias("strong"))
    places = _places(F.regexp_extract_all("open", F.lit(_TERM), F.lit(0)), F.split("open", _TERM, -1), F.col("strong"))
    added = held.join(added, "text_hash").select(F.col("text_hash").alias("a_hash"), places.alias("terms"))
    # only texts with base spans can have terms; copies of one text are dealt
    # by id, so a group of them does not meet in one task
    none = F.array().cast(_SPANS)
    salt = F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int")
    dealt = added.withColumn("a_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    joined = found.where(F.size("spans") > 0).withColumn("salt", salt).join(dealt, (F.col("text_hash") == F.col("a_hash")) & (F.col("salt") == F.col("a_salt")), "left")
    with_spans = joined.select("id", "text_hash", "spans", F.coalesce("terms", none).alias("terms"))
    return with_spans.unionByName(found.where(F.size("spans") == 0).select("id", "text_hash", "spans", none.alias("terms")))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def sanitise(docs: DataFrame, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the same columns, base spans in ``text`` replaced by
    their kind (``[EMAIL]``) and disclosing terms generalised or removed.
    Where spans overlap, the one that starts first (the longer, the earlier
    kind) is replaced and the rest of the others with it.  Null texts stay null."""
    found = sanitise_spans(docs, ident, text).where((F.size("spans") > 0) | (F.size("terms") > 0)).dropDuplicates(["id", "text_hash"])
    # the row travels as one struct, so its columns may have any name
    value = F.coalesce(F.col(text), F.lit(""))
    own = docs.select(F.struct(*docs.columns).alias("row"), F.col(ident).alias("own_id"), value.alias("value"), F.xxhash64(value).alias("own_hash"))
    rows = own.join(found, F.col("own_id").eqNullSafe(F.col("id")) & (F.col("own_hash") == F.col("text_hash")), "left")
    spans = F.concat(
        F.transform("spans", lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("end"), F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")).alias("by"))),
        F.transform("terms", lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("end"), s["value"].alias("by"))),
    )
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def put(acc: Column, s: Column) -> Column:
        gap = F.substr(F.col("value"), acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
        by = F.when(s["start"] >= acc["at"], s["by"]).otherwise(F.lit(""))
        return F.struct(F.greatest(acc["at"], -s["end"]).alias("at"), F.concat(acc["out"], gap, by).alias("out"))

    masked = F.aggregate(F.array_sort(spans), start, put, lambda acc: F.concat(acc["out"], F.substr(F.col("value"), acc["at"] + 1)))
    clean = F.when(F.col("spans").isNotNull(), masked).otherwise(F.col("row")[text])
    return rows.select(*[(clean if c == text else F.col("row")[c]).alias(c) for c in docs.columns])


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all ``documents``: counts, digest and spans."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = sanitise_spans(docs)

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return rows.select(
        F.col("id").alias("doc_id"), *[count(k) for k in KINDS], F.sha2(_joined(F.col("spans")), 256).alias("base_sha256"), _joined(F.concat("spans", "terms")).alias("spans"),
        F.size("terms").cast("long").alias("n_term"),
    )
