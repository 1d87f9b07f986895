"""Personal data: base patterns and information-theoretic sanitisation of what reveals them.

Base spans are e-mail and IP addresses, card and phone numbers. Each distinct
value is a protected entity. A term t, a word outside base spans, discloses the
entity e by their pointwise mutual information, log p(e|t) / p(e), estimated from
document frequencies, of whole documents, over the whole corpus; as a share of the entity's own information,
-log p(e), it is 1 when seeing the term is as good as seeing the entity. Terms at
or above ``generalise`` are replaced by their kind (``<NAME>``, ``<NUMBER>``,
``<TERM>``), those at or above ``remove`` are deleted, wherever they stand in any
text; both need ``support`` different contexts, so that neither copies of one text
nor a single meeting of two rare words count as evidence. A context is what
surrounds a span, ``REACH`` characters on each side. A term met there counts once
for each of them, a term farther away once for the document.

Only DataFrame functions are used. Words are dealt with entities only for values
that have enough contexts; word frequencies are combined in the tasks before they
are dealt.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from ticktide.llm.tables import checkpointed

REACH = 80
AT_ONCE = 256              # parts of an array whose sums are taken together
MOST_BROADCAST = 100_000   # terms sent to all tasks; more are joined by a shuffle
KINDS = ("email", "ip", "card", "phone")
SPAN = "array<struct<start:int,end:int,value:string>>"

# The patterns of the contract, with possessive repeats and runs entered at their
# start or where the last match ended: the same matches in linear time.
LOCAL, LABEL = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{LOCAL})){LOCAL}++@{LABEL}++(?:\.{LABEL}++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# What every match contains; texts without it are not searched.
HINTS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"(?:[0-9][\x20-]?){12}[0-9]", "phone": r"\+[0-9]"}
OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
WORD_BREAK = r"[^\p{L}\p{N}]"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _holds(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")
    if kind == "card":
        return F.length(_digits(value)).between(13, 19) & F.call_function("luhn_check", _digits(value))
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    return F.lit(True)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once, also where the body is evaluated for many elements."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _groups(items: Column) -> Column:
    """An array cut into arrays of ``AT_ONCE``; an empty one has one empty group."""
    return _let(items, lambda all_: F.transform(
        F.sequence(F.lit(0), F.greatest(F.size(all_) - 1, F.lit(0)), F.lit(AT_ONCE)),
        lambda i: F.slice(all_, i + 1, F.lit(AT_ONCE))))


def placed(parts: Column, item: Callable[[Column, Column], Column]) -> Column:
    """``item(end, part)`` of every part of an array; ``end`` is the sum of the sizes up to it.

    An array that grows by one is copied each time. So parts are taken ``AT_ONCE``
    a time: sums of these groups first, then the sums inside each of them.
    """
    def ends(sizes: Column) -> Column:
        """Running sums, a zero first."""
        return F.aggregate(sizes, F.array(F.lit(0)), lambda sums, size: F.concat(
            sums, F.array(F.element_at(sums, -1) + size)))

    def group(g: Column, start: Column) -> Column:
        own = F.slice(ends(F.transform(g, lambda p: p["size"])), 2, AT_ONCE)
        return F.when(g.isNotNull(), F.zip_with(g, own, lambda p, end: item(start + end, p)))

    def all_groups(groups: Column) -> Column:
        starts = ends(F.transform(groups, lambda g: F.aggregate(g, F.lit(0), lambda total, p: total + p["size"])))
        return F.flatten(F.filter(F.zip_with(groups, starts, group), lambda g: g.isNotNull()))

    return _let(_groups(parts), all_groups)


def base_spans(text: Column, kind: str) -> Column:
    """Array of (start, end, value) in code points, in order."""
    pattern = F.lit(PATTERNS[kind])
    # The text between matches tells where they are.
    parts = F.zip_with(
        F.split(text, PATTERNS[kind], -1), F.regexp_extract_all(text, pattern, F.lit(0)),
        lambda gap, value: F.struct(F.length(gap).alias("gap"), value.alias("value")))
    parts = F.filter(parts, lambda p: p["value"].isNotNull())

    parts = F.transform(parts, lambda p: F.struct(
        (p["gap"] + F.length(p["value"])).alias("size"), F.length(p["value"]).alias("own"), p["value"].alias("value")))
    none = F.array().cast(SPAN)
    spans = placed(parts, lambda end, p: F.struct(
        (end - p["own"]).alias("start"), end.alias("end"), p["value"].alias("value")))
    held = F.filter(spans, lambda s: _holds(kind, s["value"]))
    return F.when(text.rlike(HINTS[kind]), held).otherwise(none)


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"),
                       F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))


def found(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, text_hash, an array of spans per kind, the surroundings of each, and the words outside them."""
    rows = _rows(docs, id_col, text_col).select(
        "doc_id", "text", F.xxhash64("text").alias("text_hash"),
        *[base_spans(F.col("text"), kind).alias(kind) for kind in KINDS])

    def around(kind: str) -> Column:
        # A group of spans cuts its part out of the text once; so no span walks the whole text.
        parts = F.transform(F.filter(_groups(F.col(kind)), lambda g: F.size(g) > 0), lambda g: F.struct(
            g.alias("spans"), F.greatest(g[0]["start"] - REACH, F.lit(0)).alias("at"), F.length("text").alias("n"),
            F.substring(F.col("text"), F.greatest(g[0]["start"] - REACH, F.lit(0)) + 1,
                        F.element_at(g, -1)["end"] - g[0]["start"] + 2 * REACH).alias("text")))
        return F.flatten(F.transform(parts, lambda part: F.transform(part["spans"], lambda s: F.struct(
            F.concat(F.lit(f"{kind}:"), F.lower(s["value"])).alias("entity"),
            s["start"].alias("start"), s["end"].alias("end"),
            F.substring(part["text"], F.greatest(F.lit(0), s["start"] - REACH) - part["at"] + 1,
                        F.least(F.lit(REACH), s["start"])).alias("left"),
            F.substring(part["text"], s["end"] - part["at"] + 1, F.lit(REACH)).alias("right"),
            (s["start"] > REACH).alias("cut_left"),
            (s["end"] + REACH < part["n"]).alias("cut_right")))))

    blanks = F.sort_array(F.concat(*[F.transform(kind, lambda s: F.struct(
        s["start"], s["end"], F.lit(" ").alias("mark"))) for kind in KINDS]))
    words = F.filter(_distinct_words(sanitised_text(F.col("text"), blanks)), lambda w: F.length(w) >= 3)
    return rows.select("doc_id", "text_hash", *KINDS, F.concat(*map(around, KINDS)).alias("around"),
                       F.when(F.size(blanks) > 0, words).alias("words"))


def _distinct_words(text: Column) -> Column:
    return F.array_distinct(F.transform(F.split(text, WORD_BREAK, -1), F.lower))


def _shape(word: Column) -> Column:
    return F.when(word.rlike(r"^\p{N}+$"), "NUMBER").when(word.rlike(r"^\p{Lu}"), "NAME").otherwise("TERM")


def _words(snippet: Column) -> Column:
    return F.transform(F.split(snippet, WORD_BREAK, -1), F.lower)


def contexts(spans: DataFrame) -> DataFrame:
    """One row per span: doc_id, text_hash, entity, context and the words in it."""
    one = spans.select("doc_id", "text_hash", F.explode("around").alias("s")).select(
        "doc_id", "text_hash", "s.*", F.xxhash64("s.left", "s.right").alias("context"))
    left, right = _words(F.col("left")), _words(F.col("right"))
    # Words that the snippet's border may cut are left out.
    left = F.when(F.col("cut_left"), F.slice(left, 2, 10_000)).otherwise(left)
    kept = F.when(F.col("cut_right"), F.slice(right, F.lit(1), F.greatest(F.size(right) - 1, F.lit(0)))).otherwise(right)
    return one.select("doc_id", "text_hash", "entity", "context", F.array_distinct(F.concat(left, kept)).alias("near"))


def disclosures(rows: DataFrame, spans: DataFrame, support: int) -> DataFrame:
    """(entity, term, share) for pairs met in enough contexts; share of the entity's information."""
    near = checkpointed(contexts(spans))
    # No pair has more contexts than its entity.
    often = near.select("entity", "context").distinct().groupBy("entity").count().filter(F.col("count") >= support)
    near = checkpointed(near.join(often.select("entity"), "entity", "left_semi"))
    document = ["doc_id", "text_hash"]
    entities = near.groupBy("entity", *document).agg(F.min("context").alias("context"))
    words = spans.filter(F.col("words").isNotNull()).select(
        F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), "words").dropDuplicates(["__id", "__hash"])
    far = entities.join(words, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("text_hash") == F.col("__hash"))).select(
        "entity", *document, F.explode("words").alias("term"), "context", F.lit(False).alias("is_near"))
    close = near.select("entity", *document, F.explode("near").alias("term"), "context", F.lit(True).alias("is_near"))
    met = far.unionByName(close.filter(F.length("term") >= 3)).groupBy("entity", "term", *document).agg(
        F.collect_set(F.when(F.col("is_near"), F.col("context"))).alias("near"),
        F.min(F.when(~F.col("is_near"), F.col("context"))).alias("context"))
    met = met.select("entity", "term", *document, F.explode(
        F.when(F.size("near") > 0, F.col("near")).otherwise(F.array("context"))).alias("context"),
        F.when(F.size("near") > 0, 1 / F.size("near")).otherwise(1.0).alias("part"))
    # The parts of a document add up to one.
    met = checkpointed(met.groupBy("entity", "term", "context").agg(F.sum("part").alias("docs"))
                       .groupBy("entity", "term").agg(F.count("*").alias("n_contexts"), F.round(F.sum("docs")).alias("both"))
                       .filter(F.col("n_contexts") >= support))
    n_entity = entities.groupBy("entity").agg(F.count("*").alias("n_entity"))
    wanted = met.select("term").distinct()
    terms = (rows.select(F.explode(_distinct_words(F.col("text"))).alias("term")).groupBy("term")
             .agg(F.count("*").alias("n_term")).join(wanted, "term"))
    total = F.lit(float(max(1, rows.count())))
    joined = met.join(n_entity, "entity").join(terms, "term")
    own = -F.log(F.col("n_entity") / total)
    mutual = F.log(F.least(F.lit(1.0), F.col("both") / F.col("n_term")) / (F.col("n_entity") / total))
    return joined.select("entity", "term", F.when(own > 0, mutual / own).otherwise(0.0).alias("share"))


def _places(text: Column, shares: Column, remove: float) -> Column:
    """Array of (start, end, mark) of all words of a text that ``shares``, a map, has."""

    def place(end: Column, p: Column) -> Column:
        # A break is one character, so places are sums of lengths.
        word, share = p["word"], F.element_at(shares, F.lower(p["word"]))
        mark = F.when(share >= remove, "").otherwise(F.concat(F.lit("<"), _shape(word), F.lit(">")))
        return F.when(share.isNotNull(), F.struct(
            (end - p["size"]).alias("start"), (end - 1).alias("end"), mark.alias("mark")))

    words = F.transform(F.split(text, WORD_BREAK, -1), lambda w: F.struct((F.length(w) + 1).alias("size"), w.alias("word")))
    return F.filter(placed(words, place), lambda t: t.isNotNull())


def term_spans(docs: DataFrame, spans: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               generalise: float = 0.8, remove: float = 0.95, support: int = 3) -> DataFrame:
    """Per document with any: doc_id, text_hash, terms, an array of (start, end, mark).

    All words of all texts that disclose some entity, those inside base spans included.
    """
    rows = _rows(docs, id_col, text_col).withColumn("text_hash", F.xxhash64("text"))
    strong = disclosures(rows, spans, support).filter(F.col("share") >= generalise)
    # A term of several entities is removed if any of them asks for it.
    strong = checkpointed(strong.groupBy("term").agg(F.max("share").alias("share")))
    # Every word of the corpus meets this table: where it is small, without being dealt.
    if strong.count() <= MOST_BROADCAST:
        strong = F.broadcast(strong)
    hits = rows.select("doc_id", "text_hash", F.explode(_distinct_words(F.col("text"))).alias("term")).join(strong, "term")
    hits = hits.groupBy(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), "term").agg(
        F.max("share").alias("share")).groupBy("__id", "__hash").agg(
        F.map_from_entries(F.collect_list(F.struct("term", "share"))).alias("shares"))
    placed = rows.join(hits, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("text_hash") == F.col("__hash")))
    return placed.select("doc_id", "text_hash", _places(F.col("text"), F.col("shares"), remove).alias("terms")
                         ).dropDuplicates(["doc_id", "text_hash"])


def outside(terms: Column, base: Column) -> Column:
    """The terms that overlap no base span."""
    return F.filter(terms, lambda t: ~F.exists(base, lambda b: (t["start"] < b["end"]) & (t["end"] > b["start"])))


def pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Per row: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_terms.

    Spans are ``kind:start:end`` in code points, end exclusive, by kind and start;
    those of the method have the kind ``term`` and come last. A null or empty
    text has none. Rows equal in id and text get equal spans. Other columns are
    not looked at.
    """
    spans = checkpointed(found(docs, id_col, text_col))
    terms = term_spans(docs, spans, id_col, text_col, **options)
    terms = terms.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), "terms")
    joined = spans.drop("around", "words").join(
        terms, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("text_hash") == F.col("__hash")), "left")

    def written(kind: str, spans_of: Column) -> Column:
        return F.transform(spans_of, lambda s: F.concat_ws(
            ":", F.lit(kind), s["start"].cast("string"), s["end"].cast("string")))

    base = F.concat(*[written(kind, F.col(kind)) for kind in KINDS])
    extra = F.coalesce(written("term", outside(F.col("terms"), F.concat(*KINDS))), F.array().cast("array<string>"))
    return joined.select(
        "doc_id", *[F.size(kind).cast("long").alias(f"n_{kind}") for kind in KINDS],
        F.sha2(F.array_join(base, ","), 256).alias("base_sha256"),
        F.array_join(F.concat(base, extra), ",").alias("spans"),
        F.size(extra).cast("long").alias("n_terms"))


def sanitised_text(text: Column, marks: Column) -> Column:
    """A text with its sorted (start, end, mark) replaced; what overlaps goes under the first mark.

    Marks are taken ``AT_ONCE`` a time, see `placed`: each group begins where the
    marks before it have come to, and cuts its own part out of the text once.
    """
    def ends(groups: Column) -> Column:
        """Where the marks of each group and those before it come to, a zero first."""
        own = F.transform(groups, lambda g: F.aggregate(g, F.lit(0), lambda end, m: F.greatest(end, m["end"])))
        return F.aggregate(own, F.array(F.lit(0)), lambda out, end: F.concat(
            out, F.array(F.greatest(F.element_at(out, -1), end))))

    def parts(groups: Column, reached: Column) -> Column:
        return F.transform(groups, lambda g, i: F.struct(
            g.alias("marks"), F.get(reached, i).alias("at"),
            F.substring(text, F.get(reached, i) + 1, F.get(reached, i + 1) - F.get(reached, i)).alias("text")))

    def replaced(part: Column) -> Column:
        def step(state: Column, m: Column) -> Column:
            gap = F.substring(part["text"], state["at"] - part["at"] + 1, F.greatest(m["start"] - state["at"], F.lit(0)))
            mark = F.when(m["start"] >= state["at"], m["mark"]).otherwise("")
            return F.struct(F.greatest(state["at"], m["end"]).alias("at"),
                            F.concat(state["out"], F.array(gap, mark)).alias("out"))

        start = F.struct(part["at"].alias("at"), F.array().cast("array<string>").alias("out"))
        return F.aggregate(part["marks"], start, step, lambda s: F.array_join(s["out"], ""))

    return _let(_groups(marks), lambda groups: _let(ends(groups), lambda reached: F.concat(
        F.array_join(F.transform(parts(groups, reached), replaced), ""),
        F.substring(text, F.element_at(reached, -1) + 1, F.length(text)))))


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with the same columns and sanitised texts; base spans become ``<EMAIL>`` and so on."""
    spans = checkpointed(found(docs, id_col, text_col))
    terms = term_spans(docs, spans, id_col, text_col, **options)

    def marked(kind: str) -> Column:
        return F.transform(kind, lambda s: F.struct(s["start"], s["end"], F.lit(f"<{kind.upper()}>").alias("mark")))

    base = spans.select(
        F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), F.concat(*map(marked, KINDS)).alias("__base")
    ).dropDuplicates(["__id", "__hash"])
    extra = terms.select(F.col("doc_id").alias("__id2"), F.col("text_hash").alias("__hash2"), F.col("terms").alias("__terms"))
    marks = base.join(extra, F.col("__id").eqNullSafe(F.col("__id2")) & (F.col("__hash") == F.col("__hash2")), "left")
    terms = F.coalesce(outside(F.col("__terms"), F.col("__base")),
                       F.array().cast("array<struct<start:int,end:int,mark:string>>"))
    marks = marks.select("__id", "__hash", F.sort_array(F.concat("__base", terms)).alias("__marks"))
    marks = marks.filter(F.size("__marks") > 0)
    text = F.col(f"`{text_col}`")
    joined = docs.withColumn("__own", F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))).join(
        marks, F.col(f"`{id_col}`").eqNullSafe(F.col("__id")) & (F.col("__own") == F.col("__hash")), "left")
    return joined.select(*[
        F.when(F.col("__marks").isNull(), F.col(f"`{c}`")).otherwise(sanitised_text(text, F.col("__marks"))).alias(c)
        if c == text_col else F.col(f"`{c}`") for c in docs.columns])
