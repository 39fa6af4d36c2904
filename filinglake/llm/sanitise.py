"""Information-theoretic sanitisation, in DataFrame functions only.

Entities are the values of the base patterns (mail address, IP address, card and phone number). Words
within CONTEXT characters of an entity are its context. Counting documents, with n of them, n(e)
holding entity e, n(t) holding term t and n(t, e) holding t in a context of e,

    PMI(t; e) = log2(n(t, e) * n / (n(t) * n(e))),   IC(e) = log2(n / n(e)),

so PMI / IC is the share of the entity's information that the term gives away. A term seen with the
entity in at least SUPPORT different texts whose share reaches GENERALISE is replaced by a class word near that
entity; one that gives away everything (share REMOVE) is removed. Terms are counted in all texts.

Defined cases: null counts as empty; copies of a text count as documents, but once for SUPPORT; an entity
that all texts hold has no information and protects no terms; digits after code points beyond the BMP
keep their places (spans count code points); empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filinglake.llm import common, spans

KINDS = ["email", "ip", "card", "phone"]
# Fixed patterns of the contract, with possessive quantifiers where giving back can't help a match. A run of
# characters that may begin a match is tried once: at its start, or where the last match ended.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
WORD = r"\p{L}{3,}+"
CONTEXT = 64
SUPPORT = 2
GENERALISE, REMOVE = 0.6, 1.0
# Rows of a table of candidate terms (8 bytes each) that may be broadcast; beyond, the join shuffles.
BROADCAST_TERMS = 250_000
# Spans (some 50 bytes each) of all texts that may be broadcast as edits; beyond, the join shuffles the texts.
BROADCAST_EDITS = 50_000


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""

    def add(total: Column, place: Column) -> Column:
        digit = F.substring(digits, -place, F.lit(1)).cast("int") * F.when(place % 2 == 0, 2).otherwise(1)
        return total + digit - F.when(digit > 9, 9).otherwise(0)

    places = F.sequence(F.lit(1), F.greatest(F.length(digits), F.lit(1)))
    return F.aggregate(places, F.lit(0), add) % 10 == 0


def _small(part: Column) -> Column:
    """Whether a run of digits is at most 255, however many zeros lead it."""
    short = F.ltrim(part, F.lit("0"))
    return (F.length(short) <= 3) & (F.concat(F.lit("0"), F.substring(short, 1, 3)).cast("int") <= 255)


def base_spans(text: Column) -> dict[str, Column]:
    """Spans of each kind in a cleaned text."""
    found = {
        "email": spans.matches(text, PATTERNS["email"], F.contains(text, F.lit("@"))),
        "ip": spans.matches(text, PATTERNS["ip"]),
        "card": spans.matches(text, PATTERNS["card"], text.rlike(r"(?:[0-9][\x20-]?+){16}")),
        "phone": spans.matches(text, PATTERNS["phone"], F.contains(text, F.lit("+"))),
    }
    number = lambda s: F.length(_digits(s["value"]))
    return {
        "email": found["email"],
        "ip": F.filter(found["ip"], lambda s: F.forall(F.split(s["value"], r"\."), _small)),
        "card": F.filter(found["card"], lambda s: number(s).between(16, 19) & luhn(_digits(s["value"]))),
        "phone": F.filter(found["phone"], lambda s: number(s).between(8, 15)),
    }


def _context(text: Column, span: Column) -> Column:
    """Words wholly within CONTEXT characters of a span, with their places in the text."""
    low = F.greatest(span["start"] - CONTEXT, F.lit(0))
    before = F.substring(text, low + 1, span["start"] - low)
    after = F.substring(text, span["end"] + 1, F.lit(CONTEXT))
    left = F.filter(spans.matches(before, WORD), lambda w: (w["start"] > 0) | (low == 0))
    right = F.filter(spans.matches(after, WORD), lambda w: (w["end"] < CONTEXT) | (span["end"] + CONTEXT >= F.length(text)))
    moved = lambda words, by: F.transform(
        words, lambda w: F.struct((w["start"] + by).alias("start"), (w["end"] + by).alias("end"), F.lower(w["value"]).alias("term"))
    )
    return F.concat(moved(left, low), moved(right, span["end"]))


def _described(text: Column, kind: str, order: int):
    """Turns a span of a kind into (order, start, end, kind, entity, context)."""

    def one(s: Column) -> Column:
        value = F.lower(s["value"]) if kind in ("email", "ip") else _digits(s["value"])
        return F.struct(
            F.lit(order).alias("order"),
            s["start"].alias("start"),
            s["end"].alias("end"),
            F.lit(kind).alias("kind"),
            F.concat(F.lit(f"{kind}:"), value).alias("entity"),
            _context(text, s).alias("context"),
        )

    return one


def _number(array: Column, kind: str) -> Column:
    return F.size(F.filter(array, lambda s: s["kind"] == kind)).cast("long")


def _entities(documents: DataFrame) -> DataFrame:
    """doc_id, digest and found (kind, order, start, end, entity, context) of every row; written once, without texts."""

    def found(text: Column) -> Column:
        own = base_spans(text)
        return F.concat(*[F.transform(own[kind], _described(text, kind, order)) for order, kind in enumerate(KINDS)])

    rows = documents.select(
        F.col("doc_id").cast("long"),
        common.digest(F.col("text")).alias("digest"),
        spans.let(spans.clean(F.col("text")), found).alias("found"),
    )
    return common.land(rows, "pii-entities")


def _contexts(entities: DataFrame) -> DataFrame:
    """(digest, entity, term, start, end) once per text; only rows with an entity get so far."""
    held = entities.where(F.size("found") > 0).select("digest", "found").dropDuplicates(["digest"])
    return held.select("digest", F.explode("found").alias("f")).select(
        "digest", "f.entity", F.explode("f.context").alias("w")
    ).select("digest", "entity", "w.term", "w.start", "w.end")


def disclosing(documents: DataFrame, entities: DataFrame) -> DataFrame:
    """(entity, term, share) of the terms that give away at least GENERALISE of an entity's information."""
    holding = entities.where(F.size("found") > 0)
    copies = holding.groupBy("digest").agg(F.count(F.lit(1)).alias("copies"))
    joint = (
        _contexts(entities)
        .select("entity", "term", "digest")
        .distinct()
        .join(copies, "digest")
        .groupBy("entity", "term")
        .agg(F.sum("copies").alias("n_both"), F.count(F.lit(1)).alias("support"))
    )
    joint = common.land(joint.where(F.col("support") >= SUPPORT), "pii-joint")
    wanted = joint.select(F.xxhash64("term").alias("t")).distinct()
    if wanted.count() <= BROADCAST_TERMS:
        wanted = F.broadcast(wanted)
    text = F.lower(spans.clean(F.col("text")))
    terms = F.array_distinct(F.transform(F.split(text, r"[^\p{L}]+"), lambda w: F.xxhash64(w)))
    # Summed in each task before anything is shuffled: a row per task and candidate term.
    counted = documents.select(F.explode(terms).alias("t")).join(wanted, "t").groupBy("t").agg(F.count(F.lit(1)).alias("n_term"))
    entity = F.explode(F.array_distinct(F.transform("found", lambda f: f["entity"]))).alias("entity")
    holders = holding.select(entity).groupBy("entity").agg(F.count(F.lit(1)).alias("n_entity"))
    n = F.lit(float(max(entities.count(), 1)))
    pmi = F.log2(F.col("n_both") * n / (F.col("n_term") * F.col("n_entity")))
    information = F.log2(n / F.col("n_entity"))
    return (
        joint.withColumn("t", F.xxhash64("term"))
        .join(counted, "t")
        .join(holders, "entity")
        .where(information > 0)
        .select("entity", "term", F.round(pmi / information, 9).alias("share"))
        .where(F.col("share") >= GENERALISE)
    )


def found_spans(documents: DataFrame) -> DataFrame:
    """doc_id, digest, base and terms of every row: arrays of (order, start, end, kind[, share])."""
    entities = _entities(documents)
    flagged = disclosing(documents, entities)
    terms = (
        _contexts(entities)
        .join(flagged, ["entity", "term"])
        .groupBy("digest", "start", "end")
        .agg(F.max("share").alias("share"))
        .groupBy("digest")
        .agg(
            F.array_sort(
                F.collect_list(
                    F.struct(F.lit(len(KINDS)).alias("order"), "start", "end", F.lit("term").alias("kind"), "share")
                )
            ).alias("terms")
        )
    )
    base = F.array_sort(F.transform("found", lambda f: F.struct(f["order"], f["start"], f["end"], f["kind"])))
    rows = entities.select("doc_id", "digest", base.alias("base"))
    return rows.join(terms, "digest", "left")


def personal_data(documents: DataFrame) -> DataFrame:
    """Counts per kind, digest of the base spans, and all spans of every row."""
    base = F.col("base")
    none = F.array().cast("ARRAY<STRUCT<order: INT, start: INT, end: INT, kind: STRING>>")
    terms = F.transform("terms", lambda t: F.struct(t["order"], t["start"], t["end"], t["kind"]))
    return found_spans(documents).select(
        "doc_id",
        *[_number(base, kind).alias(f"n_{kind}") for kind in KINDS],
        F.sha2(spans.joined(base).cast("binary"), 256).alias("base_sha256"),
        spans.joined(F.concat(base, F.coalesce(terms, none))).alias("spans"),
    )


def sanitised(documents: DataFrame) -> DataFrame:
    """`documents` with entities and disclosing terms replaced in their text, and all other columns as they came.

    An entity becomes [KIND], a term that gives away a part [TERM], one that gives away all is taken
    out. Spans that overlap are replaced as one, by the first. Texts without a span are untouched, null
    stays null.
    """
    found = found_spans(documents)
    none = F.array().cast("ARRAY<STRUCT<start: INT, end: INT, put: STRING>>")
    entities = F.transform("base", lambda s: F.struct(s["start"], s["end"], F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")).alias("put")))
    terms = F.transform(
        "terms", lambda t: F.struct(t["start"], t["end"], F.when(t["share"] >= REMOVE, "").otherwise("[TERM]").alias("put"))
    )
    edits = (
        found.where((F.size("base") > 0) | F.col("terms").isNotNull())
        .select("digest", F.array_sort(F.concat(entities, F.coalesce(terms, none))).alias("__edits"))
        .groupBy(F.col("digest").alias("__digest"))
        .agg(F.max("__edits").alias("__edits"))
    )
    edits = common.land(edits, "pii-edits")
    # Edits of one text grow with it, so their total counts, not only the number of texts.
    if (edits.agg(F.coalesce(F.sum(F.size("__edits") + 1), F.lit(0))).first()[0]) <= BROADCAST_EDITS:
        edits = F.broadcast(edits)
    text = F.col("text")

    def edit(state: Column, e: Column) -> Column:
        fresh = e["start"] >= state["at"]
        kept = F.substring(text, state["at"] + 1, e["start"] - state["at"])
        return F.struct(
            F.greatest(state["at"], e["end"]).alias("at"),
            F.when(fresh, F.concat(state["out"], F.array(kept, e["put"]))).otherwise(state["out"]).alias("out"),
        )

    start = F.struct(F.lit(0).alias("at"), F.array().cast("ARRAY<STRING>").alias("out"))
    rest = lambda s: F.concat(F.array_join(s["out"], ""), F.substring(text, s["at"] + 1, F.length(text)))
    changed = F.when(F.col("__edits").isNotNull(), F.aggregate("__edits", start, edit, rest)).otherwise(text)
    return (
        documents.withColumn("__digest", common.digest(text))
        .join(edits, "__digest", "left")
        .withColumn("text", changed)
        .select(*documents.columns)
    )
