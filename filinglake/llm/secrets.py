"""Secret scans by a trigram index, in DataFrame functions only.

From the regex of each rule a Boolean query over trigrams is derived that every match satisfies. The
index holds, for each trigram of any query, the texts with it (lower case); postings are intersected
per rule, and only candidates are verified with the regex. A rule whose regex has no mandatory trigram
scans every text.

Defined cases: null counts as empty; repeated rows each get their spans; a match that fails its rule's
check is dropped without another try; texts with the marks of `spans` keep their places; empty tables
give empty results.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filinglake.llm import common, spans


@dataclass(frozen=True)
class Rule:
    """`base` rules are those of the contract; a match must have `least` characters (or its group 1, if `group`).

    `search`, where given, finds the matches of `pattern` that have the least length and no others.
    """

    kind: str
    pattern: str
    least: int = 0
    group: bool = False
    base: bool = False
    search: str | None = None


# Fixed patterns: the contract's three, then public formats of well-known credentials.
RULES = [
    Rule(
        "assign",
        r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        least=12, group=True, base=True,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", least=18, base=True),
    # A whole run of a class matches, so short runs need not be matched first and dropped then.
    Rule("hex", r"[0-9a-f]+", least=16, base=True, search=r"[0-9a-f]{16,}"),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
]

# A query is a set of clauses, all of which must hold; a clause is a set of trigrams, one of which must occur.
Query = frozenset[frozenset[str]]
# Different literals a part of a regex may expand to before it is taken as unknown.
MOST_LITERALS = 16


def trigram_query(pattern: str) -> Query:
    """Clauses of trigrams (lower case) that any match of the regex satisfies; empty if none is mandatory."""
    clauses, run = _walk(re._parser.parse(pattern))
    return frozenset(clauses | _clauses(run))


def _clauses(run: set[str]) -> set[frozenset[str]]:
    """What the presence of one of some literals demands: their trigrams, clause by clause."""
    if not run or min(map(len, run)) < 3:
        return set()
    each = [[text[i : i + 3] for i in range(len(text) - 2)] for text in sorted(run)]
    return {frozenset(grams[min(i, len(grams) - 1)] for grams in each) for i in range(max(map(len, each)))}


def _walk(parts) -> tuple[set[frozenset[str]], set[str]]:
    """Clauses of a sequence, and the literals its end may be (empty: unknown)."""
    clauses: set[frozenset[str]] = set()
    run: set[str] = {""}
    for name, value in parts:
        inner = _literals(str(name), value)
        if inner is not None and len(run or {""}) * len(inner) <= MOST_LITERALS:
            run = {a + b for a in run or {""} for b in inner}
            continue
        clauses |= _clauses(run)
        run = {""}
        if str(name) == "SUBPATTERN":
            clauses |= _all(value[3])
        elif str(name) in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT") and value[0] > 0:
            clauses |= _all(value[2])
        elif str(name) == "BRANCH":
            options = [_all(option) for option in value[1]]
            if all(options):  # one clause of each alternative, together
                clauses.add(frozenset().union(*(min(option, key=lambda c: (len(c), sorted(c))) for option in options)))
    return clauses, run


def _all(parts) -> set[frozenset[str]]:
    clauses, run = _walk(parts)
    return clauses | _clauses(run)


def _literals(name: str, value) -> set[str] | None:
    """The few texts (lower case) a part stands for, or None."""
    if name == "LITERAL":
        return {chr(value).lower()}
    if name == "IN":
        kinds = {str(kind) for kind, _ in value}
        return {chr(code).lower() for _, code in value} if kinds == {"LITERAL"} and len(value) <= MOST_LITERALS else None
    if name == "SUBPATTERN":
        return _sequence(value[3])
    if name == "BRANCH":
        options = [_sequence(option) for option in value[1]]
        return None if any(o is None for o in options) else set().union(*options)
    if name in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT") and value[1] != re._parser.MAXREPEAT and value[1] <= 8:
        one = _sequence(value[2])
        if one is None:
            return None
        found: set[str] = set()
        for times in range(value[0], value[1] + 1):
            texts = {""}
            for _ in range(times):
                texts = {a + b for a in texts for b in one}
                if len(texts) > MOST_LITERALS:
                    return None
            found |= texts
        return found if len(found) <= MOST_LITERALS else None
    return None


def _sequence(parts) -> set[str] | None:
    texts = {""}
    for name, value in parts:
        own = _literals(str(name), value)
        if own is None or len(texts) * len(own) > MOST_LITERALS:
            return None
        texts = {a + b for a in texts for b in own}
    return texts


def _rows(documents: DataFrame) -> DataFrame:
    return documents.select(
        F.col("doc_id").cast("long"), spans.clean(F.col("text")).alias("text"), common.digest(F.col("text")).alias("digest")
    )


def postings(documents: DataFrame, grams: list[str]) -> DataFrame:
    """The inverted index: (gram, digest) for each trigram of a query and each different text with it."""

    def found(lowered: Column) -> Column:
        return F.array_compact(F.array(*[F.when(F.contains(lowered, F.lit(g)), F.lit(g)) for g in grams]))

    held = spans.let(F.lower(F.col("text")), found)
    return _rows(documents).select(F.explode(held).alias("gram"), "digest").distinct()


def candidates(index: DataFrame, queries: dict[str, Query]) -> DataFrame:
    """(digest, rules): the rules whose query the text's trigrams satisfy. Its set is at most all queries' trigrams."""
    grams = index.groupBy("digest").agg(F.collect_set("gram").alias("grams"))

    def holds(query: Query) -> Column:
        found = F.lit(True)
        for clause in sorted(query, key=sorted):
            found = found & F.arrays_overlap("grams", F.array(*[F.lit(g) for g in sorted(clause)]))
        return found

    rules = F.array_compact(F.array(*[F.when(holds(query), F.lit(kind)) for kind, query in queries.items()]))
    return grams.select("digest", rules.alias("rules")).where(F.size("rules") > 0)


def _found(text: Column, rule: Rule, order: int, possible: Column) -> Column:
    """Verified spans of a rule as (start, order, end, kind)."""

    def enough(s: Column) -> Column:
        value = F.regexp_extract(s["value"], rule.pattern, 1) if rule.group else s["value"]
        return F.length(value) >= rule.least

    def span(s: Column) -> Column:
        return F.struct(s["start"].alias("start"), F.lit(order).alias("order"), s["end"].alias("end"), F.lit(rule.kind).alias("kind"))

    return F.transform(F.filter(spans.matches(text, rule.search or rule.pattern, possible), enough), span)


def found_spans(documents: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """doc_id and spans (start, order, end, kind) of every row, by start and rule."""
    queries = {rule.kind: trigram_query(rule.pattern) for rule in rules}
    indexed = {kind: query for kind, query in queries.items() if query}
    rows = _rows(documents)
    if indexed:
        grams = sorted({g for query in indexed.values() for clause in query for g in clause})
        found = candidates(common.land(postings(documents, grams), "secret-postings"), indexed)
        held = rows.select("digest", "doc_id").join(found, "digest").select("doc_id", "digest", "rules").distinct()
        stand_in = F.lit(-(2**63))
        keyed = lambda df: df.withColumn("__id", F.coalesce("doc_id", stand_in))
        rows = keyed(rows).join(keyed(held).drop("doc_id"), ["__id", "digest"], "left").drop("__id")

    def verified(text: Column) -> Column:
        parts = []
        for order, rule in enumerate(rules):
            possible = F.lit(True)
            if rule.kind in indexed:
                possible = F.coalesce(F.array_contains("rules", rule.kind), F.lit(False))
            parts.append(_found(text, rule, order, possible))
        return F.array_sort(F.concat(*parts))

    return rows.select("doc_id", spans.let(F.col("text"), verified).alias("spans"))


def secrets(documents: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """Counts per base kind, digest of the base spans, and all spans of every row."""
    base = [rule.kind for rule in rules if rule.base]
    found = found_spans(documents, rules)
    own = F.filter("spans", lambda s: s["kind"].isin(*base))
    return found.select(
        "doc_id",
        *[_number(kind).alias(f"n_{kind}") for kind in base],
        F.sha2(spans.joined(own).cast("binary"), 256).alias("base_sha256"),
        spans.joined(F.col("spans")).alias("spans"),
    )


def _number(kind: str) -> Column:
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
