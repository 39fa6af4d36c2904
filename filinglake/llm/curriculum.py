"""Mixing sources to target weights by a time-varying curriculum, in DataFrame functions only.

Sources in code point order, null last, weigh WEIGHTS in turn and share all words. A source gives at most
MOST_PASSES times its words; what it can't give is shared anew by weight until no source is above its limit.

Time runs from 0 to 1. The weight of a source follows a schedule, straight lines between knots. Its
integral up to a time, scaled to the target at 1, is the number of words the source has given by then.
The documents of a source stand in the order of the MD5 of their ids, pass after pass; a document gets
the time at which the demand reaches its first word, the inverse of that integral, and what the demand
never reaches is not taken: of one document of a source perhaps a part. Documents are then sorted by time, by range.

Running sums within a source go over buckets of the MD5, the square root of all rows in number, so a
source of any share of the rows is summed by many tasks.

Defined cases: a null text has no words; a document without words is taken 0 times and has no position;
a null id is ordered as the empty id; rows of one id are ordered by size, and equal ones take
neighbouring places; a null source is a source; a table without words has targets of 0; an empty table
gives an empty result; the caller's columns may have any names.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from filinglake.llm import common
from filinglake.operators.ranks import global_rank

WEIGHTS = (5, 2, 1)
MOST_PASSES = 3
WORD = r"[^\x20\x09-\x0D]+"
Knots = Sequence[tuple[float, float]]
# By place in WEIGHTS: the heaviest sources fade, the next stay, the lightest come in late.
SCHEDULES: tuple[Knots, ...] = (
    ((0.0, 1.5), (0.5, 1.0), (1.0, 0.5)),
    ((0.0, 1.0), (1.0, 1.0)),
    ((0.0, 0.5), (0.75, 1.0), (1.0, 2.0)),
)


def integral(knots: Knots) -> list[float]:
    """Area below the lines up to each knot."""
    area = [0.0]
    for (t0, w0), (t1, w1) in zip(knots, knots[1:], strict=False):
        area.append(area[-1] + (t1 - t0) * (w0 + w1) / 2)
    return area


def moment(share: Column, knots: Knots) -> Column:
    """Time at which this share (0 to 1) of a schedule's whole area is reached."""
    area = integral(knots)
    reached = share * F.lit(area[-1])
    found = F.lit(1.0)
    for (t0, w0), (t1, w1), before, after in reversed(list(zip(knots, knots[1:], area, area[1:], strict=False))):
        if after == before:
            continue
        slope = (w1 - w0) / (t1 - t0)
        rest = F.greatest(reached - F.lit(before), F.lit(0.0))
        root = F.lit(w0) + F.sqrt(F.greatest(F.lit(w0 * w0) + F.lit(2 * slope) * rest, F.lit(0.0)))
        # rest = w0 x + slope x^2 / 2, solved for x without a difference of near numbers.
        found = F.when(reached < F.lit(after), F.lit(t0) + F.coalesce(F.lit(2.0) * rest / F.nullif(root, F.lit(0.0)), F.lit(0.0))).otherwise(found)
    return found


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_PASSES) -> DataFrame:
    """`sizes` (absent, name, source_size) with turn in `weights`, target and the words to take.

    `absent` tells the null source, whose name is empty. Every round adds up, over all sources, what the
    full ones give and what the others weigh; it ends when no source is found above its limit.
    """
    ranked = common.land(
        global_rank(sizes, ["absent", "name"], "place").withColumns(
            {
                "turn": F.pmod(F.col("place"), F.lit(len(weights))).cast("int"),
                "limit": (F.col("source_size") * most).cast("long"),
            }
        ),
        "mix-sources",
    )
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), F.col("turn") + 1).cast("long")
    wide = lambda c: c.cast("decimal(38,0)")
    whole = int(ranked.agg(F.coalesce(F.sum(wide(F.col("source_size"))), F.lit(0))).first()[0])
    full, count = F.lit(False), 0
    while True:
        given, open_weight = ranked.agg(
            F.coalesce(F.sum(F.when(full, wide(F.col("limit")))), F.lit(0)),
            F.coalesce(F.sum(F.when(~full, weight)), F.lit(0)),
        ).first()
        left, open_weight = whole - int(given), int(open_weight)
        if not open_weight:
            break
        full = wide(F.col("limit")) * F.lit(open_weight) < wide(weight) * F.lit(str(left)).cast("decimal(38,0)")
        now = ranked.where(full).count()
        if now == count:
            break
        count = now
    share = weight * F.lit(float(left)) / F.lit(float(open_weight or 1))
    target = F.least(F.col("limit").cast("double"), share)
    found = common.land(ranked.withColumn("target", target).withColumn("wanted", F.floor(target + 0.5).cast("long")), "mix-targets")
    common.discard(ranked)
    return found


def positions(documents: DataFrame, carried: Sequence[str] = (), schedules: Sequence[Knots] = SCHEDULES) -> DataFrame:
    """Per row: doc_id, source, size, source_size, target, taken and its passes (position, words), by time.

    `carried` columns come along in a struct `document`.
    """
    slim = common.land(
        documents.select(
            "doc_id",
            F.col("source").isNull().alias("absent"),
            F.coalesce("source", F.lit("")).alias("name"),
            F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long").alias("size"),
            F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")).alias("key"),
            *([F.struct(*[F.col(f"`{c}`") for c in carried]).alias("document")] if carried else []),
        ),
        "mix-sizes",
    )
    # At most 2^31 buckets, so the product below stays within 64 bits.
    buckets = math.isqrt(slim.count()) + 1
    slim = slim.withColumn("bucket", F.shiftright(F.conv(F.substring("key", 1, 8), 16, 10).cast("long") * F.lit(buckets), 32))
    by = ["absent", "name", "bucket"]
    sums = common.land(slim.groupBy(*by).agg(F.sum("size").alias("words")), "mix-buckets")
    sources = targets(sums.groupBy("absent", "name").agg(F.sum("words").alias("source_size")))
    line = Window.partitionBy("absent", "name").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.withColumn("before", F.coalesce(F.sum("words").over(line), F.lit(0))).drop("words").join(sources, ["absent", "name"])
    own = Window.partitionBy(*by).orderBy("key", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = slim.join(before, by).withColumn("start", F.col("before") + F.sum("size").over(own) - F.col("size"))

    def taken(turn: int) -> tuple[Column, Column]:
        start = F.col("start") + F.lit(turn) * F.col("source_size")
        words = F.greatest(F.least(F.col("wanted") - start, F.col("size")), F.lit(0))
        share = start / F.nullif(F.col("target"), F.lit(0.0))
        time = F.lit(None).cast("double")
        for number, knots in enumerate(schedules):
            time = F.when(F.col("turn") == number, moment(share, knots)).otherwise(time)
        return time, words

    passes = F.array(*[F.struct(time.alias("position"), words.alias("words")) for time, words in map(taken, range(MOST_PASSES))])
    return placed.select(
        "doc_id",
        F.when(~F.col("absent"), F.col("name")).alias("source"),
        "size",
        "source_size",
        "target",
        sum((words for _, words in map(taken, range(MOST_PASSES))), F.lit(0).cast("long")).alias("taken"),
        F.filter(passes, lambda p: p["words"] > 0).alias("passes"),
        "key",
        *(["document"] if carried else []),
    )


def mixture(documents: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken and the first position of every row, sorted by position over all files."""
    found = positions(documents).withColumn("position", F.get("passes", F.lit(0))["position"])
    return found.orderBy(F.col("position").asc_nulls_last(), "key", "size").select(
        "doc_id", "size", "source_size", "target", "taken", "position"
    )


def training_order(documents: DataFrame) -> DataFrame:
    """A row for each pass of a document: its columns, position and words to read, sorted by position over all files."""
    columns = documents.columns
    found = positions(documents, columns).select("key", "size", F.explode("passes").alias("pass"), "document")
    return found.orderBy("pass.position", "key", "size").select(
        *[F.col("document").getField(c).alias(c) for c in columns],
        F.col("pass.position").alias("mix_position"),
        F.col("pass.words").alias("mix_words"),
    )


def _moment_sql(share: str, knots: Knots) -> str:
    area = integral(knots)
    reached = f"({share} * {area[-1]!r}::DOUBLE)"
    parts = []
    for (t0, w0), (t1, w1), before, after in zip(knots, knots[1:], area, area[1:], strict=False):
        rest = f"greatest({reached} - {before!r}::DOUBLE, 0::DOUBLE)"
        root = f"({w0!r}::DOUBLE + sqrt(greatest({w0 * w0!r}::DOUBLE + {2 * (w1 - w0) / (t1 - t0)!r}::DOUBLE * {rest}, 0::DOUBLE)))"
        parts.append(f"WHEN {reached} < {after!r}::DOUBLE THEN {t0!r}::DOUBLE + coalesce(2::DOUBLE * {rest} / nullif({root}, 0::DOUBLE), 0::DOUBLE)")
    return f"(CASE {' '.join(parts)} ELSE 1::DOUBLE END)"


# The same rows by one sorted prefix of limits instead of rounds, and by running sums over whole sources.
SQL = f"""
WITH sized AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size,
        md5(coalesce(doc_id::VARCHAR, '')) AS k
    FROM documents
), sources AS (
    SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place
    FROM sized GROUP BY source
), weighed AS (
    SELECT *, place % {len(WEIGHTS)} AS turn, {MOST_PASSES} * source_size AS most,
        CASE place % {len(WEIGHTS)} {' '.join(f'WHEN {i} THEN {w}' for i, w in enumerate(WEIGHTS))} END AS weight
    FROM sources
), levels AS (
    SELECT *, (SELECT sum(source_size) FROM sources)
            - coalesce(sum(most) OVER (ORDER BY most / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
        sum(weight) OVER (ORDER BY most / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open
    FROM weighed
), level AS (
    SELECT rest, open FROM levels WHERE most * open >= weight * rest ORDER BY most / weight, place LIMIT 1
), aimed AS (
    SELECT w.*, least(most::DOUBLE, weight::DOUBLE * rest::DOUBLE / open::DOUBLE) AS target FROM weighed w, level
), placed AS (
    SELECT doc_id, size, source_size, target, turn, floor(target + 0.5)::BIGINT AS wanted,
        sum(size) OVER (PARTITION BY s.source ORDER BY k, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT - size AS start
    FROM sized s JOIN aimed a ON s.source IS NOT DISTINCT FROM a.source
), passed AS (
    SELECT *, {', '.join(f'greatest(least(wanted - (start + {i} * source_size), size), 0)::BIGINT AS words{i}' for i in range(MOST_PASSES))},
        start::DOUBLE / nullif(target, 0::DOUBLE) AS share
    FROM placed
)
SELECT doc_id, size, source_size, target, {' + '.join(f'words{i}' for i in range(MOST_PASSES))} AS taken,
    CASE WHEN words0 > 0 THEN CASE turn {' '.join(f'WHEN {i} THEN {_moment_sql("share", knots)}' for i, knots in enumerate(SCHEDULES))} END END AS position
FROM passed"""
