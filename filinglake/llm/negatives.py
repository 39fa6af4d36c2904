"""Hard negatives: exact search over vectors, filtered by summaries of their segments.

A vector is cut into segments of neighbouring components, 1, 4 and then 16 of them. Of each segment the
mean and the deviation (the length of what is left without the mean) are stored. For two vectors, the
product of the means times the segment's length, plus or minus the product of the deviations, bounds
the segment's part of their inner product; the sums bound the score. Pairs whose bounds can't reach a
place among the best, or miss the wanted interval, are left out level by level; the rest is scored exactly.

Anchors are taken ANCHORS at a time, a block of fixed size that every task gets, against all vectors.
A pilot share of the vectors goes first: the scores of its best are a floor below which no other vector
needs to be looked at or sent on. A task sends on its own best of each anchor; they are ranked by Spark.

Defined cases: vectors of null label, null vector, null id, or with a null or non-finite component take
no part; of rows with one id the one with the smallest label, then vector counts; shorter vectors are
filled up with zeros; equal scores come by id; an anchor without a row of its label has no positives and
gives no rows, nor does a positive without a negative in its interval; an empty table gives an empty
result; other columns are not read. Scores must be below 2^63.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filinglake.llm import common

SCALE = 256
SEGMENTS = (1, 4, 16)
# Anchors sent to all tasks at once, and the pairs that a task looks at together: rows of a block by anchors of a block.
ANCHORS, BLOCK_ROWS, BLOCK_ANCHORS = 2048, 2048, 512
POSITIVES, NEGATIVES = 5, 10
# Wanted scores of negatives in hundredths of the positive's.
LOWEST, HIGHEST = 30, 90
# One of so many vectors goes first.
PILOT = 16
RESULT = "anchor_id LONG, positive_id LONG, rank INT, negative_id LONG, positive_score LONG, negative_score LONG"
_FOUND = "anchor LONG, slot INT, vec_id LONG, score LONG"


def borders(width: int, segments: int) -> np.ndarray:
    """First component of each segment of a vector; segments are as equal as can be and never empty."""
    return np.unique(np.arange(segments) * width // segments)


def summary(vectors: np.ndarray, segments: int) -> np.ndarray:
    """Per vector, the means of its segments times the root of their lengths, then their deviations."""
    at = borders(vectors.shape[1], segments)
    sizes = np.diff(np.append(at, vectors.shape[1]))
    means = np.add.reduceat(vectors, at, axis=1) / sizes
    rest = vectors - np.repeat(means, sizes, axis=1)
    return np.concatenate((means * np.sqrt(sizes), np.sqrt(np.add.reduceat(rest * rest, at, axis=1))), axis=1)


def bounds(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest possible inner product of each vector on the left with each on the right, by summaries.

    A little is added for the rounding of the sums.
    """
    half = left.shape[1] // 2
    middle, room = left[:, :half] @ right[:, :half].T, left[:, half:] @ right[:, half:].T
    room += 1e-9 * (np.abs(middle) + room) + 1e-6
    return middle - room, middle + room


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact inner products of integer vectors: in floating point as long as every sum is below 2^53."""
    most = float(np.abs(left).max(initial=0)) * float(np.abs(right).max(initial=0)) * left.shape[1]
    if most < 2.0**53:
        return (left.astype(np.float64) @ right.astype(np.float64).T).astype(np.int64)
    return left @ right.T


@dataclass(frozen=True)
class Search:
    """A block of anchors and, for each, the slots to fill: `most` best scores from `least` to `greatest`.

    `least` is above `greatest` in a slot that is not used. `same` asks for rows of the anchor's label
    other than itself, else rows of other labels are asked for.
    """

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    summaries: list[np.ndarray]
    same: bool
    most: int
    least: np.ndarray
    greatest: np.ndarray

    def block(self, at: slice) -> Search:
        cut = [s[at] for s in self.summaries]
        return Search(self.ids[at], self.labels[at], self.vectors[at], cut, self.same, self.most, self.least[at], self.greatest[at])

    def alive(self, labels: np.ndarray, ids: np.ndarray, summaries: list[np.ndarray], floor: np.ndarray) -> np.ndarray:
        """Pairs (anchor, row) that the bounds of no level rule out; `floor` is the score a slot needs by now."""
        equal = self.labels[:, None] == labels[None, :]
        left = equal & (self.ids[:, None] != ids[None, :]) if self.same else ~equal
        for own, other in zip(self.summaries, summaries, strict=True):
            anchors, rows = np.flatnonzero(left.any(1)), np.flatnonzero(left.any(0))
            if not len(rows):
                break
            low, high = bounds(own[anchors], other[rows])
            may = np.zeros(low.shape, bool)
            for slot in range(floor.shape[1]):
                may |= (high >= floor[anchors, slot, None]) & (low <= self.greatest[anchors, slot, None])
            left[np.ix_(anchors, rows)] &= may
        return left


def _best(found: np.ndarray, most: int) -> np.ndarray:
    """Columns (anchor, slot, id, score): the best of each anchor and slot, smaller ids first among equals."""
    order = np.lexsort((found[2], -found[3], found[1], found[0]))
    found = found[:, order]
    first = np.ones(found.shape[1], bool)
    first[1:] = (found[:2, 1:] != found[:2, :-1]).any(0)
    starts = np.flatnonzero(first)
    turn = np.arange(found.shape[1]) - np.repeat(starts, np.diff(np.append(starts, found.shape[1])))
    return found[:, turn < most]


def _unpacked(column, kind) -> np.ndarray:
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), kind).reshape(len(values), -1) if values else np.empty((0, 0), kind)


def _levels(packed: np.ndarray, width: int) -> list[np.ndarray]:
    ends = np.cumsum([2 * len(borders(width, s)) for s in SEGMENTS])
    return np.split(packed, ends[:-1], axis=1)


def _searched(sent):
    """The best of each slot of the block of anchors among the rows of a task."""

    def search(batches):
        whole: Search = sent.value
        best = np.empty((4, 0), np.int64)
        floor = whole.least.copy()
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK_ROWS):
                cut = batch.slice(start, BLOCK_ROWS)
                ids, labels = cut["vec_id"].to_numpy(), cut["label"].to_numpy()
                vectors = _unpacked(cut["vector"], np.int64)
                summaries = _levels(_unpacked(cut["summaries"], np.float64), vectors.shape[1])
                fresh = [best]
                for first in range(0, len(whole.ids), BLOCK_ANCHORS):
                    at = slice(first, first + BLOCK_ANCHORS)
                    own = whole.block(at)
                    left = own.alive(labels, ids, summaries, floor[at])
                    anchors, rows = np.flatnonzero(left.any(1)), np.flatnonzero(left.any(0))
                    if not len(rows):
                        continue
                    scores = products(own.vectors[anchors], vectors[rows])
                    left = left[np.ix_(anchors, rows)]
                    for slot in range(floor.shape[1]):
                        fit = left & (scores >= floor[at][anchors, slot, None]) & (scores <= own.greatest[anchors, slot, None])
                        # Where more fit than are wanted, those below the last wanted score are left out; ties stay.
                        crowded = np.flatnonzero(fit.sum(1) > own.most)
                        if len(crowded):
                            shown = np.where(fit[crowded], scores[crowded], np.iinfo(np.int64).min)
                            last = np.partition(shown, shown.shape[1] - own.most, axis=1)[:, shown.shape[1] - own.most]
                            fit[crowded] &= scores[crowded] >= last[:, None]
                        x, y = np.nonzero(fit)
                        fresh.append(np.stack((first + anchors[x], np.full(len(x), slot), ids[rows[y]], scores[x, y])))
                best = _best(np.concatenate(fresh, axis=1), whole.most)
                # The last of a full slot is the score that others have to reach.
                key = best[0] * floor.shape[1] + best[1]
                counts = np.bincount(key, minlength=floor.size)
                ends = np.cumsum(counts) - 1
                full = np.flatnonzero(counts == whole.most)
                floor.ravel()[full] = np.maximum(floor.ravel()[full], best[3][ends[full]])
        yield pa.RecordBatch.from_arrays(
            [pa.array(best[0]), pa.array(best[1], pa.int32()), pa.array(best[2]), pa.array(best[3])], ["anchor", "slot", "vec_id", "score"]
        )

    return search


def prepared(vectors: DataFrame) -> DataFrame:
    """vec_id, label, integer vector and stored summaries of the rows that take part, landed by pilot share."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    kept = vectors.select("vec_id", "label", "embedding").where(
        "vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL"
    ).where(F.forall("embedding", finite))
    whole = F.transform("embedding", lambda x: F.floor(F.lit(SCALE) * x.cast("double")))
    one = kept.groupBy(F.col("vec_id").cast("long").alias("vec_id")).agg(
        F.min(F.struct(F.col("label").cast("long").alias("label"), whole.alias("vector"))).alias("v")
    )
    rows = common.land(one.select("vec_id", "v.label", "v.vector"), "negatives-rows")
    width = max(1, rows.agg(F.max(F.size("vector"))).first()[0] or 0)

    def summed(batches):
        for batch in batches:
            lists = common.as_array(batch["vector"])
            sizes = np.diff(lists.offsets.to_numpy())
            whole = np.zeros((len(lists), width), np.int64)
            whole[np.arange(width) < sizes[:, None]] = lists.flatten().to_numpy()
            found = np.concatenate([summary(whole.astype(np.float64), s) for s in SEGMENTS], axis=1)
            packed = [pa.array([row.tobytes() for row in m], pa.binary()) for m in (whole, found)]
            yield pa.RecordBatch.from_arrays([batch["vec_id"], batch["label"], *packed], ["vec_id", "label", "vector", "summaries"])

    shape = "vec_id LONG, label LONG, vector BINARY, summaries BINARY"
    pilot = F.pmod(F.xxhash64("vec_id"), F.lit(PILOT)) == 0
    found = common.land(rows.mapInArrow(summed, shape).withColumn("pilot", pilot.cast("int")), "negatives-vectors")
    common.discard(rows)
    return found


def _found(rows: DataFrame, search: Search) -> DataFrame:
    """(anchor, slot, vec_id, score, rank): the best of each slot over all rows, ranks from 1."""
    sent = rows.sparkSession.sparkContext.broadcast(search)
    line = Window.partitionBy("anchor", "slot").orderBy(F.col("score").desc(), "vec_id")
    found = rows.select("vec_id", "label", "vector", "summaries").mapInArrow(_searched(sent), _FOUND)
    ranked = common.land(found.withColumn("rank", F.row_number().over(line)).where(F.col("rank") <= search.most), "negatives-found")
    sent.destroy()
    return ranked


def _filled(rows: DataFrame, search: Search) -> DataFrame:
    """`_found` over all rows, after a pilot share has raised what a slot needs."""
    pilot = _found(rows.where("pilot = 1"), search)
    last = pilot.where(F.col("rank") == search.most).select("anchor", "slot", "score").toPandas()  # one row a slot of the block
    least = search.least.copy()
    at = last["anchor"].to_numpy(), last["slot"].to_numpy()
    least[at] = np.maximum(least[at], last["score"].to_numpy())
    common.discard(pilot)
    return _found(rows, Search(*[getattr(search, n) for n in ("ids", "labels", "vectors", "summaries", "same", "most")], least, search.greatest))


def hard_negatives(
    vectors: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, lowest: int = LOWEST, highest: int = HIGHEST
) -> DataFrame:
    """For the first `positives` of each anchor, the first `negatives` rows of other labels with a score of `lowest` to `highest` hundredths of the positive's.

    `is_anchor` is a condition on vec_id and label.
    """
    spark = vectors.sparkSession
    rows = prepared(vectors)
    anchors = common.land(common.ranked(rows.where(is_anchor), [], ["vec_id"], "__place"), "negatives-anchors")
    parts: list[DataFrame] = []
    for first in range(0, anchors.count(), ANCHORS):
        block = anchors.where((F.col("__place") >= first) & (F.col("__place") < first + ANCHORS)).drop("__place").toArrow()  # ANCHORS rows at most
        own = _unpacked(block["vector"], np.int64)
        levels = _levels(_unpacked(block["summaries"], np.float64), own.shape[1])
        ids, labels = block["vec_id"].to_numpy(), block["label"].to_numpy()
        widest = np.iinfo(np.int64)
        every = np.full((len(ids), 1), widest.min), np.full((len(ids), 1), widest.max)
        first_found = _filled(rows, Search(ids, labels, own, levels, True, positives, *every))
        best = first_found.select("anchor", "rank", "vec_id", "score").toPandas()  # `positives` rows an anchor at most
        common.discard(first_found)
        at = best["anchor"].to_numpy(), best["rank"].to_numpy() - 1
        score, least, greatest = (np.full((len(ids), positives), x) for x in (0, widest.max, widest.min))
        names = np.zeros((len(ids), positives), np.int64)
        names[at], score[at] = best["vec_id"].to_numpy(), best["score"].to_numpy()
        # Exact in whole numbers: the quotients are rounded into the interval.
        least[at] = [-(-lowest * int(s) // 100) for s in score[at]]
        greatest[at] = [highest * int(s) // 100 for s in score[at]]
        found = _filled(rows, Search(ids, labels, own, levels, False, negatives, least, greatest))
        told = spark.createDataFrame(
            pa.table({"anchor": at[0].astype(np.int64), "slot": pa.array(at[1], pa.int32()), "anchor_id": ids[at[0]], "positive_id": names[at], "positive_score": score[at]})
        )
        parts.append(
            common.land(
                found.join(told, ["anchor", "slot"]).select(
                    "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"),
                    F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"),
                ),
                "negatives-mined",
            )
        )
        common.discard(found)
    common.discard(anchors, rows)
    if not parts:
        return spark.createDataFrame([], RESULT)
    return spark.read.schema(parts[0].schema).parquet(*[p.landed for p in parts])


def mined(embeddings: DataFrame) -> DataFrame:
    """Hard negatives of the rows whose id is divisible by 100, after every seventh id has got the next label of ten."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(embeddings.select("vec_id", label.alias("label"), "embedding"), F.col("vec_id") % 100 == 0)


SQL = f"""
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS q
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
    SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_dot_product(a.q, b.q)::BIGINT AS score
    FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), p AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {POSITIVES}
)
SELECT p.anchor_id, positive_id,
    row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id)::INT AS rank,
    vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same
    AND {LOWEST} * positive_score <= 100 * score AND 100 * score <= {HIGHEST} * positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) <= {NEGATIVES}"""
