"""Packing: cutting stock by column generation over the histogram of piece lengths.

A document's ids are cut into pieces of SEQUENCE tokens and a rest. Lengths are rounded up to UNIT
tokens, and the driver solves a linear program over the histogram, whose size is fixed: a column is a
pattern of lengths that fit one sequence, new columns are priced by a knapsack over the duals, until
the bound from the duals shows less than GAP to gain. Multiplicities are rounded down and what is
left of the histogram is packed by best fit. Pieces are then ranked within their length, spread over
many tasks, and the n-th piece of a length goes where the plan puts the n-th of that length.

Ids come from the installed fast encoder of the same vocabulary and split pattern; tests hold them
against those of the library `tokenizers`. <|endoftext|> in a text is the one id the library gives it.

Defined cases: null counts as empty; an empty text is one piece of the end id alone; repeated rows and
null ids are packed like any others; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import functools
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from filinglake.llm import common

SEQUENCE = 2048
UNIT = 8
END_ID = 1
# The added token of the vocabulary: the library matches it inside texts, whatever add_special_tokens says.
ADDED = {"<|endoftext|>": 50256}
GAP = 1e-3
PIECES_PER_PART = 200_000


@functools.cache
def encoder(path: str | None = None):
    """The byte-pair encoder of a rank file, by default the public byte_bpe_50k."""
    import public_tokenizers
    import tiktoken

    with open(path or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=ADDED)


def encoded(text: str, path: str | None = None) -> list[int]:
    """Ids of a text; the texts between added tokens are encoded each by itself."""
    return encoder(path).encode(text, allowed_special=set(ADDED), disallowed_special=())


def pieces(documents: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, start, length, ids_crc32 and doc_tokens of every piece."""
    shape = "doc_id LONG, start LONG, length LONG, ids_crc32 LONG, doc_tokens LONG"
    names = [field.split()[0] for field in shape.split(", ")]

    def cut(batches):
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
                ids = np.array([*encoded(text.as_py() or "", path), END_ID], "<u4")
                for start in range(0, len(ids), SEQUENCE):
                    own = ids[start : start + SEQUENCE]
                    rows.append((doc_id, start, len(own), zlib.crc32(own.tobytes()), len(ids)))
            columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)] or [pa.array([], pa.int64())] * 5
            yield pa.RecordBatch.from_arrays(columns, names)

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, shape)


def knapsack(values: np.ndarray, capacity: int) -> tuple[float, dict[int, int]]:
    """The best multiset of lengths 1..capacity by value that fits, and its value."""
    best, taken = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    for c in range(1, capacity + 1):
        found = best[c - 1 :: -1][:c] + values[1 : c + 1]
        length = int(np.argmax(found)) + 1
        best[c], taken[c] = found[length - 1], length
        if best[c] <= best[c - 1]:
            best[c], taken[c] = best[c - 1], 0
    pattern: dict[int, int] = {}
    c = capacity
    while c > 0:
        if taken[c]:
            pattern[int(taken[c])] = pattern.get(int(taken[c]), 0) + 1
            c -= int(taken[c])
        else:
            c -= 1
    return float(best[capacity]), pattern


def patterns(histogram: dict[int, int], capacity: int, gap: float = GAP) -> list[tuple[dict[int, int], int]]:
    """Patterns (length -> pieces) and how often to use each, covering the histogram exactly."""
    lengths = sorted(length for length, n in histogram.items() if n)
    if not lengths:
        return []
    row = {length: i for i, length in enumerate(lengths)}
    need = np.array([histogram[length] for length in lengths], float)
    columns = [{length: capacity // length} for length in lengths]
    inverse = np.diag([1.0 / (capacity // length) for length in lengths])
    used = inverse @ need
    while True:
        duals = inverse.sum(0)  # every sequence costs 1
        values = np.zeros(capacity + 1)
        values[lengths] = np.maximum(duals, 0)
        best, pattern = knapsack(values, capacity)
        if best <= 1 + gap:
            break
        column = np.zeros(len(lengths))
        for length, n in pattern.items():
            column[row[length]] = n
        step = inverse @ column
        ratio = np.where(step > 1e-9, used / np.where(step > 1e-9, step, 1), np.inf)
        out = int(np.argmin(ratio))
        columns[out] = pattern
        pivot = inverse[out] / step[out]
        amount = ratio[out]
        inverse -= np.outer(step, pivot)
        inverse[out] = pivot
        used = np.maximum(used - step * amount, 0)
        used[out] = amount
    left = dict(histogram)
    plan = []
    for pattern, amount in zip(columns, used, strict=True):
        times = min([int(amount + 1e-7), *(left[length] // n for length, n in pattern.items())])
        if times:
            plan.append((pattern, times))
            for length, n in pattern.items():
                left[length] -= n * times
    return plan + best_fit(left, capacity)


def best_fit(left: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Longest first, each into the fullest sequence that still takes it."""
    room: dict[int, list[dict[int, int]]] = {}
    for length in sorted(left, reverse=True):
        for _ in range(left[length]):
            free = min((f for f in room if f >= length and room[f]), default=None)
            pattern = room[free].pop() if free is not None else {}
            pattern[length] = pattern.get(length, 0) + 1
            room.setdefault((capacity if free is None else free) - length, []).append(pattern)
    return [(pattern, 1) for same in room.values() for pattern in same]


@dataclass(frozen=True)
class Plan:
    """For each (length, first rank): pieces a sequence takes, its first sequence id and place there."""

    keys: np.ndarray
    first: np.ndarray
    per: np.ndarray
    sequence: np.ndarray
    place: np.ndarray

    @staticmethod
    def of(found: list[tuple[dict[int, int], int]]) -> Plan:
        rows, taken, sequence = [], {}, 0
        for pattern, times in found:
            place = 0
            for length in sorted(pattern, reverse=True):
                rank = taken.get(length, 0)
                rows.append(((length << 48) + rank, rank, pattern[length], sequence, place))
                taken[length] = rank + times * pattern[length]
                place += pattern[length]
            sequence += times
        ordered = np.array(sorted(rows), np.int64).reshape(-1, 5)
        return Plan(*(ordered[:, k] for k in range(5)))


def pack(documents: DataFrame, path: str | None = None) -> DataFrame:
    """Every piece with its sequence_id and the offset it starts at there."""
    spark = documents.sparkSession
    cut = common.land(pieces(documents, path), "packing-pieces")
    units = F.ceil(F.col("length") / UNIT).cast("int")
    # At most SEQUENCE / UNIT rows, whatever the input.
    histogram = {r.units: r.n for r in cut.groupBy(units.alias("units")).agg(F.count(F.lit(1)).alias("n")).collect()}
    sent = spark.sparkContext.broadcast(Plan.of(patterns(histogram, SEQUENCE // UNIT)))
    buckets = max(8, sum(histogram.values()) // PIECES_PER_PART)
    ranks = common.ranked(cut.withColumn("units", units), ["units"], ["doc_id", "start", "ids_crc32"], "rank", buckets)

    kept = cut.columns

    def place(batches):
        for batch in batches:
            plan = sent.value
            rank = batch["rank"].to_numpy()
            at = np.searchsorted(plan.keys, (batch["units"].to_numpy().astype(np.int64) << 48) + rank, side="right") - 1
            copy, turn = np.divmod(rank - plan.first[at], plan.per[at])
            columns = [*batch.columns[: len(kept)], pa.array(plan.sequence[at] + copy), pa.array(plan.place[at] + turn)]
            yield pa.RecordBatch.from_arrays(columns, [*kept, "sequence_id", "place"])

    shape = ", ".join(f"{c} LONG" for c in [*kept, "sequence_id", "place"])
    placed = ranks.select(*kept, "units", "rank").mapInArrow(place, shape)
    before = Window.partitionBy("sequence_id").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0))).drop("place")
