"""Periodic runs of words: recompression grammars answer the extensions of candidates on harmonic grids.

The words of a slice of texts become one sequence of numbers, a number of its own between any two texts.
Block compression (a stretch of one symbol becomes a symbol) and pair compression (a symbol of the left
half of the alphabet and one of the right half after it become a symbol) take turns until one symbol is
left; the sequences of all rounds are a run-length grammar. Symbols are named by exact content, so equal
names are equal words. Both rules look at neighbours only: two equal stretches are cut alike but for
their ends, and a longest common extension climbs the levels while both places are phrase borders, then
comes down again, with one comparison a level.

A run of period p and length 2p or more holds two neighbouring places of the grid 0, p, 2p, ... that have
one word; extending such pairs to both sides gives every run. The grids of all periods together have
n ln n places. Runs of equal ends are one run, of the smallest period.

Defined cases: a null text counts as empty; texts of fewer than LEAST words have no run; white space is
blank, tab, line feed, vertical tab, form feed and carriage return, nothing else; each row is answered by
itself, so repeated rows, ties and null ids need no rule; of the caller's columns only the two named are
read; an empty table gives an empty result. A text is kept whole in one task: about 100 bytes a word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filinglake.llm import common
from filinglake.llm.spans import let

LEAST = 12
# Places of the grids looked at together.
PLACES = 1 << 18
SPACE = r"[\x20\x09-\x0D]+"
RUNS = "ARRAY<STRUCT<start: LONG, length: LONG, period: LONG>>"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words of each text between ASCII white space, flat, and offsets of each text (n + 1)."""
    lists = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(pc.fill_null(texts, "")))
    offsets = lists.offsets.to_numpy().astype(np.int64)
    flat = lists.values.slice(offsets[0], offsets[-1] - offsets[0])
    filled = pc.greater(pc.binary_length(flat), 0)
    kept = np.concatenate(([0], np.cumsum(filled.to_numpy(zero_copy_only=False))))
    return flat.filter(filled), kept[offsets - offsets[0]]


@dataclass(frozen=True)
class Level:
    """A sequence and its cut into phrases: `up` is the phrase of each symbol, `starts` the first symbol of
    each phrase and, last, the number of symbols. `blocks` tells block from pair compression."""

    symbols: np.ndarray
    up: np.ndarray
    starts: np.ndarray
    blocks: bool


def _named(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Numbers from 0 for pairs, equal for equal pairs."""
    wide = first.astype(np.int64) * (int(second.max()) + 1) + second
    return np.unique(wide, return_inverse=True)[1].astype(first.dtype)


def grammar(symbols: np.ndarray) -> list[Level]:
    """Levels of the grammar of a sequence of numbers, from the words up to one symbol."""
    levels: list[Level] = []
    symbols = symbols.astype(np.int32 if len(symbols) < 2**31 - 2 else np.int64)
    turn = 0
    while len(symbols) > 1:
        blocks = turn % 2 == 0
        turn += 1
        begins = np.ones(len(symbols), bool)
        if blocks:
            begins[1:] = symbols[1:] != symbols[:-1]
        else:
            left = common.mix(symbols.astype(np.uint64) + np.uint64(turn << 40)) & np.uint64(1) == 0
            joined, turned = left[:-1] & ~left[1:], ~left[:-1] & left[1:]
            begins[1:] = ~(joined if joined.sum() >= turned.sum() else turned)
        if begins.all():
            continue
        starts = np.append(np.flatnonzero(begins), len(symbols)).astype(symbols.dtype)
        up = (np.cumsum(begins) - 1).astype(symbols.dtype)
        sizes = np.diff(starts)
        second = sizes if blocks else np.where(sizes == 2, symbols[np.minimum(starts[:-1] + 1, len(symbols) - 1)].astype(np.int64) + 1, 0)
        levels.append(Level(symbols, up, starts, blocks))
        symbols = _named(symbols[starts[:-1]], second)
    return levels


def extension(levels: list[Level], left: np.ndarray, right: np.ndarray, forward: bool) -> np.ndarray:
    """Length of the longest common extension of the borders `left` < `right`, after them or before them.

    The words before the first and after the last text must not occur twice, so that every extension
    ends inside the sequence.
    """
    a, b = left.astype(np.int64), right.astype(np.int64)
    back, sign = (0, 1) if forward else (1, -1)

    def step(level: Level, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How far both may go within their phrases, and whether they meet different symbols there."""
        same = level.symbols[x - back] == level.symbols[y - back]
        if not level.blocks:
            return same.astype(np.int64), ~same
        if forward:
            rest, other = level.starts[level.up[x] + 1] - x, level.starts[level.up[y] + 1] - y
        else:
            rest, other = x - level.starts[level.up[x - 1]], y - level.starts[level.up[y - 1]]
        return np.where(same, np.minimum(rest, other), 0), ~same | (rest != other)

    ended = np.full(len(a), len(levels))
    alive = np.arange(len(a))
    for number, level in enumerate(levels):
        x, y = a[alive], b[alive]
        # The end of the sequence is a border, too; only the border after the last symbol has no phrase.
        inside = (level.starts[level.up[np.minimum(x, len(level.up) - 1)]] != x) & (x < len(level.up))
        inside |= (level.starts[level.up[np.minimum(y, len(level.up) - 1)]] != y) & (y < len(level.up))
        if inside.any():
            at = alive[inside]
            far, apart = step(level, a[at], b[at])
            a[at] += sign * far
            b[at] += sign * far
            ended[at[apart]] = number
            inside[inside] = apart
            alive = alive[~inside]
        if not len(alive):
            break
        for ends in (a, b):
            place = ends[alive]
            last = place == len(level.up)
            ends[alive] = np.where(last, len(level.starts) - 1, level.up[np.where(last, 0, place)])
    for number in range(min(len(levels), int(ended.max(initial=0))) - 1, -1, -1):
        level = levels[number]
        at = np.flatnonzero(ended > number)
        a[at], b[at] = level.starts[a[at]], level.starts[b[at]]
        far, _ = step(level, a[at], b[at])
        a[at] += sign * far
        b[at] += sign * far
    return sign * (a - left)


def _grids(symbols: np.ndarray, at: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(place, place one period on, period) of neighbouring grid places of a text that hold one word."""
    periods = [np.arange(1, n // 2 + 1) for n in sizes]
    base = np.repeat(at, [len(p) for p in periods])
    counts = (np.repeat(sizes, [len(p) for p in periods]) - 1) // np.concatenate(periods)
    period = np.concatenate(periods)
    ends = np.cumsum(counts)
    start = 0
    while start < len(period):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + PLACES, side="right")))
        own = counts[start:stop]
        step = np.repeat(period[start:stop], own)
        turn = np.arange(own.sum()) - np.repeat(ends[start:stop] - own - before, own)
        left = np.repeat(base[start:stop], own) + turn * step
        same = symbols[left] == symbols[left + step]
        yield left[same], (left + step)[same], step[same]
        start = stop


def _distinct(found: list[np.ndarray]) -> np.ndarray:
    """Columns (start, end, period) in order, one for equal ends, with the smallest period."""
    rows = np.concatenate(found, axis=1) if found else np.empty((3, 0), np.int64)
    rows = rows[:, np.lexsort(rows[::-1])]
    first = np.ones(rows.shape[1], bool)
    first[1:] = (rows[:2, 1:] != rows[:2, :-1]).any(0)
    return rows[:, first]


def runs(numbers: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, start, length and period of every run, in the order of text, start and period.

    `numbers` stand for the words of all texts; words of a text lie between its two `offsets`.
    """
    sizes = np.diff(offsets)
    long = np.flatnonzero(sizes >= LEAST)
    none = np.empty(0, np.int64)
    if not len(long):
        return none, none, none, none
    # One border symbol before each text and one after the last.
    at = np.cumsum(sizes[long]) - sizes[long] + np.arange(1, len(long) + 1)
    symbols = np.empty(int(sizes[long].sum()) + len(long) + 1, np.int64)
    border = np.ones(len(symbols), bool)
    owned = np.repeat(at - np.cumsum(sizes[long]) + sizes[long], sizes[long]) + np.arange(sizes[long].sum())
    border[owned] = False
    source = np.repeat(offsets[long] - np.cumsum(sizes[long]) + sizes[long], sizes[long]) + np.arange(sizes[long].sum())
    symbols[owned] = numbers[source]
    symbols[border] = int(numbers.max(initial=0)) + 1 + np.arange(len(long) + 1)
    symbols = np.unique(symbols, return_inverse=True)[1]
    levels = grammar(symbols)
    found: list[np.ndarray] = []
    for left, right, period in _grids(symbols, at, sizes[long]):
        start = left - extension(levels, left, right, forward=False)
        end = right + extension(levels, left, right, forward=True)
        enough = end - start >= np.maximum(LEAST, 2 * period)
        found.append(_distinct([np.stack((start, end, period))[:, enough]]))
    start, end, period = _distinct(found)
    text = np.searchsorted(at, start, side="right") - 1
    return long[text], start - at[text], end - start, period


def _answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for begin, stop in common.slices(batch["text"]):
            cut = batch.slice(begin, stop - begin)
            flat, offsets = words(cut["text"])
            text, start, length, period = runs(pc.dictionary_encode(flat).indices.to_numpy(), offsets)
            ends = np.searchsorted(text, np.arange(cut.num_rows + 1))
            cover = np.zeros(len(flat) + 1, np.int64)
            np.add.at(cover, offsets[text] + start + period, 1)
            np.add.at(cover, offsets[text] + start + length, -1)
            kept = np.cumsum(cover[:-1]) == 0
            left = np.concatenate(([0], np.cumsum(kept)))[offsets]
            lists = pa.ListArray.from_arrays(pa.array(left, pa.int32()), flat.filter(pa.array(kept)))
            parts = pa.StructArray.from_arrays([pa.array(start), pa.array(length), pa.array(period)], fields=list(_RUN))
            yield pa.RecordBatch.from_arrays(
                [
                    cut["doc_id"],
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), parts),
                    pc.binary_join(lists, " "),
                ],
                ["doc_id", "runs", "collapsed"],
            )


def periodic_runs(documents: DataFrame) -> DataFrame:
    """doc_id, its maximal periodic runs of words by start and period, and the text without their repeats.

    A run is a stretch of words with smallest period `period` and a length of at least LEAST and twice
    the period that no neighbouring word extends; `collapsed` joins by one blank the words that no run
    holds after its first period.
    """
    return documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(
        _answered, f"doc_id LONG, runs {RUNS}, collapsed STRING"
    )


def planted(doc_id: Column, text: Column) -> Column:
    """The text with a repeating tail where the CRC-32 h of the id is divisible by 10, else as it is.

    With g = floor(h / 10) and n words, words from a = g % n on repeat the first 1 + floor((n - a) / (3 + g % 8))
    of them. A null id plants nothing.
    """
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)

    def tail(own: Column) -> Column:
        n = F.size(own).cast("long")
        a = F.pmod(g, n)
        period = 1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))
        places = F.sequence(F.lit(0).cast("long"), n - 1)
        return F.transform(places, lambda i: F.get(own, F.when(i < a, i).otherwise(a + F.pmod(i - a, period)).cast("int")))

    def changed(own: Column) -> Column:
        return F.when(F.size(own) > 0, F.array_join(tail(own), " ")).otherwise(F.lit(""))

    full = F.coalesce(text, F.lit(""))
    own = F.filter(F.split(full, SPACE), lambda w: w != "")
    return F.when(F.pmod(h, F.lit(10)) == 0, let(own, changed)).otherwise(full)


def run_digests(documents: DataFrame) -> DataFrame:
    """Per document with its planted repeats: number of runs, the longest one, digests of runs and collapsed text."""
    changed = documents.select("doc_id", planted(F.col("doc_id"), F.col("text")).alias("text"))
    # Of the longest runs the first, of these the one of smallest period.
    key = lambda r: F.struct(r["length"], (-r["start"]).alias("back"), (-r["period"]).alias("small"))
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    best = F.array_max(F.transform("runs", key))
    return (
        periodic_runs(changed)
        .withColumn("best", best)
        .select(
            "doc_id",
            F.size("runs").cast("long").alias("n_runs"),
            (-F.col("best.back")).alias("start"),
            F.col("best.length").alias("length"),
            (-F.col("best.small")).alias("period"),
            F.floor(1000 * F.col("best.length") / -F.col("best.small")).alias("exponent_milli"),
            F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
            F.sha2("collapsed", 256).alias("collapsed_sha256"),
        )
    )
