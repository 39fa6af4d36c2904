"""Benchmark decontamination: SimHash of item-sized windows, Hamming search, exact verification.

Every benchmark item is a sequence of five-word shingles. In each document all windows of as many
shingles as an item has are fingerprinted (64-bit SimHash, a shingle weighing the number of its
different words). A fingerprint is cut into BLOCKS blocks: two that differ in at most RADIUS bits
differ in at most RADIUS // BLOCKS bits of some block, so the index, which lists for every value of a
block the items within that distance, misses none. Candidates within RADIUS are then verified by the
exact weighted Jaccard similarity of window and item.

Windows without any shingle of an item of their size have similarity 0 and are not fingerprinted.
Items are searched in groups of about GROUP_ITEMS, so what is broadcast does not grow with them.

Defined cases: null, empty and word-less texts and items match nothing; an item or text of fewer than
five words is one shingle; a document shorter than an item is one window; repeated rows are reported
each; an empty table of either kind gives an empty report.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filinglake.llm import common

SIMILARITY = 0.8
RADIUS, BLOCKS = 20, 4
GROUP_ITEMS = 512
_BITS = 64 // BLOCKS
_FILTER = np.uint64((1 << 20) - 1)


def shingles_weighted(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Shingle hashes in order, offsets per text, words and their offsets."""
    flat, word_offsets = common.words(texts)
    own = common.word_hashes(flat)
    hashes, offsets = common.shingles_of(own, word_offsets)
    return hashes, offsets, own, word_offsets


def different_words(own: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """How many different words each shingle has, given the place of its first word and the end of its text."""
    padded = np.concatenate((own, np.zeros(common.SHINGLE_WORDS, np.uint64)))
    out = np.zeros(len(first), np.int64)
    for j in range(common.SHINGLE_WORDS):
        new = first + j < last
        for i in range(j):
            new &= padded[first + i] != padded[first + j]
        out += new
    return out


def fingerprints(hashes: np.ndarray, weights: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit SimHash of the shingles in [start, end) for each window; a tied bit is 0."""
    out = np.zeros(len(starts), np.uint64)
    summed = np.zeros(len(hashes) + 1, np.int64)
    for bit in range(64):
        signs = ((hashes >> np.uint64(bit)) & np.uint64(1)).astype(np.int64) * 2 - 1
        np.cumsum(signs * weights, out=summed[1:])
        out |= (summed[ends] > summed[starts]).astype(np.uint64) << np.uint64(bit)
    return out


def similarity(hashes, weights, hashes2, weights2) -> float:
    """Weighted Jaccard similarity of two sequences of shingles as multisets."""
    keys, back = np.unique(np.concatenate((hashes, hashes2)), return_inverse=True)
    a = np.bincount(back[: len(hashes)], weights, len(keys))
    b = np.bincount(back[len(hashes) :], weights2, len(keys))
    most = np.maximum(a, b).sum()
    return float(np.minimum(a, b).sum() / most) if most else 0.0


@dataclass(frozen=True)
class Group:
    """Up to eight items of one size, and their index: per block, the items near each of its values."""

    size: int
    items: list[int]
    hashes: list[np.ndarray]
    weights: list[np.ndarray]
    prints: np.ndarray
    tables: np.ndarray
    known: np.ndarray


def groups_of(rows: list) -> list[Group]:
    """Index of items given as (item_id, text)."""
    rows = [r for r in rows if r[0] is not None and r[1] is not None and r[1].split()]
    by_size: dict[int, list] = {}
    if rows:
        hashes, offsets, own, word_offsets = shingles_weighted(pa.array([r[1] for r in rows], pa.string()))
        for i, row in enumerate(rows):
            h = hashes[offsets[i] : offsets[i + 1]]
            first = word_offsets[i] + np.arange(len(h))
            w = different_words(own, first, np.full(len(h), word_offsets[i + 1]))
            by_size.setdefault(len(h), []).append((row[0], h, w))
    values = np.arange(1 << _BITS, dtype=np.uint64)
    out = []
    for size, same in sorted(by_size.items()):
        for start in range(0, len(same), 8):
            some = same[start : start + 8]
            prints = np.array([fingerprints(h, w, np.array([0]), np.array([size]))[0] for _, h, w in some], np.uint64)
            tables = np.zeros((BLOCKS, 1 << _BITS), np.uint8)
            for block in range(BLOCKS):
                for n, value in enumerate(prints):
                    part = (value >> np.uint64(block * _BITS)) & np.uint64((1 << _BITS) - 1)
                    near = np.bitwise_count(values ^ part) <= RADIUS // BLOCKS
                    tables[block] |= near.astype(np.uint8) << np.uint8(n)
            known = np.unique(np.concatenate([h for _, h, _ in some]))
            out.append(Group(size, [i for i, _, _ in some], [h for _, h, _ in some], [w for _, _, w in some], prints, tables, known))
    return out


@dataclass(frozen=True)
class Index:
    groups: list[Group]
    known: np.ndarray
    filter: np.ndarray

    @staticmethod
    def of(rows: list) -> Index:
        groups = groups_of(rows)
        known = np.unique(np.concatenate([np.empty(0, np.uint64), *(g.known for g in groups)]))
        passing = np.zeros(int(_FILTER) + 1, bool)
        passing[known & _FILTER] = True
        return Index(groups, known, passing)


def matches(texts: pa.Array, index: Index, threshold: float) -> list[tuple[int, int, float, int, int]]:
    """(row, item, similarity, first word, words) of the best window per text and item at or above `threshold`."""
    hashes, offsets, own, word_offsets = shingles_weighted(texts)
    maybe = np.flatnonzero(index.filter[hashes & _FILTER])
    maybe = maybe[np.isin(hashes[maybe], index.known)]
    best: dict[tuple[int, int], tuple[float, int, int]] = {}
    for row in np.unique(np.searchsorted(offsets, maybe, side="right") - 1):
        lo, hi = offsets[row], offsets[row + 1]
        h, n = hashes[lo:hi], int(hi - lo)
        at = maybe[np.searchsorted(maybe, lo) : np.searchsorted(maybe, hi)] - lo
        w = different_words(own, word_offsets[row] + np.arange(n), np.full(n, word_offsets[row + 1]))
        spans = []
        for group in index.groups:
            size = min(group.size, n)
            held = np.zeros(n + 1, np.int64)
            held[at[np.isin(h[at], group.known)] + 1] = 1
            held = np.cumsum(held)
            first = np.arange(n - size + 1)
            first = first[held[first + size] > held[first]]
            if len(first):
                spans.append((group, first, size))
        if not spans:
            continue
        starts = np.concatenate([first for _, first, _ in spans])
        ends = np.concatenate([first + size for _, first, size in spans])
        low, high = int(starts.min()), int(ends.max())
        prints = fingerprints(h[low:high], w[low:high], starts - low, ends - low)
        done = 0
        for group, first, size in spans:
            own_prints = prints[done : done + len(first)]
            done += len(first)
            mask = np.zeros(len(first), np.uint8)
            for block in range(BLOCKS):
                mask |= group.tables[block][(own_prints >> np.uint64(block * _BITS)) & np.uint64((1 << _BITS) - 1)]
            for n_item, item in enumerate(group.items):
                near = np.flatnonzero(mask >> np.uint8(n_item) & np.uint8(1))
                near = near[np.bitwise_count(own_prints[near] ^ group.prints[n_item]) <= RADIUS]
                for start in first[near]:
                    found = similarity(h[start : start + size], w[start : start + size], group.hashes[n_item], group.weights[n_item])
                    if found >= threshold and found > best.get((int(row), item), (0.0,))[0]:
                        span = min(size + common.SHINGLE_WORDS - 1, int(word_offsets[row + 1] - word_offsets[row]))
                        best[int(row), item] = (found, int(start), span)
    return [(*key, *value) for key, value in sorted(best.items())]


def _groups(items: DataFrame) -> list[list]:
    """Items in groups of about GROUP_ITEMS, each brought to the driver by itself."""
    number = -(-items.count() // GROUP_ITEMS)
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(max(number, 1)))
    return [items.where(part == n).select("item_id", "text").collect() for n in range(number)]


def leaks(documents: DataFrame, items: DataFrame, threshold: float = SIMILARITY) -> DataFrame:
    """doc_id, item_id, similarity, first_word and words of the best window of every leaked item."""
    spark = documents.sparkSession
    shape = "doc_id LONG, item_id LONG, similarity DOUBLE, first_word LONG, words LONG"
    found = spark.createDataFrame([], shape)
    for rows in _groups(items):
        sent = spark.sparkContext.broadcast(Index.of([tuple(r) for r in rows]))

        def search(batches, sent=sent):
            for batch in batches:
                for start, stop in common.slices(batch["text"]):
                    cut = batch.slice(start, stop - start)
                    hits = matches(cut["text"], sent.value, threshold)
                    if hits:
                        ids = cut["doc_id"].take(pa.array([m[0] for m in hits], pa.int64()))
                        rest = [pa.array([m[k] for m in hits], t) for k, t in ((1, pa.int64()), (2, pa.float64()), (3, pa.int64()), (4, pa.int64()))]
                        yield pa.RecordBatch.from_arrays([ids, *rest], ["doc_id", "item_id", "similarity", "first_word", "words"])

        found = found.union(documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(search, shape))
    return found


def without_leaks(documents: DataFrame, items: DataFrame, threshold: float = SIMILARITY) -> DataFrame:
    """Documents that hold no benchmark item, with the columns they came with."""
    spark, schema = documents.sparkSession, documents.schema
    for rows in _groups(items):
        sent = spark.sparkContext.broadcast(Index.of([tuple(r) for r in rows]))

        def clean(batches, sent=sent):
            for batch in batches:
                for start, stop in common.slices(batch["text"]):
                    cut = batch.slice(start, stop - start)
                    keep = np.ones(stop - start, bool)
                    keep[[m[0] for m in matches(cut["text"], sent.value, threshold)]] = False
                    yield cut.filter(pa.array(keep))

        documents = documents.mapInArrow(clean, schema)
    return documents
