"""Near-duplicates: improved consistent weighted sampling over TF-IDF shingles, banded and verified.

A text is a weighted set of five-word shingles: times in the text x ln(1 + texts / texts with it). The
counts of all shingles of the corpus live in a count sketch of fixed size (DEPTH x CELLS), summed from
every document. It resolves shingles in more than about (mean shingles per text / CELLS) of all
texts, the same share at any size. All shingles in less than RARE of all texts have the same, highest weight:
what the copies of a group share is no boilerplate, and must not weigh less than the words in which they differ, the less
the larger the group and the corpus. Equal shingles weigh the same everywhere, so weighted Jaccard similarity is
well defined and is what candidates are verified by.

Candidates share all ROWS samples of one of BANDS bands. Such a group is cut into parts of about PART
texts, and a part yields a spanning forest by the agreement of all samples: at most one link a text, and a
second to its next best neighbour. Links are verified by their exact similarity; texts linked by those that
pass form a class. Then the weighted sets of a group that holds several classes are dealt to cells, every
two cells meet in a block, and the exact similarity of every two texts of different classes is computed
there, as a product of matrices. A block gives only links that pass and join two classes, fewer than its texts.

Defined cases: a null text counts as empty; texts without words equal only equal texts; equal texts
share a class whatever their ids, repeated rows and null ids included; a class is named by its
smallest id, null if it has none; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from filinglake.llm import common

SIMILARITY = 0.8
BANDS, ROWS = 12, 3
DEPTH, CELLS = 2, 1 << 19
# Share of all texts up to which a shingle counts as rare, however many copies hold it.
RARE = 0.01
# Texts of a part of a group, and the share of equal samples that makes a link of its forest worth verifying.
PART, AGREEMENT = 512, 20 / (BANDS * ROWS)
# About so many texts and different shingles of texts go to a cell; a group has as many cells as it needs.
CELL_TEXTS, CELL_SHINGLES = 2048, 1 << 20
# Texts by texts, and columns, of one product of matrices.
TILE, COLUMNS = 512, 4096
BATCH_PAIRS = 4096
_CHUNK = 1 << 14
# Tasks that sum the sketch; each sends four of its parts to the driver, about half a MB.
_SUMS = DEPTH * CELLS // _CHUNK // 4
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _seed(n: int) -> np.uint64:
    return np.uint64(int(_STEP) * n % 2**64)


def _quantiles(size: int = 1 << 16) -> np.ndarray:
    """Quantiles of the Gamma(2, 1) distribution at the middles of `size` equal steps."""
    x = np.linspace(0, 30, 1 << 20)
    return np.interp((np.arange(size) + 0.5) / size, 1 - (1 + x) * np.exp(-x), x)


_GAMMA = _quantiles()


def _cells(hashes: np.ndarray, row: int) -> np.ndarray:
    return (common.mix(hashes + _seed(row + 1)) >> np.uint64(64 - CELLS.bit_length() + 1)).astype(np.int64)


@dataclass(frozen=True)
class Frequencies:
    """How many texts hold a shingle: sketch of DEPTH x CELLS counters (8 MB), and the number of texts."""

    texts: int
    counts: np.ndarray

    def weights(self, hashes: np.ndarray, times: np.ndarray) -> np.ndarray:
        """times x ln(1 + texts / texts with the shingle, or RARE of the texts), the mean load of a cell taken off its count."""
        total = self.counts[0].sum()
        found = np.full(len(hashes), np.inf)
        for row in range(DEPTH):
            held = self.counts[row][_cells(hashes, row)]
            found = np.minimum(found, held - (total - held) / (CELLS - 1))
        return times * np.log1p(self.texts / np.maximum(found, max(1.0, RARE * self.texts)))


def frequencies(texts: DataFrame) -> Frequencies:
    """Count every shingle of every text once: a sketch per task, summed part by part, 8 MB to the driver, about half a MB at once."""

    def count(batches):
        counts, n = np.zeros((DEPTH, CELLS), np.int64), 0
        for batch in batches:
            n += batch.num_rows
            for start, stop in common.slices(batch["text"]):
                hashes, _, _ = common.weighted_set(*common.shingles(batch["text"].slice(start, stop - start)))
                for row in range(DEPTH):
                    counts[row] += np.bincount(_cells(hashes, row), minlength=CELLS)
        if n:
            flat = counts.ravel().astype(np.int32)
            for chunk in range(0, len(flat), _CHUNK):
                part = flat[chunk : chunk + _CHUNK].tobytes()
                yield pa.RecordBatch.from_pydict({"chunk": pa.array([chunk // _CHUNK], pa.int32()), "n": pa.array([n], pa.int64()), "part": pa.array([part], pa.binary())})

    def add(batches):
        sums: dict[int, tuple[int, np.ndarray]] = {}
        for batch in batches:
            for chunk, n, part in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                before = sums.get(chunk, (0, 0))
                sums[chunk] = (before[0] + n, before[1] + np.frombuffer(part, np.int32).astype(np.int64))
        for chunk, (n, part) in sums.items():
            yield pa.RecordBatch.from_pydict({"chunk": pa.array([chunk], pa.int32()), "n": pa.array([n], pa.int64()), "part": pa.array([part.tobytes()], pa.binary())})

    shape = "chunk INT, n LONG, part BINARY"
    summed = texts.select("text").mapInArrow(count, shape).repartition(_SUMS, "chunk").mapInArrow(add, shape)
    counts, n = np.zeros(DEPTH * CELLS, np.int64), 0
    for row in summed.toLocalIterator():
        counts[row.chunk * _CHUNK : (row.chunk + 1) * _CHUNK] = np.frombuffer(row.part, np.int64)
        n = row.n
    return Frequencies(n, counts.reshape(DEPTH, CELLS))


def samples(hashes: np.ndarray, weights: np.ndarray, offsets: np.ndarray, number: int) -> np.ndarray:
    """`number` consistent weighted samples of each non-empty set, one row a sample.

    Two sets have the same sample with the probability of their weighted Jaccard similarity. For each
    shingle r and c are Gamma(2, 1) and b uniform, all drawn from its hash; t = floor(ln w / r + b),
    ln y = r (t - b), and the sample is the (shingle, t) with the least ln c - ln y - r.
    """
    at = offsets[:-1][np.diff(offsets) > 0]
    sizes = np.diff(np.concatenate((at, [len(hashes)])))
    logs = np.log(weights)
    out = np.empty((number, len(at)), np.uint64)
    low, half = np.uint64(0xFFFF), np.uint64(32)
    for k in range(number):
        z = common.mix(hashes + _seed(1000 + k))
        r = _GAMMA[z >> np.uint64(48)]
        b = ((z >> half) & low) * (1 / 65536)
        u = ((z & np.uint64(0xFFFFFFFF)) + 0.5) * 2.0**-32
        u *= ((common.mix(z + _STEP) >> half) + 0.5) * 2.0**-32
        t = np.floor(logs / r + b)
        a = np.log(-np.log(u))
        a -= r * (t - b + 1)
        least = np.flatnonzero(a == np.repeat(np.minimum.reduceat(a, at), sizes))
        first = least[np.searchsorted(least, at)]  # of a tie the smallest hash, in any text alike
        out[k] = common.mix(hashes[first] * _STEP + t[first].astype(np.int64).astype(np.uint64))
    return out


def _signed(sent):
    def sign(batches):
        for batch in batches:
            for start, stop in common.slices(batch["text"]):
                cut = batch.slice(start, stop - start)
                hashes, times, offsets = common.weighted_set(*common.shingles(cut["text"]))
                full = np.diff(offsets) > 0
                bands = np.zeros((len(full), BANDS), np.uint64)
                drawn = [None] * len(full)
                if full.any():
                    found = samples(hashes, sent.value.weights(hashes, times), offsets, BANDS * ROWS)
                    for band in range(BANDS):
                        key = np.full(found.shape[1], band, np.uint64)
                        for row in range(ROWS):
                            key = common.mix(key * _STEP + found[band * ROWS + row])
                        bands[full, band] = key
                    short = np.ascontiguousarray(found.T.astype(np.uint32))
                    for row, own in zip(np.flatnonzero(full), short, strict=True):
                        drawn[row] = own.tobytes()
                flat = pa.array(bands[full].ravel().view(np.int64))
                ends = np.concatenate(([0], np.cumsum(full * BANDS))).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), flat)
                yield pa.RecordBatch.from_arrays(
                    [cut["doc_id"], cut["digest"], lists, pa.array(drawn, pa.binary()), pa.array(np.diff(offsets))],
                    ["doc_id", "digest", "bands", "samples", "shingles"],
                )

    return sign


def similarities(left: pa.Array, right: pa.Array, known: Frequencies) -> np.ndarray:
    """Weighted Jaccard similarity of texts pair by pair; 1 for two texts without words."""
    sides = []
    for texts in (left, right):
        hashes, times, offsets = common.weighted_set(*common.shingles(texts))
        owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        keys = (owner.astype(np.uint64) << np.uint64(48)) | hashes
        sides.append((keys, known.weights(hashes, times), owner))
    (keys, weights, owner), (keys2, weights2, owner2) = sides
    n = len(left)
    total = np.bincount(owner, weights, n) + np.bincount(owner2, weights2, n)
    shared = np.zeros(n)
    if len(keys) and len(keys2):
        at = np.minimum(np.searchsorted(keys2, keys), len(keys2) - 1)
        same = keys2[at] == keys
        shared = np.bincount(owner[same], np.minimum(weights[same], weights2[at[same]]), n)
    return np.where(total > 0, shared / np.where(total > 0, total - shared, 1), 1.0)


def _verified(sent):
    def verify(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 128):
                cut = batch.slice(start, 128)
                found = similarities(cut["left"], cut["right"], sent.value)
                yield pa.RecordBatch.from_arrays([cut["a"], cut["b"], pa.array(found)], ["a", "b", "similarity"])

    return verify


def agreement(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Number of equal samples of each text on the left with each on the right."""
    equal = np.zeros((len(left), len(right)), np.int16)
    for k in range(left.shape[1]):
        equal += left[:, None, k] == right[None, :, k]
    return equal


def forest(drawn: np.ndarray, least: float = AGREEMENT) -> list[tuple[int, int]]:
    """Links of a maximum spanning forest by share of equal samples, and second-best links."""
    n = len(drawn)
    equal = agreement(drawn, drawn)
    np.fill_diagonal(equal, -1)
    enough = least * drawn.shape[1] - 1e-9
    links, best, near = [], np.full(n, -1), np.zeros(n, np.int64)
    free = np.ones(n, bool)
    for _ in range(n):
        at = int(np.argmax(np.where(free, best, -2)))
        if best[at] >= enough:
            links.append((int(near[at]), at))
        else:
            at = int(np.argmax(free))
        free[at] = False
        closer = equal[at] > best
        best[closer], near[closer] = equal[at][closer], at
    if n > 2:
        second = np.argpartition(equal, n - 2, axis=1)[:, n - 2]
        links += [(i, int(j)) for i, j in enumerate(second) if equal[i, j] >= enough]
    return links


def _drawn(rows: list[tuple]) -> np.ndarray:
    return np.frombuffer(b"".join(r[-1] for r in rows), np.uint32).reshape(len(rows), -1)


def _packed(pairs: list[tuple]) -> pa.RecordBatch:
    a, b = zip(*pairs, strict=True) if pairs else ([], [])
    return pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])


def _grouped(batches, keys: int):
    """Rows in runs of equal first `keys` columns, by which they come sorted; a run may go over several batches."""
    kept: list[tuple] = []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if kept and kept[0][:keys] != row[:keys]:
                yield kept
                kept = []
            kept.append(row)
    if kept:
        yield kept


def _parted(batches):
    """Links within each part of a group, of rows (key, part, digest, samples)."""
    out: list[tuple] = []
    for rows in _grouped(batches, 2):
        out += [tuple(sorted((rows[i][2], rows[j][2]))) for i, j in forest(_drawn(rows))]
        if len(out) >= BATCH_PAIRS:
            yield _packed(out)
            out = []
    yield _packed(out)


def _weighted(batches):
    """(digest, hashes, times) of the texts: their different shingles, ascending, and how often each is there."""
    for batch in batches:
        for start, stop in common.slices(batch["text"]):
            cut = batch.slice(start, stop - start)
            hashes, times, offsets = common.weighted_set(*common.shingles(cut["text"]))
            rows = list(zip(offsets[:-1], offsets[1:], strict=True))
            yield pa.RecordBatch.from_arrays(
                [
                    cut["digest"],
                    pa.array([hashes[i:j].tobytes() for i, j in rows], pa.binary()),
                    pa.array([times[i:j].astype(np.int32).tobytes() for i, j in rows], pa.binary()),
                ],
                ["digest", "hashes", "times"],
            )


@dataclass(frozen=True)
class Sets:
    """Weighted sets of several texts: flat hashes and times, the text of each, and the weight of each text."""

    hashes: np.ndarray
    times: np.ndarray
    owner: np.ndarray
    total: np.ndarray

    @classmethod
    def of(cls, rows: list[tuple], known: Frequencies) -> Sets:
        """From rows that end with hashes and times."""
        hashes = np.frombuffer(b"".join(r[-2] for r in rows), np.uint64)
        times = np.frombuffer(b"".join(r[-1] for r in rows), np.int32).astype(np.int64)
        owner = np.repeat(np.arange(len(rows)), [len(r[-2]) // 8 for r in rows])
        return cls(hashes, times, owner, np.bincount(owner, known.weights(hashes, times), len(rows)))

    def within(self, hashes: np.ndarray) -> Sets:
        """Only the shingles among the ascending `hashes`; weights of texts stay whole."""
        at = np.minimum(np.searchsorted(hashes, self.hashes), max(len(hashes) - 1, 0))
        kept = hashes[at] == self.hashes if len(hashes) else np.zeros(len(self.hashes), bool)
        return Sets(self.hashes[kept], self.times[kept], self.owner[kept], self.total)


def overlaps(left: Sets, right: Sets, known: Frequencies) -> np.ndarray:
    """Weight that each text on the left shares with each on the right: the sum of the smaller weights.

    A shingle has a column for each different number of times, with the weight of the step from the
    number before; a text has all columns up to its own number.
    """
    shared = np.zeros((len(left.total), len(right.total)))
    both = np.intersect1d(left.hashes, right.hashes)
    left, right = left.within(both), right.within(both)
    if not len(both):
        return shared
    hashes, times = np.concatenate((left.hashes, right.hashes)), np.concatenate((left.times, right.times))
    order = np.lexsort((times, hashes))
    hashes, times = hashes[order], times[order]
    first = np.ones(len(order), bool)
    first[1:] = (hashes[1:] != hashes[:-1]) | (times[1:] != times[:-1])
    column = np.empty(len(order), np.int64)
    column[order] = np.cumsum(first) - 1
    hashes, times = hashes[first], times[first]
    opens = np.ones(len(hashes), bool)
    opens[1:] = hashes[1:] != hashes[:-1]
    steps = times - np.where(opens, 0, np.concatenate(([0], times[:-1])))
    weight = known.weights(hashes, np.ones(len(hashes))) * steps
    begin = np.maximum.accumulate(np.where(opens, np.arange(len(hashes)), 0))

    def filled(owner: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        counts = last - begin[last] + 1
        cells = np.repeat(begin[last] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
        order = np.argsort(cells, kind="stable")
        return cells[order], np.repeat(owner, counts)[order]

    sides = filled(left.owner, column[: len(left.owner)]), filled(right.owner, column[len(left.owner) :])
    for start in range(0, len(hashes), COLUMNS):
        stop = min(start + COLUMNS, len(hashes))
        held = []
        for (cells, owner), texts in zip(sides, (left, right), strict=True):
            low, high = np.searchsorted(cells, (start, stop))
            matrix = np.zeros((len(texts.total), stop - start))
            matrix[owner[low:high], cells[low:high] - start] = 1
            held.append(matrix)
        shared += (held[0] * weight[start:stop]) @ held[1].T
    return shared


def _joining(sent, threshold: float):
    """Links (a, b) of each block of two cells that pass and join two classes.

    Rows are (key, i, j, cell, digest, root, hashes, times).
    """

    def join(batches):
        for rows in _grouped(batches, 3):
            _, i, j = rows[0][:3]
            sides = [[r for r in rows if r[3] == cell] for cell in ([i] if i == j else [i, j])]
            numbers: dict[bytes, int] = {}
            roots = [np.array([numbers.setdefault(r[5], len(numbers)) for r in side], np.int64) for side in sides]
            if len(numbers) == 1 or not all(sides):
                continue
            into = np.arange(len(numbers))  # union-find over the classes of this block

            def top(x: int, into=into) -> int:
                while into[x] != x:
                    into[x] = into[into[x]]
                    x = into[x]
                return int(x)

            tiles = [[(at, Sets.of(side[at : at + TILE], sent.value)) for at in range(0, len(side), TILE)] for side in sides]
            out = []
            for x, left in tiles[0]:
                for y, right in tiles[-1]:
                    if i == j and y < x:
                        continue
                    while (into[into] != into).any():
                        into[:] = into[into]
                    apart = into[roots[0][x : x + TILE]][:, None] != into[roots[-1][y : y + TILE]][None, :]
                    # Sets of very unlike weights can't be alike, whatever they share.
                    least, most = np.minimum.outer(left.total, right.total), np.maximum.outer(left.total, right.total)
                    apart &= least >= (threshold - 1e-9) * most
                    if not apart.any():
                        continue
                    shared = overlaps(left, right, sent.value)
                    alike = apart & (shared >= threshold * (left.total[:, None] + right.total[None, :] - shared))
                    for p, q in np.argwhere(alike).tolist():
                        one, other = top(roots[0][x + p]), top(roots[-1][y + q])
                        if one != other:
                            into[other] = one
                            out.append(tuple(sorted((sides[0][x + p][4], sides[-1][y + q][4]))))
            if out:
                yield _packed(out)

    return join


def _crowded(own: DataFrame) -> DataFrame:
    """(key, n, digest) of the band groups of more than one text, from (digest, bands, samples)."""
    state = own.select(F.explode("bands").alias("key"), "digest")
    sizes = state.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return common.land(state.join(sizes, "key").select("key", "n", "digest"), "near-crowded")


def _within_parts(own: DataFrame, crowded: DataFrame) -> DataFrame:
    """Pairs (a, b) of digests linked by the forests of all parts."""
    part = F.pmod(F.xxhash64("key", "digest"), F.ceil(F.col("n") / PART).cast("int")).cast("int").alias("part")
    cut = crowded.select("key", part, "digest").join(own.select("digest", "samples"), "digest").select("key", "part", "digest", "samples")
    dealt = cut.repartition("key", "part").sortWithinPartitions("key", "part", "digest")
    return common.land(dealt.mapInArrow(_parted, "a BINARY, b BINARY").distinct(), "near-pairs")


def _across_classes(held: DataFrame, weighted: DataFrame, sent, threshold: float) -> DataFrame:
    """Links (a, b) between texts of a group in different classes, enough to join all that belong together, from `_mixed`.

    A group is dealt to cells, the texts of its largest class apart from the others, and every cell of the
    others meets every cell, each two in a block of their own. Small groups are one cell.
    """
    by_class = held.groupBy("key", "root").agg(F.count(F.lit(1)).alias("texts"), F.sum("shingles").alias("shingles"))
    total = lambda name: (F.sum(name) - F.max(F.struct("texts", "shingles", "root"))[name]).alias(name)
    groups = by_class.groupBy("key").agg(
        total("texts"), total("shingles"), F.max(F.struct("texts", "shingles", "root")).alias("largest")
    )
    cells = lambda texts, shingles: F.greatest(F.ceil(texts / CELL_TEXTS), F.ceil(shingles / CELL_SHINGLES)).cast("int")
    every = cells(F.col("texts") + F.col("largest.texts"), F.col("shingles") + F.col("largest.shingles"))
    groups = groups.select(
        "key",
        F.when(every > 1, F.col("largest.root")).alias("largest"),
        F.when(every > 1, cells(F.col("texts"), F.col("shingles"))).otherwise(1).alias("others"),
        F.when(every > 1, cells(F.col("largest.texts"), F.col("largest.shingles"))).otherwise(0).alias("rest"),
    )
    large = F.col("root").eqNullSafe(F.col("largest"))
    number = F.xxhash64("key", "digest")
    cell = F.when(large, F.col("others") + F.pmod(number, "rest")).otherwise(F.pmod(number, "others")).cast("int")
    meets = F.sequence(F.lit(0), F.when(large, F.col("others")).otherwise(F.col("others") + F.col("rest")) - 1)
    block = lambda c: F.struct(F.least("cell", c).alias("i"), F.greatest("cell", c).alias("j"))
    dealt = (
        held.join(groups, "key")
        .select("key", "digest", "root", cell.alias("cell"), meets.alias("meets"))
        .select("key", F.explode(F.transform("meets", block)).alias("block"), "cell", "digest", "root")
        .join(weighted, "digest")
        .select("key", "block.i", "block.j", "cell", "digest", "root", "hashes", "times")
        .repartition("key", "i", "j")
        .sortWithinPartitions("key", "i", "j", "digest")
    )
    return common.land(dealt.mapInArrow(_joining(sent, threshold), "a BINARY, b BINARY").distinct(), "near-across")


def _mixed(crowded: DataFrame, rooted: DataFrame) -> DataFrame:
    """(key, digest, root, shingles) of the groups that hold more than one class."""
    held = crowded.join(rooted, "digest")
    several = held.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high")
    return common.land(held.join(several.select("key"), "key", "left_semi").select("key", "digest", "root", "shingles"), "near-mixed")


def _texts_of(texts: DataFrame, distinct: DataFrame, digests: DataFrame) -> DataFrame:
    """(digest, text) of these digests, each once."""
    stand_in = F.lit(-(2**63))
    needed = distinct.join(digests, "digest").select("digest", F.coalesce("exact_id", stand_in).alias("doc_id"))
    once = Window.partitionBy("doc_id", "digest").orderBy("digest")
    return (
        texts.withColumn("doc_id", F.coalesce("doc_id", stand_in))
        .join(needed, ["doc_id", "digest"], "left_semi")
        .withColumn("turn", F.row_number().over(once))
        .where("turn = 1")
        .select("digest", "text")
    )


def _checked(texts: DataFrame, distinct: DataFrame, pairs: DataFrame, sent) -> DataFrame:
    """(a, b, similarity) of the pairs, by their exact similarity."""
    ends = pairs.select(F.col("a").alias("digest")).union(pairs.select(F.col("b").alias("digest"))).distinct()
    found = common.land(_texts_of(texts, distinct, ends), "near-texts")
    both = (
        pairs.join(found.select(F.col("digest").alias("a"), F.col("text").alias("left")), "a")
        .join(found.select(F.col("digest").alias("b"), F.col("text").alias("right")), "b")
        .select("a", "b", "left", "right")
    )
    links = common.land(both.mapInArrow(_verified(sent), "a BINARY, b BINARY, similarity DOUBLE"), "near-links")
    common.discard(found)
    return links


def _rooted(distinct: DataFrame, edges: DataFrame) -> DataFrame:
    """(digest, exact_id, shingles, root) of every text, by the classes that the edges make."""
    roots = common.components(edges, "near").withColumnRenamed("node", "digest")
    rooted = distinct.select("digest", "exact_id", "shingles").join(roots, "digest", "left")
    return common.land(rooted.withColumn("root", F.coalesce("root", "digest")), "near-rooted")


def _rejoined(rooted: DataFrame, edges: DataFrame) -> DataFrame:
    """`rooted` after `edges` have joined some of its classes: only their roots are followed."""
    end = lambda name: rooted.select(F.col("digest").alias(name), F.col("root").alias(f"root_{name}"))
    between = edges.join(end("a"), "a").join(end("b"), "b").select(F.col("root_a").alias("a"), F.col("root_b").alias("b"))
    roots = common.components(between, "near-roots").select(F.col("node").alias("root"), F.col("root").alias("top"))
    joined = rooted.join(roots, "root", "left").withColumn("root", F.coalesce("top", "root"))
    return common.land(joined.select("digest", "exact_id", "root"), "near-rooted")


def classes(documents: DataFrame, threshold: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """(doc_id, digest, exact_id, class_id) of every row, and verified links (a, b) that join the texts of each class."""
    spark = documents.sparkSession
    texts = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), common.digest(F.col("text")).alias("digest"))
    sent = spark.sparkContext.broadcast(frequencies(texts))
    signed = common.land(
        texts.mapInArrow(_signed(sent), "doc_id LONG, digest BINARY, bands ARRAY<LONG>, samples BINARY, shingles LONG"), "near-signed"
    )
    distinct = common.land(
        signed.groupBy("digest").agg(F.min("doc_id").alias("exact_id"), F.min(F.struct("samples", "bands", "shingles")).alias("s")).select("digest", "exact_id", "s.*"),
        "near-distinct",
    )
    own = distinct.where("samples IS NOT NULL")
    crowded = _crowded(own)
    pairs = _within_parts(own, crowded)
    links = _checked(texts, distinct, pairs, sent)
    common.discard(pairs)
    edges = links.where(F.col("similarity") >= threshold).select("a", "b")
    rooted = _rooted(distinct, edges)
    mixed = _mixed(crowded, rooted.select("digest", "root", "shingles"))
    common.discard(crowded)
    weighted = common.land(
        _texts_of(texts, distinct, mixed.select("digest").distinct()).mapInArrow(_weighted, "digest BINARY, hashes BINARY, times BINARY"), "near-weighted"
    )
    across = _across_classes(mixed, weighted, sent, threshold)
    if not across.isEmpty():
        edges = edges.union(across)
        before, rooted = rooted, _rejoined(rooted, across)
        common.discard(before)
    common.discard(mixed, weighted)
    sent.destroy()
    named = rooted.groupBy("root").agg(F.min("exact_id").alias("class_id"))
    by_text = common.land(rooted.join(named, "root").select("digest", "exact_id", "class_id"), "near-classes")
    return signed.select("doc_id", "digest").join(by_text, "digest"), edges


def near_duplicates(documents: DataFrame, threshold: float = SIMILARITY) -> DataFrame:
    """doc_id, exact_id (smallest id of an equal text), class_id and kept of every row."""
    found, _ = classes(documents, threshold)
    return found.select("doc_id", "exact_id", "class_id", F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(False)).alias("kept"))


def one_of_each(documents: DataFrame, threshold: float = SIMILARITY) -> DataFrame:
    """One document of each class, the one with the smallest id, with the columns it came with.

    Of repeated rows with that id one stays; of a class without any id, one row of its first text.
    """
    found, _ = classes(documents, threshold)
    stand_in = F.lit(-(2**63))
    own_id, own_digest = common.unused(documents, "near_id"), common.unused(documents, "near_digest")
    kept = (
        found.where(F.col("doc_id").eqNullSafe(F.col("class_id")))
        .groupBy(F.col("class_id"), F.when(F.col("class_id").isNull(), F.col("digest")).alias("own"))
        .agg(F.min("digest").alias(own_digest))
        .select(F.coalesce("class_id", stand_in).alias(own_id), own_digest)
    )
    once = Window.partitionBy(own_id, own_digest).orderBy(own_id)
    turn = common.unused(documents, "near_turn")
    return (
        documents.withColumns({own_id: F.coalesce("doc_id", stand_in), own_digest: common.digest(F.col("text"))})
        .join(kept, [own_id, own_digest], "left_semi")
        .withColumn(turn, F.row_number().over(once))
        .where(F.col(turn) == 1)
        .select(*documents.columns)
    )
