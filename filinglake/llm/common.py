"""Helpers the operators share: reading, landing, word and shingle hashes, ranks, components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from filinglake.session import prepare, work_path
from filinglake.sinks.lake import remove

SHINGLE_WORDS = 5
# Rows handed to Python at once; texts of a batch are then cut into slices of SLICE_BYTES.
BATCH_ROWS = 512
SLICE_BYTES = 1 << 20
# Odd multipliers, one per position of a word in its shingle.
_POSITION = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F],
    dtype=np.uint64,
)


def ready(spark: SparkSession) -> SparkSession:
    """Session settings the operators rely on: UTC, adaptive plans, small Arrow batches."""
    prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def land(df: DataFrame, label: str) -> DataFrame:
    """Write a table into the shared folder and read it again: cuts lineage, survives lost executors."""
    path = work_path(df.sparkSession, f"llm-{label}")
    df.write.option("compression", "zstd").parquet(path)
    found = df.sparkSession.read.schema(df.schema).parquet(path)
    found.landed = path
    return found


def discard(*landed: DataFrame) -> None:
    """Delete landed tables that nothing reads any more."""
    for df in landed:
        remove(df.sparkSession, [df.landed])


def unused(df: DataFrame, name: str) -> str:
    """A column name that `df` doesn't have, in any case of its letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def checksum(text: Column) -> Column:
    """Unsigned CRC-32 of the UTF-8 text; null counts as empty."""
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


def digest(text: Column) -> Column:
    """MD5 of the text as 16 bytes; null counts as empty."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def fold(doc_id: Column, folds: int) -> Column:
    """Fold of a document: CRC-32 of its id as text, modulo `folds`; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64 over a uint64 array."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Row ranges of a batch holding about SLICE_BYTES of text each; one row at least."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(sizes)
    start = 0
    while start < len(sizes):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + SLICE_BYTES, side="right")))
        yield start, stop
        start = stop


def as_array(column) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def words(texts: pa.Array, letters_only: bool = False) -> tuple[pa.Array, np.ndarray]:
    """Lower-cased words split on white space, flat, and offsets of each text (n + 1).

    With `letters_only`, everything but letters, digits and `_` counts as white space. Null texts
    have no words.
    """
    lowered = pc.utf8_lower(pc.fill_null(texts, ""))
    if letters_only:
        lowered = pc.replace_substring_regex(lowered, pattern=r"[^\pL\pN_]+", replacement=" ")
    # Trimmed first: of a blank text the split may leave a blank piece, depending on its neighbours.
    lists = pc.utf8_split_whitespace(pc.utf8_trim_whitespace(lowered))
    offsets = lists.offsets.to_numpy().astype(np.int64)
    flat = lists.values.slice(offsets[0], offsets[-1] - offsets[0])
    offsets = offsets - offsets[0]
    filled = pc.greater(pc.binary_length(flat), 0)
    kept = np.concatenate(([0], np.cumsum(filled.to_numpy(zero_copy_only=False))))
    return flat.filter(filled), kept[offsets]


def word_hashes(flat: pa.Array) -> np.ndarray:
    """64-bit hash of each word: its bytes times a random number per place, summed and mixed."""
    n = len(flat)
    if not n:
        return np.empty(0, np.uint64)
    ends = np.frombuffer(flat.buffers()[1], np.int32)[flat.offset : flat.offset + n + 1].astype(np.int64)
    sizes = np.diff(ends)
    raw = np.frombuffer(flat.buffers()[2], np.uint8)[ends[0] : ends[-1]]
    place = np.arange(len(raw)) - np.repeat(ends[:-1] - ends[0], sizes)
    factors = mix(np.arange(1, int(sizes.max(initial=0)) + 2, dtype=np.uint64) * _POSITION[0])
    out = np.zeros(n, np.uint64)
    full = sizes > 0
    if full.any():
        out[full] = np.add.reduceat((raw.astype(np.uint64) + np.uint64(1)) * factors[place], (ends[:-1] - ends[0])[full])
    return mix(out + sizes.astype(np.uint64) * _POSITION[1])


def shingles(texts: pa.Array, size: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the word shingles of each text in order, flat, and their offsets (n + 1).

    A text of fewer words than `size` has one shingle of all its words; one without words has none.
    """
    flat, offsets = words(texts)
    return shingles_of(word_hashes(flat), offsets, size)


def shingles_of(hashes: np.ndarray, offsets: np.ndarray, size: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    counts = np.diff(offsets)
    made = np.where(counts >= size, counts - size + 1, (counts > 0).astype(np.int64))
    to = np.concatenate(([0], np.cumsum(made)))
    if not to[-1]:
        return np.empty(0, np.uint64), to
    padded = np.concatenate((hashes, np.zeros(size, np.uint64)))
    summed = np.zeros(len(hashes), np.uint64)
    for j in range(size):
        summed += padded[j : j + len(hashes)] * _POSITION[j]
    for n in range(1, size):  # texts shorter than a shingle: only their own words
        at = offsets[:-1][counts == n]
        own = np.full(len(at), n, np.uint64)
        for j in range(n):
            own += padded[at + j] * _POSITION[j]
        summed[at] = own
    first = np.repeat(offsets[:-1] - to[:-1], made)
    return mix(summed[first + np.arange(to[-1])]), to


def weighted_set(hashes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different hashes (cut to 48 bits) per text, ascending, with counts and offsets; at most 65,536 texts."""
    n = len(offsets) - 1
    owner = np.repeat(np.arange(n, dtype=np.uint64), np.diff(offsets))
    keys = np.sort((owner << np.uint64(48)) | (hashes >> np.uint64(16)))
    if not len(keys):
        return keys, np.empty(0, np.int64), np.zeros(n + 1, np.int64)
    starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    times = np.diff(np.concatenate((starts, [len(keys)])))
    keys = keys[starts]
    to = np.searchsorted(keys >> np.uint64(48), np.arange(n + 1, dtype=np.uint64))
    return keys & np.uint64((1 << 48) - 1), times, to


def string_list(values: list) -> pa.Array:
    return pa.array(values, pa.string())


def ranked(df: DataFrame, by: list[str], order: list[str], name: str, buckets: int = 64) -> DataFrame:
    """Gapless rank from 0 within `by`, spread over `buckets` parts of each group.

    A group is cut by a hash of `order`, each part is numbered by itself and shifted by the sizes of
    the parts before it, so no task sorts a whole group. Rows that tie in `order` get neighbouring
    ranks. The order of ranks is (part, order): fixed for given rows, not that of `order` itself.
    """
    part = F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int").alias("__part")
    cut = df.select("*", part)
    keys = [*by, "__part"]
    sizes = cut.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    before = sizes.withColumn(
        "__before",
        F.coalesce(
            F.sum("__n").over(Window.partitionBy(*by or [F.lit(0)]).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0),
        ),
    ).drop("__n")
    numbered = cut.withColumn("__row", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1)
    return (
        numbered.join(before, keys)
        .withColumn(name, (F.col("__row") + F.col("__before")).cast("long"))
        .drop("__row", "__before", "__part")
    )


def _edge_sum(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()


def components(edges: DataFrame, label: str) -> DataFrame:
    """(node, root): the smallest node of each connected component, for nodes of `edges` (a, b).

    Alternating star contraction: every node points its larger neighbours to its smallest one, then
    itself and its smaller neighbours likewise, until nothing moves. Sums are reduced before they are
    shuffled, joins on a hub are split by adaptive execution. Either half of a round is landed, so that
    no plan holds more than one join: plans that repeat what they are made of fill the driver.
    """

    def turned(df: DataFrame, one: tuple[str, str], other: tuple[str, str]) -> DataFrame:
        """Two edges (a, b) of each row, from the named columns."""
        ends = [F.struct(F.col(a).alias("a"), F.col(b).alias("b")) for a, b in (one, other)]
        return df.select(F.explode(F.array(*ends)).alias("edge")).select("edge.a", "edge.b")

    downward = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    found = land(downward.where("a <> b").distinct(), f"{label}-edges")
    # The sum of the hashes of all edges tells whether a round has moved any.
    seen, now = None, _edge_sum(found)
    while now[0] and now != seen:
        before = found
        least = turned(before, ("a", "b"), ("b", "a")).groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        upward = before.select(F.col("b").alias("a"), F.col("a").alias("larger"))
        down = land(upward.join(least, "a").select(F.col("larger").alias("a"), F.col("m").alias("b")).distinct(), f"{label}-down")
        met = down.join(down.groupBy("a").agg(F.min("b").alias("m")), "a")
        found = land(turned(met, ("b", "m"), ("a", "m")).where("a <> b").distinct(), f"{label}-stars")
        discard(before, down)
        seen, now = now, _edge_sum(found)
    return found.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        found.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
