"""Document fingerprints: threshold-scaled sketches of five-word shingles.

A sketch keeps every different shingle hash below 1 / SCALE of the hash range, so sketches of parts merge
by union, and two sketches estimate how much of the smaller text the larger one holds, however unequal
they are. A text with few such hashes keeps its LEAST smallest ones instead; merging keeps that rule.
Two sketches are compared below the lower of their limits.

Defined cases: a null text counts as empty; a text without words has the empty fingerprint, which is like
another empty one (1) and unlike any other (0); rows of one id are ordered by text; rows without id come
last; a single row is its own neighbour; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filinglake.llm import common

SCALE, LEAST = 8, 64
LIMIT = np.uint64(2**64 // SCALE)
# Rows of a piece of neighbouring ids, the most pieces (their bounds are kept on the driver), and the bytes
# of text that pieces one behind another are joined up to: a block, which is one task.
PIECE_ROWS, MOST_BLOCKS, BLOCK_BYTES = 250, 1 << 16, 8 << 20
NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def sketch(hashes: np.ndarray) -> np.ndarray:
    """Sorted hashes a text keeps, from those of all its shingles or of the sketches of its parts."""
    keys = np.unique(hashes)
    return keys[: max(int(np.searchsorted(keys, LIMIT)), min(LEAST, len(keys)))]


def limit(kept: np.ndarray) -> np.uint64:
    """The hash up to which a sketch holds every hash of its text."""
    if len(kept) < LEAST:
        return np.uint64(2**64 - 1)
    return max(kept[-1], LIMIT - np.uint64(1))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated share of the smaller text's shingles that the larger one holds."""
    if not len(a) or not len(b):
        return 1.0 if len(a) == len(b) else 0.0
    below = min(limit(a), limit(b))
    a, b = a[: np.searchsorted(a, below, side="right")], b[: np.searchsorted(b, below, side="right")]
    smaller = min(len(a), len(b))
    return len(np.intersect1d(a, b, assume_unique=True)) / smaller if smaller else 0.0


def encode(kept: np.ndarray) -> str:
    return base64.b64encode(kept.astype(">u8").tobytes()).decode()


def decode(fingerprint: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint), ">u8").astype(np.uint64)


def sketches(texts: list[str]) -> list[np.ndarray]:
    out = []
    array = pa.array(texts, pa.string())
    for start, stop in common.slices(array):
        hashes, offsets = common.shingles(array.slice(start, stop - start))
        out += [sketch(hashes[offsets[i] : offsets[i + 1]]) for i in range(stop - start)]
    return out


def edited(text: str, following: str) -> str:
    """The last half of a text (rounded down) replaced by the first as many code points of the next."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _blocked(bounds: np.ndarray, blocks: np.ndarray):
    """Adds `block`, that of the piece: how many bounds are above the id, so blocks descend; ids that are null come last."""

    def add(batches):
        for batch in batches:
            ids = pc.fill_null(batch["doc_id"], 0).to_numpy(zero_copy_only=False)
            null = batch["doc_id"].is_null().to_numpy(zero_copy_only=False)
            place = len(bounds) - np.searchsorted(bounds, ids, side="left")
            place = blocks[np.where(null, len(bounds) + 1, place)].astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(place)], [*batch.schema.names, "block"])

    return add


def _paired(batches):
    """Rows sorted by block, own rows before the next block's first: each with its successor's text."""
    before = None
    for batch in batches:
        rows = []
        columns = [batch[c].to_pylist() for c in ("block", "tail", "doc_id", "text")]
        for row, kept in zip(zip(*columns, strict=True), sketches(columns[3]), strict=True):
            if before is not None and before[0] == row[0]:
                rows.append((before, row[3], kept))
            before = None if row[1] else (*row, kept)
        changed = [edited(own[3], following) for own, following, _ in rows]
        out = []
        for (own, _, next_kept), text, kept in zip(rows, changed, sketches(changed), strict=True):
            sha = hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()
            out.append((own[2], len(own[3]), sha, encode(own[4]), encode(kept), likeness(own[4], kept), likeness(own[4], next_kept)))
        columns = zip(*out, strict=True) if out else [[]] * len(NAMES)
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], NAMES)


def _joined(pieces: list) -> tuple[list, dict[int, int]]:
    """The first piece of each block, and the block of each piece (block, size), when blocks take BLOCK_BYTES.

    Pieces come in order; one that is larger is a block by itself.
    """
    heads, of, size = [], {}, 0
    for piece in pieces:
        if not heads or size + piece["size"] > BLOCK_BYTES:
            heads.append(piece)
            size = 0
        size += piece["size"]
        of[piece["block"]] = len(heads) - 1
    return heads, of


def fingerprints(documents: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, both fingerprints, near_edited and near_next of every row.

    Ids are cut into pieces at approximate quantiles, and pieces one behind another joined to blocks of about
    equal bytes, one a task. A block's last row follows on to the first row of the next one, which is
    added to it, so each block is finished by itself; only the bounds and the size and first (id, digest)
    of each piece, at most MOST_BLOCKS, are gathered.
    """
    spark = documents.sparkSession
    rows = documents.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    n = documents.select("doc_id").count()
    pieces = min(MOST_BLOCKS, max(8, n // PIECE_ROWS))
    shares = [k / pieces for k in range(1, pieces)]
    found = documents.select(F.percentile_approx(F.col("doc_id").cast("long"), shares, max(10_000, 4 * pieces))).first()[0]
    bounds = np.unique(np.array(found or [], np.int64))
    measured = (
        rows.select("doc_id", F.md5(F.col("text").cast("binary")).alias("digest"), (F.octet_length("text") + 64).cast("long").alias("size"))
        .mapInArrow(_blocked(bounds, np.arange(len(bounds) + 2)), "doc_id LONG, digest STRING, size LONG, block INT")
        .groupBy("block")
        .agg(F.max(F.struct("doc_id", "digest")).alias("first"), F.sum("size").alias("size"))
        .select("block", "first.*", "size")
        .collect()
    )
    order, of = _joined(sorted(measured, key=lambda r: r["block"]))
    # A piece without rows may name any block.
    blocks = np.array([of.get(piece, 0) for piece in range(len(bounds) + 2)])
    blocked = rows.mapInArrow(_blocked(bounds, blocks), "doc_id LONG, text STRING, block INT")
    heads = [((i - 1) % len(order), r["doc_id"], r["digest"]) for i, r in enumerate(order)]
    head_rows = spark.createDataFrame(heads, "block INT, doc_id LONG, digest STRING")
    keyed = rows.withColumn("digest", F.md5(F.col("text").cast("binary")))
    same = (keyed["doc_id"].eqNullSafe(head_rows["doc_id"])) & (keyed["digest"] == head_rows["digest"])
    tails = (
        keyed.join(F.broadcast(head_rows), same)
        .select(head_rows["block"], keyed["doc_id"], keyed["text"])
        .groupBy("block")
        .agg(F.first("doc_id").alias("doc_id"), F.first("text").alias("text"))
        .select("block", F.lit(1).alias("tail"), "doc_id", "text")
    )
    both = blocked.select("block", F.lit(0).alias("tail"), "doc_id", "text").union(tails)
    ordered = both.repartitionById(max(1, len(order)), F.col("block")).sortWithinPartitions(
        "block", "tail", F.desc_nulls_last("doc_id"), F.desc(F.md5(F.col("text").cast("binary")))
    )
    shape = "doc_id LONG, n_chars LONG, edited_sha256 STRING, fingerprint STRING, edited_fingerprint STRING, near_edited DOUBLE, near_next DOUBLE"
    return ordered.mapInArrow(_paired, shape)
