"""Toxicity: a factorization machine over hashed words.

Every word and the stem of its first STEM letters is a feature (present or not). Besides one weight per feature the model has a short vector
per feature, and the product of two vectors weighs their meeting in one text, which a sum of single
weights can't express. It is trained in rounds: every partition of the landed sample starts from the
broadcast model, makes one pass of Adagrad over its rows, and the results are averaged. Only features
that are learned have a number in the model, so it is as large as they are many.

Defined cases: a null text counts as empty, and empty texts have the score of the bias alone; rows
without id, label or text teach nothing, of a repeated id every labelled row counts, and equal texts of
equal label count once; without anything to learn from every score is one half; every row is scored
by itself, whole texts of any length a slice of rows at a time, so ties and repeated rows need no rule;
the caller's columns stay as they are; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filinglake.llm import common

FEATURES = 1 << 18
FACTORS = 4
STEM = 4
# Labelled rows learned from at most (about): a share of all of them by a hash of the id.
SAMPLE_ROWS = 24_000
ROUNDS = 16
WORKERS = 6
# A feature is learned if it is in so many texts of the sample, and its share of toxic texts differs
# from that of the others by so many standard errors. Ordinary words would only add noise to long texts.
LEAST_TEXTS, LEAST_ERRORS = 5, 4.0
REJECT = 0.7


@dataclass(frozen=True)
class Model:
    """bias, and of each learned feature a weight and FACTORS numbers; `ids` are their hashes, ascending."""

    bias: float
    weights: np.ndarray
    factors: np.ndarray
    ids: np.ndarray

    def numbered(self, hashes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the learned features among flat hashes of texts, and their offsets."""
        if not len(self.ids):
            return np.empty(0, np.int64), np.zeros(len(offsets), np.int64)
        at = np.minimum(np.searchsorted(self.ids, hashes), len(self.ids) - 1)
        known = self.ids[at] == hashes
        return at[known], np.concatenate(([0], np.cumsum(known)))[offsets]

    def logits(self, index: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """bias + sum of weights + half of (square of summed vectors - sum of squares), per text."""
        out = np.full(len(offsets) - 1, self.bias)
        live = np.flatnonzero(np.diff(offsets))
        if len(live):
            at, v = offsets[live], self.factors[index]
            total = np.add.reduceat(v, at, axis=0)
            out[live] += np.add.reduceat(self.weights[index], at)
            out[live] += 0.5 * ((total**2).sum(1) - np.add.reduceat((v**2).sum(1), at))
        return out


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Different hashed words and stems of each text, flat, and their offsets."""
    flat, offsets = common.words(texts, letters_only=True)
    stems = pc.binary_join_element_wise("<", pc.utf8_slice_codeunits(flat, 0, STEM), "")
    hashes = np.stack((common.word_hashes(flat), common.word_hashes(stems)), 1).ravel() & np.uint64(FEATURES - 1)
    keys, _, to = common.weighted_set(hashes << np.uint64(16), 2 * offsets)
    return keys.astype(np.int64), to


def _features_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start, stop in common.slices(batch["text"]):
            cut = batch.slice(start, stop - start)
            index, offsets = features(cut["text"])
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(index, pa.int32()))
            yield pa.RecordBatch.from_arrays([cut["toxic"], lists], ["toxic", "words"])


def _rows(batches: Iterator[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Labels, flat features and offsets of a partition; the sample's bound bounds it."""
    labels, index, counts = [], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for batch in batches:
        lists = common.as_array(batch["words"])
        labels += batch["toxic"].to_pylist()
        counts.append(np.diff(lists.offsets.to_numpy()).astype(np.int64))
        index.append(lists.flatten().to_numpy().astype(np.int64))
    return np.array(labels, np.float64), np.concatenate(index), np.concatenate(([0], np.cumsum(np.concatenate(counts))))


def _epoch(labels, index, offsets, model: Model, seed: int, rate=0.5, sparse=2e-4, decay=1e-3) -> Model:
    """One pass of Adagrad in small batches over texts in random order; `index` numbers learned features.

    Weights are pulled to 0 by `sparse` a step, so that many ordinary words of a long text don't
    outweigh a few telling ones; factors shrink by `decay`.
    """
    bias, w, v = model.bias, model.weights.copy(), model.factors.copy()
    gw, gv, gb = np.full(len(w), 1e-2), np.full(v.shape, 1e-2), 1e-2
    order = np.random.default_rng(seed).permutation(len(labels))
    for start in range(0, len(order), 32):
        own = order[start : start + 32]
        counts = offsets[own + 1] - offsets[own]
        at = np.concatenate(([0], np.cumsum(counts)))
        picked = index[np.repeat(offsets[own] - at[:-1], counts) + np.arange(at[-1])]
        row = np.repeat(np.arange(len(own)), counts)
        z = Model(bias, w, v, model.ids).logits(picked, at)
        error = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[own]
        bias_step = error.mean()
        gb += bias_step**2
        bias -= rate * bias_step / np.sqrt(gb)
        if not len(picked):
            continue
        vs, total = v[picked], np.zeros((len(own), v.shape[1]))
        np.add.at(total, row, vs)
        seen, back = np.unique(picked, return_inverse=True)
        each = error[row]
        dw = np.bincount(back, each, len(seen)) / len(own)
        slope = each[:, None] * (total[row] - vs)
        dv = np.stack([np.bincount(back, slope[:, f], len(seen)) for f in range(v.shape[1])], 1) / len(own)
        gw[seen] += dw**2
        gv[seen] += dv**2
        step = rate / np.sqrt(gw[seen])
        moved = w[seen] - step * dw
        w[seen] = np.sign(moved) * np.maximum(np.abs(moved) - step * sparse, 0)
        v[seen] = (1 - decay) * v[seen] - 0.2 * rate * dv / np.sqrt(gv[seen])
    return Model(float(bias), w, v, model.ids)


def train(documents: DataFrame, labels: DataFrame, folds: int = 3, held_out: int = 1) -> Model:
    """Model of `labels.toxic` over texts of `documents` outside the held-out fold.

    Rows without id, label or text teach nothing; of a repeated id every labelled row counts. With
    nothing to learn from, every score is one half. At most about SAMPLE_ROWS rows are learned from,
    chosen by a hash of the id, and broadcast to find their texts.
    """
    spark = documents.sparkSession
    usable = labels.where(
        F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (common.fold(F.col("doc_id"), folds) != held_out)
    ).select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    share = min(1.0, SAMPLE_ROWS / max(1, usable.count()))
    if share < 1:
        usable = usable.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000))
    rows = documents.select("doc_id", "text").where(F.col("text").isNotNull()).join(F.broadcast(usable), "doc_id")
    found = rows.select("toxic", "text").mapInArrow(_features_of, "toxic INT, words ARRAY<INT>")
    # Read again in every round, each worker its own files: no round shuffles anything.
    landed = common.land(found.dropDuplicates(["toxic", "words"]).repartition(WORKERS), "toxic-sample")
    sample = landed.coalesce(WORKERS)

    def texts_per_feature(batches):
        labels_, index, offsets = _rows(batches)
        toxic = np.repeat(labels_ > 0, np.diff(offsets))
        for label, own in ((1, toxic), (0, ~toxic)):
            counts = np.bincount(index[own], minlength=FEATURES).astype(np.int32)
            n = [int(((labels_ > 0) == label).sum())]
            yield pa.RecordBatch.from_pydict({"label": pa.array([label], pa.int32()), "n": pa.array(n, pa.int64()), "part": pa.array([counts.tobytes()], pa.binary())})

    # Two vectors of FEATURES counters per worker, whatever the sample.
    texts, hits = [1e-9, 1e-9], [np.zeros(FEATURES), np.zeros(FEATURES)]
    for part in sample.mapInArrow(texts_per_feature, "label INT, n LONG, part BINARY").collect():
        texts[part.label] += part.n
        hits[part.label] += np.frombuffer(part.part, np.int32)
    together = (hits[0] + hits[1]) / sum(texts)
    spread = np.sqrt(together * (1 - together) * (1 / texts[0] + 1 / texts[1])) + 1e-9
    known = (hits[0] + hits[1] >= LEAST_TEXTS) & (np.abs(hits[1] / texts[1] - hits[0] / texts[0]) >= LEAST_ERRORS * spread)
    ids = np.flatnonzero(known)
    rng = np.random.default_rng(11)
    model = Model(0.0, np.zeros(len(ids)), rng.normal(0, 0.01, (FEATURES, FACTORS))[ids], ids)
    for turn in range(ROUNDS):
        sent = spark.sparkContext.broadcast(model)

        def learn(batches, sent=sent, turn=turn):
            labels_, index, offsets = _rows(batches)
            if len(labels_):
                own = _epoch(labels_, *sent.value.numbered(index, offsets), sent.value, seed=turn)
                packed = np.concatenate(([own.bias], own.weights, own.factors.ravel())).astype(np.float32)
                yield pa.RecordBatch.from_pydict(
                    {"n": pa.array([len(labels_)], pa.int64()), "part": pa.array([packed.tobytes()], pa.binary())}
                )

        total, n = 0.0, 0
        for part in sample.mapInArrow(learn, "n LONG, part BINARY").collect():  # WORKERS models
            total = total + part.n * np.frombuffer(part.part, np.float32).astype(np.float64)
            n += part.n
        sent.destroy()  # its copies on disk, too: a later round or stage has no use for it
        if not n:
            break
        total = total / n
        model = Model(float(total[0]), total[1 : len(ids) + 1], total[len(ids) + 1 :].reshape(len(ids), FACTORS), ids)
    common.discard(landed)
    return Model(model.bias, model.weights.astype(np.float32), model.factors.astype(np.float32), ids)


def score(documents: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """`documents` with the probability of the label 1 in a column `name`; null and empty texts have the bias alone.

    A column of that name is replaced; all others are kept as they are. Repeated rows stay.
    """
    sent = documents.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in documents.columns if c != name]

    def scored(batches):
        for batch in batches:
            for start, stop in common.slices(batch["text"]):
                cut = batch.slice(start, stop - start)
                z = sent.value.logits(*sent.value.numbered(*features(cut["text"])))
                chance = 1 / (1 + np.exp(-np.clip(z.astype(np.float64), -30, 30)))
                yield pa.RecordBatch.from_arrays([*cut.columns, pa.array(chance)], [*cut.schema.names, name])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.select(*kept).schema.fields)
    return documents.select(*kept).mapInArrow(scored, f"{fields}, `{name}` DOUBLE")


def without_toxic(documents: DataFrame, labels: DataFrame, threshold: float = REJECT) -> DataFrame:
    """Documents scored below `threshold`, with the columns they came with."""
    name = common.unused(documents, "chance")
    scored = score(documents, train(documents, labels), name)
    return scored.where(F.col(name) < threshold).drop(name)


def scores(documents: DataFrame, labels: DataFrame, folds: int = 3, held_out: int = 1) -> DataFrame:
    """doc_id, held_out, score and predicted (score >= REJECT) of every row; a null id is not held out."""
    scored = score(documents.select("doc_id", "text"), train(documents, labels, folds, held_out))
    return scored.select(
        "doc_id",
        F.coalesce(common.fold(F.col("doc_id"), folds) == held_out, F.lit(False)).alias("held_out"),
        "score",
        F.when(F.col("score") >= REJECT, 1).otherwise(0).cast("int").alias("predicted"),
    )
