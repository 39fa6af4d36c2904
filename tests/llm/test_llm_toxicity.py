import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from filinglake.llm import toxicity

LABELS = "doc_id LONG, toxic INT, text STRING"


@pytest.fixture(scope="module")
def labelled(spark):
    """An insult alone or a group alone is harmless; both together are toxic: not additive."""
    draw = random.Random(3)
    rows, labels = [], []
    for i in range(2400):
        words = [f"w{draw.randrange(60)}" for _ in range(draw.randrange(10, 40))]
        insult, group = draw.random() < 0.5, draw.random() < 0.5
        words += ["dunce"] * insult + ["folk"] * group
        draw.shuffle(words)
        rows.append((i, " ".join(words) + "!"))
        labels.append((i, int(insult and group), "x"))
    return spark.createDataFrame(rows, "doc_id LONG, text STRING"), spark.createDataFrame(labels, LABELS)


def test_logits_hold_all_pairs():
    draw = np.random.default_rng(1)
    model = toxicity.Model(0.3, draw.normal(size=9), draw.normal(size=(9, 3)), np.arange(9))
    texts = [[0, 3, 5], [], [8], [1, 2, 4, 6, 7]]
    want = []
    for own in texts:
        pairs = sum(model.factors[i] @ model.factors[j] for i in own for j in own if i < j)
        want.append(0.3 + model.weights[own].sum() + pairs)
    got = model.logits(np.array(sum(texts, []), np.int64), np.cumsum([0, *map(len, texts)]))
    assert np.allclose(got, want)


def test_learns_a_meeting_of_words(labelled):
    documents, labels = labelled
    scored = toxicity.scores(documents, labels).join(labels.select("doc_id", "toxic"), "doc_id").where("held_out")
    right = scored.agg(F.avg((F.col("predicted") == F.col("toxic")).cast("int"))).first()[0]
    assert scored.count() > 600 and right > 0.95


def test_held_out_labels_teach_nothing(labelled):
    documents, labels = labelled
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    turned = labels.withColumn("toxic", F.when(fold, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, other = toxicity.train(documents, labels), toxicity.train(documents, turned)
    assert one.bias == pytest.approx(other.bias) and np.allclose(one.weights, other.weights, atol=1e-5)


def test_odd_rows(spark, docs, odd, labelled):
    documents, labels = labelled
    model = toxicity.train(documents, labels)
    scored = toxicity.score(docs(odd), model)
    assert scored.count() == len(odd) and set(scored.columns) == set(docs(odd).columns)
    assert scored.where("score IS NULL OR score < 0 OR score > 1").count() == 0
    empty = toxicity.score(docs([(1, None), (2, ""), (3, "!!")]), model).collect()
    assert len({round(r.score, 9) for r in empty}) == 1
    nulls = spark.createDataFrame([(1, None, "a"), (None, 1, "a"), (5, 1, None)], LABELS)
    assert toxicity.scores(docs(odd), nulls).count() == len(odd)


def test_empty(spark, docs, odd):
    none = spark.createDataFrame([], LABELS)
    assert {r.score for r in toxicity.scores(docs(odd), none).collect()} == {0.5}
    assert toxicity.scores(docs([]), none).count() == 0
    assert toxicity.without_toxic(docs(odd), none).columns == docs(odd).columns
    assert toxicity.without_toxic(docs(odd), none).count() == len(odd)


def test_a_clashing_column_stays(docs, odd, labelled):
    frame = docs(odd).withColumn("chance", F.lit("own")).withColumn("_Chance", F.lit("own"))
    kept = toxicity.without_toxic(frame, labelled[1])
    assert kept.columns == frame.columns and kept.where("chance <> 'own' OR `_Chance` <> 'own'").count() == 0


def test_numbers_of_learned_features():
    model = toxicity.Model(0.0, np.zeros(3), np.zeros((3, 2)), np.array([2, 5, 9]))
    index, offsets = model.numbered(np.array([1, 2, 9, 9, 11, 5]), np.array([0, 2, 2, 5, 6]))
    assert index.tolist() == [0, 2, 2, 1] and offsets.tolist() == [0, 1, 1, 3, 4]
    assert model.logits(index, offsets).tolist() == [0.0] * 4


def test_features_are_a_set():
    index, offsets = toxicity.features(pa.array(["a a, A b", "", None, "b"]))
    assert np.diff(offsets).tolist() == [4, 0, 0, 2]
