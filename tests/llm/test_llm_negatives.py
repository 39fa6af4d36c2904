"""Hard negatives against plain Python; bounds of segments against exact products."""

import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from filinglake.llm import negatives

SCHEMA = "vec_id LONG, embedding ARRAY<FLOAT>, label INT, score STRING, anchor STRING, `rank` STRING"


def plain(rows, positives=5, most=10, low=30, high=90):
    kept = {}
    for i, vector, label in rows:
        if i is None or vector is None or label is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        label = (label + 1) % 10 if i % 7 == 0 else label
        row = (label, [math.floor(256 * float(np.float32(x))) for x in vector])
        kept[i] = min(kept.get(i, row), row)
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    out = []
    for a, (label, own) in kept.items():
        if a % 100:
            continue
        scored = [(-dot(own, v), i, other) for i, (other, v) in kept.items() if i != a]
        for ps, p, _ in sorted(s for s in scored if s[2] == label)[:positives]:
            fit = sorted(s for s in scored if s[2] != label and low * -ps <= 100 * -s[0] <= high * -ps)
            out += [(a, p, n + 1, i, -ps, -s) for n, (s, i, _) in enumerate(fit[:most])]
    return sorted(out)


def table(spark, rows):
    return spark.createDataFrame([(i, v, label, "s", "a", "r") for i, v, label in rows], SCHEMA)


def clustered(seed, count, width, labels=10, spread=0.6):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(labels, width))
    for i in range(count):
        label = int(draw.integers(labels))
        v = centres[label] + spread * draw.normal(size=width)
        yield i, [float(x) for x in v / np.linalg.norm(v)], label


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 40), st.integers(0, 10**6))
def test_bounds_hold_and_tighten(width, seed):
    draw = np.random.default_rng(seed)
    a, b = (draw.integers(-300, 300, (7, width)).astype(float) * draw.integers(0, 2, (7, 1)) for _ in range(2))
    exact = a @ b.T
    wide = None
    for segments in (1, 4, 16, 64):
        low, high = negatives.bounds(negatives.summary(a, segments), negatives.summary(b, segments))
        assert (low <= exact).all() and (exact <= high).all()
        if wide is not None and width % 64 == 0:
            assert (high - low <= wide + 1e-3).all()
        wide = high - low
    assert np.allclose(low, exact, atol=1e-2) if width <= 64 else True


def test_products_of_large_numbers_are_exact():
    a = np.array([[2**30 + 1, -(2**30), 3]])
    assert negatives.products(a, a).tolist() == [[(2**30 + 1) ** 2 + 2**60 + 9]]


@pytest.mark.parametrize("blocks", [(2048, 2048, 512), (3, 5, 2)])
def test_rows_equal_plain_python(spark, monkeypatch, blocks):
    for name, value in zip(("ANCHORS", "BLOCK_ROWS", "BLOCK_ANCHORS"), blocks, strict=True):
        monkeypatch.setattr(negatives, name, value)
    rows = list(clustered(1, 700, 24)) if blocks[0] > 3 else list(clustered(2, 620, 9, spread=1.0))
    found = sorted(map(tuple, negatives.mined(table(spark, rows)).collect()))
    assert found and found == plain(rows)


def test_odd_rows(spark):
    draw = random.Random(4)
    tied = [(i, [draw.choice([0.0, 0.5, 1.0]) for _ in range(4)], draw.randrange(3)) for i in range(1, 320) if i not in (100, 200)]
    rows = tied + [
        (0, [1.0, 0.5], 1), (100, None, 1), (200, [0.1, None, 0.2, 0.3], 1), (1000, [float("nan")] * 4, 1), (1100, [float("inf"), 0.0, 0.0, 0.0], 2),
        (None, [1.0, 1.0, 1.0, 1.0], 1), (1200, [0.0] * 4, 2), (1300, [1.0] * 4, None), (1400, [], 1), (1500, [0.5] * 6, 9), (1501, [1.0] * 4, 8),
        (1501, [1.0] * 4, 8), (1600, [-1.0, -0.5, -1.0, -0.5], 2), (1700, [3e7, 1.0, 2.0, 3.0], 1), (1701, [3e7, 1.0, 2.0, 0.0], 1), (1702, [2e7, 1.0, 2.0, 0.0], 3),
    ]
    found = sorted(map(tuple, negatives.mined(table(spark, rows)).collect()))
    assert found == plain(rows)
    assert {300, 1700} <= {r[0] for r in found} and negatives.mined(table(spark, [])).collect() == []


def test_other_anchors_and_limits(spark):
    rows = list(clustered(3, 300, 8))
    df = table(spark, [(i, v, label) for i, v, label in rows if i % 7])
    found = negatives.hard_negatives(df.drop("score"), F.col("vec_id") % 50 == 1, 2, 3, 10, 95)
    per = found.groupBy("anchor_id", "positive_id").agg(F.count("*").alias("n")).collect()
    assert {r.anchor_id % 50 for r in per} == {1} and max(r.n for r in per) <= 3
    assert found.where("100 * negative_score > 95 * positive_score OR 100 * negative_score < 10 * positive_score").count() == 0
