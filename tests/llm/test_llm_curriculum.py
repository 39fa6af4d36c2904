"""Mixing: targets and words taken against plain Python, positions against numeric integration."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from filinglake.llm import curriculum
from tests.llm.conftest import SCHEMA

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shared(sizes):
    """Target of each source, by resharing the excess until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    full = set()
    while True:
        left = sum(sizes.values()) - sum(3 * sizes[s] for s in full)
        rest = [s for s in names if s not in full]
        target = {s: 3.0 * sizes[s] if s in full else weight[s] * left / sum(weight[r] for r in rest) for s in names}
        more = {s for s in rest if target[s] > 3 * sizes[s]}
        if not more:
            return target
        full |= more


def expected(rows):
    sizes = collections.Counter()
    for _, text, source in rows:
        sizes[source] += len(WORD.findall(text or ""))
    target, out = shared(sizes), []
    for source in sizes:
        own = sorted(
            (hashlib.md5(("" if i is None else str(i)).encode()).hexdigest(), len(WORD.findall(t or "")), -1 if i is None else i)
            for i, t, s in rows if s == source
        )
        line = [i for _ in range(3) for i, (_, size, _) in enumerate(own) for _ in range(size)]
        taken = collections.Counter(line[: int(target[source] + 0.5)])
        out += [(i, size, sizes[source], round(target[source], 6), taken[n]) for n, (_, size, i) in enumerate(own)]
    return sorted(out)


def made(spark, rows):
    return spark.createDataFrame([(i, t, None, s, None, "x", "d", "t", "g") for i, t, s in rows], SCHEMA)


def found(df):
    return sorted((-1 if r.doc_id is None else r.doc_id, r.size, r.source_size, round(r.target, 6), r.taken) for r in df.collect())


CASES = {
    "some": [(i, "w " * ((i * 7) % 23), f"s{(i * i) % 5}") for i in range(120)],
    "hot": [(i, "w " * 9, "a" if i % 3 else "é" if i % 2 else None) for i in range(200)],
    "small sources": [(i, "x y", "b") for i in range(50)] + [(100 + i, "x", s) for i, s in enumerate(["", "a", "c", "d", "😀", "�", "z"])],
    "odd": [(1, None, "a"), (1, "q", "a"), (1, "q", "a"), (None, "q r", None), (None, None, None), (4, "\x0b\x1c\x85 x", "b"), (5, "w " * 70_000, "c")],
    "no words": [(1, "", "a"), (2, None, None), (3, " \t", "b")],
    "empty": [],
}


@pytest.mark.parametrize("case", CASES)
def test_targets_and_words_taken(spark, case):
    rows = CASES[case]
    df = curriculum.mixture(made(spark, rows))
    assert df.columns[:5] == ["doc_id", "size", "source_size", "target", "taken"]
    assert found(df) == expected(rows)
    assert all(r[4] <= 3 * r[1] for r in found(df))


def test_random_sources_reshare_in_several_rounds(spark):
    draw = random.Random(2)
    rows = [(i, "w " * draw.randrange(1, 4) ** (3 if i % 9 == 0 else 1), f"s{min(draw.randrange(40), draw.randrange(40))}") for i in range(300)]
    rows += [(1000 + i, "w " * 40, "t") for i in range(40)]
    df = curriculum.mixture(made(spark, rows))
    assert found(df) == expected(rows) and found(df) == found(curriculum.mixture(made(spark, rows[::-1])))


@pytest.mark.parametrize("knots", [*curriculum.SCHEDULES, ((0.0, 0.0), (0.25, 0.0), (0.5, 2.0), (1.0, 0.0))])
def test_moments_invert_the_integral(spark, knots):
    times = np.linspace(0, 1, 200_001)
    rate = np.interp(times, *zip(*knots, strict=True))
    area = np.concatenate(([0], np.cumsum((rate[1:] + rate[:-1]) / 2)))
    shares = [i / 64 for i in range(64)]
    df = spark.createDataFrame([(s,) for s in shares], "s DOUBLE").select("s", curriculum.moment(F.col("s"), knots).alias("t"))
    for share, t in df.collect():
        assert abs(np.interp(t, times, area / area[-1]) - share) < 1e-6


def test_order_of_training_follows_the_schedules(spark):
    rows = [(i, "w " * 10, f"s{i % 3}") for i in range(600)]
    df = curriculum.training_order(made(spark, rows))
    assert df.columns == [*made(spark, rows).columns, "mix_position", "mix_words"]
    out = df.collect()
    assert [r.mix_position for r in out] == sorted(r.mix_position for r in out) and 0 <= out[0].mix_position and out[-1].mix_position <= 1
    per_doc = collections.Counter()
    for r in out:
        per_doc[r.doc_id] += r.mix_words
    assert {i: n for i, *_, n in expected(rows) if n} == dict(per_doc)
    # The share of a source in a span of time is that of its schedule's area there.
    for source, knots in zip(("s0", "s1", "s2"), curriculum.SCHEDULES, strict=True):
        own = [r for r in out if r.source == source]
        early = sum(r.mix_words for r in own if r.mix_position < 0.5) / sum(r.mix_words for r in own)
        times = np.linspace(0, 1, 10_001)
        rate = np.interp(times, *zip(*knots, strict=True))
        assert abs(early - rate[times < 0.5].sum() / rate.sum()) < 0.02
