import collections
import itertools
import random

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from filinglake.llm import common, near_dedup
from tests.llm.conftest import prose


def edited(text, seed, every):
    words = text.split()
    for i in range(seed % every, len(words), every):
        words[i] = f"x{seed}y{i}"
    return " ".join(words)


def shingle_sets(texts):
    """Five-word shingles with their counts, in plain Python."""
    out = []
    for text in texts:
        words = (text or "").lower().split()
        grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)] if len(words) >= 5 else [tuple(words)] if words else []
        out.append(collections.Counter(grams))
    return out


def test_shingles_count_as_plain_python_does():
    texts = [None, "", "  a ", "a b c d", "A b c d e", "a b c d e f a b c d e", prose(3, 200)]
    hashes, offsets = common.shingles(pa.array(texts, pa.string()))
    for i, want in enumerate(shingle_sets(texts)):
        own = hashes[offsets[i] : offsets[i + 1]]
        assert sorted(collections.Counter(own.tolist()).values()) == sorted(want.values())
    assert hashes[offsets[4]] == hashes[offsets[5]]  # case does not count, place does not count


def test_samples_agree_as_often_as_sets_are_alike():
    draw = np.random.default_rng(5)
    hashes = np.sort(draw.choice(1 << 40, 900, replace=False).astype(np.uint64))
    weights = draw.uniform(0.5, 8, 900)
    other = np.where(draw.random(900) < 0.3, weights * 2, weights)
    a = near_dedup.samples(hashes, weights, np.array([0, 900]), 1200)[:, 0]
    b = near_dedup.samples(hashes[:700], other[:700], np.array([0, 700]), 1200)[:, 0]
    alike = np.minimum(weights[:700], other[:700]).sum() / (np.maximum(weights[:700], other[:700]).sum() + weights[700:].sum())
    assert abs((a == b).mean() - alike) < 0.05


def test_classes_are_those_of_all_pairs(spark, docs):
    rows = [(i, prose(i, 150)) for i in range(20)]
    rows += [(100 + i, edited(rows[i % 5][1], i, 70 if i % 2 else 40)) for i in range(30)]
    rows += [(200 + i, rows[i % 3][1]) for i in range(6)]
    frame = docs(rows)
    texts = [t for _, t in rows]
    known = near_dedup.frequencies(frame.select("text"))
    parent = {i: i for i, _ in rows}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for (i, a), (j, b) in itertools.combinations(rows, 2):
        if near_dedup.similarities(pa.array([a]), pa.array([b]), known)[0] >= 0.8:
            low, high = sorted((root(i), root(j)))
            parent[high] = low
    found = {r.doc_id: r.class_id for r in near_dedup.near_duplicates(frame).collect()}
    assert found == {i: root(i) for i, _ in rows}
    assert 1 < len(set(found.values())) < len(set(texts))


def test_frequencies_count_texts(spark, docs):
    frame = docs([(i, f"a b c d e {'x y z u v' if i < 5 else prose(i, 9)}") for i in range(40)])
    known = near_dedup.frequencies(frame.select("text"))
    hashes, _, _ = near_dedup.common.weighted_set(*common.shingles(pa.array(["a b c d e", "x y z u v"])))
    assert known.texts == 40
    hashes, _ = common.shingles(pa.array(["a b c d e"]))
    assert np.isclose(known.weights(hashes >> np.uint64(16), np.array([1]))[0], np.log1p(1), atol=0.01)


def test_large_group_of_copies_in_parts(spark, docs, monkeypatch):
    monkeypatch.setattr(near_dedup, "PART", 8)
    base = prose(1, 400)
    rows = [(i, edited(base, i, 399)) for i in range(60)] + [(1000 + i, prose(50 + i, 100)) for i in range(10)]
    found = {r.doc_id: r.class_id for r in near_dedup.near_duplicates(docs(rows)).collect()}
    assert {found[i] for i in range(60)} == {0}
    assert all(found[1000 + i] == 1000 + i for i in range(10))


def test_odd_rows(spark, docs, odd):
    found = near_dedup.near_duplicates(docs(odd))
    assert found.count() == len(odd)
    classes = {(r.doc_id, r.class_id) for r in found.where("doc_id IS NOT NULL").collect()}
    assert {(1, 1), (2, 1), (3, 3), (4, 4), (5, 4), (6, 6), (7, 7), (8, 7), (9, 9)} == classes
    kept = near_dedup.one_of_each(docs(odd))
    assert kept.columns == docs(odd).columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 4, 6, 7, 9]


def test_rows_without_ids_and_repeated_rows(spark, docs):
    kept = near_dedup.one_of_each(docs([(None, "a b c"), (None, "a b c"), (None, "d"), (3, "q r"), (3, "q r")])).collect()
    assert sorted((r.doc_id or 0, r.text) for r in kept) == [(0, "a b c"), (0, "d"), (3, "q r")]


def test_empty(spark, docs):
    assert near_dedup.near_duplicates(docs([])).count() == 0
    assert near_dedup.one_of_each(docs([])).count() == 0


def test_components(spark):
    edges = [(1, 2), (2, 3), (3, 4), (10, 11), (11, 12), (12, 10), (7, 7), (20, 5), *((100, 200 + i) for i in range(50))]
    found = {r.node: r.root for r in common.components(spark.createDataFrame(edges, "a LONG, b LONG"), "test").collect()}
    assert found == {1: 1, 2: 1, 3: 1, 4: 1, 10: 10, 11: 10, 12: 10, 20: 5, 5: 5, 100: 100, **{200 + i: 100 for i in range(50)}}
    path = spark.range(300).select((F.col("id") * 7 % 301).alias("a"), ((F.col("id") + 1) * 7 % 301).alias("b"))
    assert {r.root for r in common.components(path, "path").collect()} == {0}


def test_ranks_are_gapless(spark):
    frame = spark.range(1000).select((F.col("id") % 3).alias("g"), (F.col("id") % 50).alias("v"))
    for buckets in (1, 7):
        ranks = common.ranked(frame, ["g"], ["v"], "r", buckets).groupBy("g").agg(F.count("r"), F.min("r"), F.max("r"), F.countDistinct("r")).collect()
        assert all(r[1] == r[3 + 1] and r[2] == 0 and r[3] == r[1] - 1 for r in ranks)


def families(seed, texts, length, edits, twins):
    """Versions of one text with `edits` own words each, and twins of every tenth with some more."""
    base, rows = prose(seed, length).split(), []
    for i in range(texts):
        own = random.Random(seed * 1000 + i).sample(range(length), edits)
        rows.append((i, " ".join(f"x{i}z{k}" if k in own else w for k, w in enumerate(base))))
    for i in range(0, texts, 10):
        own = random.Random(seed * 77 + i).sample(range(length), twins)
        rows.append((1000 + i, " ".join(f"q{i}z{k}" if k in own else w for k, w in enumerate(rows[i][1].split()))))
    return rows


def all_pairs(rows, known):
    """Class of each row by the similarities of all pairs, and how many pairs pass."""
    pairs = list(itertools.combinations(range(len(rows)), 2))
    sides = [pa.array([rows[p[side]][1] for p in pairs]) for side in (0, 1)]
    alike = np.concatenate([near_dedup.similarities(*(s.slice(at, 256) for s in sides), known) for at in range(0, len(pairs), 256)])
    root = list(range(len(rows)))
    for (i, j), s in zip(pairs, alike, strict=True):
        if s >= 0.8 and root[i] != root[j]:
            low, high = sorted((root[i], root[j]))
            root = [low if r == high else r for r in root]
    return {rows[i][0]: rows[r][0] for i, r in enumerate(root)}, int((alike >= 0.8).sum())


def test_large_group_of_unlike_texts_ends(spark, docs, monkeypatch):
    monkeypatch.setattr(near_dedup, "PART", 3)
    land, written = common.land, []

    def counted(df, label):
        written.append(label)
        assert len(written) <= 20, "candidates do not end"
        return land(df, label)

    monkeypatch.setattr(common, "land", counted)
    rows = families(1, 60, 300, 2, 2)
    want, _ = all_pairs(rows, near_dedup.frequencies(docs(rows).select("text")))
    assert {r.doc_id: r.class_id for r in near_dedup.near_duplicates(docs(rows)).collect()} == want


def test_no_pair_is_lost_among_many_just_below(spark, docs):
    rows = families(3, 100, 500, 2, 4)
    want, passing = all_pairs(rows, near_dedup.frequencies(docs(rows).select("text")))
    assert passing > 5
    assert {r.doc_id: r.class_id for r in near_dedup.near_duplicates(docs(rows)).collect()} == want


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6))
def test_products_of_matrices_equal_similarities(seed):
    draw = random.Random(seed)
    texts = [" ".join(f"w{draw.randrange(3)}" for _ in range(draw.randrange(0, 40))) for _ in range(9)] + ["a " * 70_000, "a " * 90_000 + "b"]
    known = near_dedup.Frequencies(9, np.maximum(np.random.default_rng(seed).integers(0, 3, (near_dedup.DEPTH, near_dedup.CELLS)), 1))
    rows = []
    for text in texts:
        hashes, times, _ = common.weighted_set(*common.shingles(pa.array([text])))
        rows.append((hashes.tobytes(), times.astype(np.int32).tobytes()))
    left, right = near_dedup.Sets.of(rows[:6], known), near_dedup.Sets.of(rows[3:], known)
    for columns in (3, 4096):
        near_dedup.COLUMNS, before = columns, near_dedup.COLUMNS
        shared = near_dedup.overlaps(left, right, known)
        near_dedup.COLUMNS = before
        for i, a in enumerate(texts[:6]):
            for j, b in enumerate(texts[3:]):
                if a and b:
                    alike = shared[i, j] / (left.total[i] + right.total[j] - shared[i, j])
                    assert np.isclose(alike, near_dedup.similarities(pa.array([a]), pa.array([b]), known)[0])


def test_cells_of_any_size_give_the_same_classes(spark, docs, monkeypatch):
    rows = families(5, 80, 300, 2, 3) + [(5000 + i, families(6, 1, 300, 0, 0)[0][1] + f" y{i}") for i in range(30)]
    want, passing = all_pairs(rows, near_dedup.frequencies(docs(rows).select("text")))
    monkeypatch.setattr(near_dedup, "CELL_TEXTS", 7)
    monkeypatch.setattr(near_dedup, "TILE", 3)
    monkeypatch.setattr(near_dedup, "PART", 5)
    assert passing > 5
    assert {r.doc_id: r.class_id for r in near_dedup.near_duplicates(docs(rows)).collect()} == want


def test_clashing_columns_stay(docs):
    frame = docs([(1, "a b"), (2, "a b"), (3, None)]).withColumnsRenamed({"score": "near_id", "digest": "near_digest", "toxic": "Near_Turn"})
    kept = near_dedup.one_of_each(frame)
    assert kept.columns == frame.columns
    assert sorted((r.doc_id, r.near_id, r.near_digest, r["Near_Turn"]) for r in kept.collect()) == [(1, "s", "d", "t"), (3, "s", "d", "t")]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="aB \t\n\x0b\x0c\r\x1c\x85\xa0 　é", max_size=8), min_size=1, max_size=8), st.integers(0, 7))
def test_words_do_not_depend_on_neighbours(texts, first):
    flat, offsets = common.words(pa.array(texts).slice(min(first, len(texts) - 1)))
    for i, text in enumerate(texts[min(first, len(texts) - 1) :]):
        alone, _ = common.words(pa.array([text]))
        assert flat.slice(offsets[i], offsets[i + 1] - offsets[i]).to_pylist() == alone.to_pylist() == text.lower().split()
