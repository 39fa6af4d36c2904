"""Periodic runs: the grammar's extensions and the runs against their definitions."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from filinglake.llm import periodic


def runs_of(text):
    """Every run (start, length, period) of a list of words, by definition."""
    n, found = len(text), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if text[i] != text[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and text[i] == text[i + q]:
                i += 1
            if i + q - start >= max(12, 2 * q):
                found.setdefault((start, i + q - start), q)
    return sorted((s, length, q) for (s, length), q in found.items())


def expected(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = runs_of(words)
    kept = [w for i, w in enumerate(words) if not any(s + q <= i < s + length for s, length, q in found)]
    best = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else None
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    return (
        doc_id, len(found), *(best or (None, None, None)), 1000 * best[1] // best[2] if best else None,
        hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(" ".join(kept).encode()).hexdigest(),
    )


def repeating(seed, size, letters):
    draw = random.Random(seed)
    words = []
    while len(words) < size:
        part = [f"w{draw.randrange(letters)}" for _ in range(draw.randrange(1, 9))]
        words += (part * draw.randrange(1, 7)) + [f"w{draw.randrange(letters)}"] * draw.randrange(0, 4)
    return " ".join(words[:size])


SPACES = "a\x1cb a\x1cb a\x1cb x  \t\n\v\f\r y y \x85 "


def test_words_are_cut_at_ascii_white_space():
    texts = [None, "", "   ", " a  b\t", SPACES, "\n\n", "x", " "]
    for shown in (texts, texts[::-1], texts * 3):
        flat, offsets = periodic.words(pa.array(shown))
        found = [flat.slice(offsets[i], offsets[i + 1] - offsets[i]).to_pylist() for i in range(len(shown))]
        assert found == [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in shown]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=60), max_size=5), st.integers(0, 10**6))
def test_runs_are_those_of_the_definition(texts, seed):
    texts = [*texts, [int(w[1:]) for w in repeating(seed, 90, 3).split()]]
    offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    flat = np.array([w for t in texts for w in t], np.int64)
    found = list(zip(*(x.tolist() for x in periodic.runs(flat, offsets)), strict=True))
    assert found == [(k, *r) for k, t in enumerate(texts) for r in runs_of(t)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 1), min_size=2, max_size=80), st.integers(0, 10**6))
def test_extensions_equal_plain_comparison(middle, seed):
    text = [7, *middle, *(middle * 2)[: seed % 40], 8]
    levels = periodic.grammar(np.array(text))
    pairs = [(i, j) for i in range(1, len(text) - 1) for j in range(i + 1, len(text) - 1)]
    left, right = np.array(pairs).reshape(-1, 2).T
    after = [next(k for k in range(len(text)) if text[i + k] != text[j + k]) for i, j in pairs]
    before = [next(k for k in range(len(text)) if text[i - 1 - k] != text[j - 1 - k]) for i, j in pairs]
    assert periodic.extension(levels, left, right, True).tolist() == after
    assert periodic.extension(levels, left, right, False).tolist() == before


def test_digests_equal_plain_python(docs, odd):
    rows = [r for r in odd if r[0] != 6] + [(100 + i, repeating(i, 30 + 7 * i, 4 + i)) for i in range(60)]
    rows += [(500 + i, SPACES * (i + 1)) for i in range(12)] + [(None, "a b " * 20), (700, "a " * 11), (701, "a " * 12), (702, "é😀 x " * 9)]
    found = sorted(map(tuple, periodic.run_digests(docs(rows)).collect()), key=str)
    assert found == sorted((expected(*r) for r in rows), key=str)


def test_an_empty_table_and_long_texts(docs):
    assert periodic.run_digests(docs([])).collect() == []
    draw = random.Random(3)
    block = [f"v{draw.randrange(10**6)}" for _ in range(30_000)]
    texts = ["long " * 200_000, " ".join(block * 3 + block[:100]), " ".join(f"u{draw.randrange(9)}" for _ in range(100_000))]
    found = {r.doc_id: r for r in periodic.periodic_runs(docs([(1, texts[0]), (2, texts[1]), (3, texts[2])])).collect()}
    assert [tuple(x) for x in found[1].runs] == [(0, 200_000, 1)] and found[1].collapsed == "long"
    assert [tuple(x) for x in found[2].runs] == [(0, 90_100, 30_000)] and found[2].collapsed == " ".join(block)
    assert len(found[3].collapsed) <= len(texts[2])


@pytest.mark.parametrize("size", [1 << 4, 1 << 18])
def test_slices_of_the_grids_do_not_matter(monkeypatch, size):
    monkeypatch.setattr(periodic, "PLACES", size)
    text = [int(w[1:]) for w in repeating(5, 400, 3).split()]
    found = list(zip(*(x.tolist() for x in periodic.runs(np.array(text), np.array([0, 400]))), strict=True))
    assert found == [(0, *r) for r in runs_of(text)]
