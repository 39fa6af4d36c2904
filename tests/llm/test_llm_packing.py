import collections
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from filinglake.llm import packing
from tests.llm.conftest import prose

P = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def plain():
    found = tokenizers.Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    found.encode_special_tokens = True
    return lambda text: found.encode(text, add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=200))
def test_ids_are_those_of_the_library_tokenizers(plain, text):
    assert packing.encoder().encode_ordinary(text) == plain(text)


def test_ids_of_awkward_texts(plain):
    for text in ["<|endoftext|>", "a" * 3000, " \n\t  x  ", "\r\n", "é😀‍", "１２３ abc's 'll", "\x00\x01"]:
        assert packing.encoder().encode_ordinary(text) == plain(text)


def test_every_id_lies_in_one_piece(docs, odd, plain):
    rows = odd + [(100 + i, prose(i, random.Random(i).randrange(1, 1500))) for i in range(60)]
    found = packing.pack(docs(rows)).collect()
    want = collections.Counter()
    for doc, text in rows:
        ids = np.array([*plain(text or ""), 1], "<u4")
        for start in range(0, len(ids), 2048):
            own = ids[start : start + 2048]
            want[doc, start, len(own), zlib.crc32(own.tobytes()), len(ids)] += 1
    assert collections.Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in found) == want
    by_sequence = collections.defaultdict(list)
    for r in found:
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for own in by_sequence.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(by_sequence) <= 1.06 * sum(r.length for r in found) / 2048 + 2


def test_empty(docs):
    assert packing.pack(docs([])).count() == 0


@settings(max_examples=25, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 400), max_size=12))
def test_patterns_cover_the_histogram(histogram):
    covered = collections.Counter()
    plan = packing.patterns(histogram, 64)
    for pattern, times in plan:
        assert sum(length * n for length, n in pattern.items()) <= 64
        for length, n in pattern.items():
            covered[length] += n * times
    assert covered == histogram


def test_patterns_are_near_the_bound():
    draw = np.random.default_rng(2)
    lengths, counts = np.unique(np.minimum(1 + draw.lognormal(3.5, 0.9, 20_000).astype(int), 256), return_counts=True)
    plan = packing.patterns(dict(zip(lengths.tolist(), counts.tolist(), strict=True)), 256)
    assert sum(times for _, times in plan) <= 1.01 * (lengths * counts).sum() / 256 + 5


def test_knapsack_against_all_multisets():
    values = np.zeros(13)
    values[[3, 5, 7]] = [1.0, 1.9, 2.9]
    best, pattern = packing.knapsack(values, 12)
    every = [a * 1.0 + b * 1.9 + c * 2.9 for a in range(5) for b in range(3) for c in range(2) if 3 * a + 5 * b + 7 * c <= 12]
    assert best == pytest.approx(max(every)) and sum(length * n for length, n in pattern.items()) <= 12


def test_added_token_inside_texts(docs):
    library = tokenizers.Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    end = "<|endoftext|>"
    texts = [end, f"a {end} b", f"x{end}{end}  y", f"a  {end}\n\n b's {end[:-1]}", f"<|{end}|>", "plain  text ", f"é😀{end}1"]
    found = {r.doc_id: r for r in packing.pack(docs(list(enumerate(texts)))).collect()}
    for i, text in enumerate(texts):
        ids = np.array([*library.encode(text, add_special_tokens=False).ids, 1], "<u4")
        assert (found[i].doc_tokens, found[i].ids_crc32) == (len(ids), zlib.crc32(ids.tobytes()))
