import collections
import random

import numpy as np
import pyarrow as pa
from hypothesis import given
from hypothesis import strategies as st

from filinglake.llm import decontaminate
from tests.llm.conftest import prose

ITEMS = "item_id LONG, text STRING, score STRING"


def grams(text):
    words = (text or "").lower().split()
    return [tuple(words[i : i + 5]) for i in range(len(words) - 4)] if len(words) >= 5 else [tuple(words)] if words else []


def brute(rows, items):
    """Every window of an item's size, compared with it as a weighted multiset."""
    found = set()
    for doc, text in rows:
        own = grams(text)
        for item, passage in items:
            want = collections.Counter(grams(passage))
            size = min(sum(want.values()), len(own))
            for at in range(len(own) - size + 1) if size else ():
                have = collections.Counter(own[at : at + size])
                shared = sum(len(set(g)) * min(have[g], want[g]) for g in have)
                whole = sum(len(set(g)) * max(have[g], want[g]) for g in have | want)
                if shared >= 0.8 * whole:
                    found.add((doc, item))
    return found


def case():
    draw = random.Random(4)
    items = [(i, prose(900 + i, 15 + 4 * i)) for i in range(11)] + [(50, "tiny item"), (51, "a a a a a a a a")]
    rows = []
    for i in range(60):
        words = prose(i, draw.randrange(20, 300)).split()
        if i % 2:
            passage = draw.choice(items)[1].split()
            if i % 4 == 3:
                passage[draw.randrange(len(passage))] = "changed"
            at = draw.randrange(len(words))
            words[at:at] = passage
        rows.append((i, " ".join(words)))
    rows += [(100, "tiny item"), (101, "a a a a a a a a a a"), (102, "Tiny  ITEM"), (103, items[0][1] + " " + items[1][1])]
    return rows, items


def test_finds_what_all_windows_find(spark, docs, monkeypatch):
    rows, items = case()
    table = spark.createDataFrame([(i, t, "s") for i, t in items], ITEMS)
    want = brute(rows, items)
    assert len(want) > 20
    for size in (512, 5):  # one group of items, several groups
        monkeypatch.setattr(decontaminate, "GROUP_ITEMS", size)
        found = decontaminate.leaks(docs(rows), table).collect()
        assert {(r.doc_id, r.item_id) for r in found} == want
        assert all(0.8 <= r.similarity <= 1 for r in found)
        clean = decontaminate.without_leaks(docs(rows), table)
        assert {r.doc_id for r in clean.collect()} == {i for i, _ in rows} - {i for i, _ in want}
        assert clean.columns == docs(rows).columns


@given(st.integers(0, 2**64 - 1), st.lists(st.integers(0, 63), max_size=decontaminate.RADIUS, unique=True))
def test_index_misses_nothing_within_the_radius(value, flipped):
    other = value
    for bit in flipped:
        other ^= 1 << bit
    mask = (1 << decontaminate._BITS) - 1
    parts = [((value >> b * decontaminate._BITS) & mask, (other >> b * decontaminate._BITS) & mask) for b in range(decontaminate.BLOCKS)]
    assert any((a ^ b).bit_count() <= decontaminate.RADIUS // decontaminate.BLOCKS for a, b in parts)


def test_tables_list_all_near_values():
    group = decontaminate.groups_of([(1, prose(1, 30))])[0]
    part = int(group.prints[0]) & 0xFFFF
    near = np.flatnonzero(group.tables[0])
    assert len(near) == sum(1 for v in range(1 << 16) if (v ^ part).bit_count() <= decontaminate.RADIUS // decontaminate.BLOCKS)


def test_odd_rows(spark, docs, odd):
    items = spark.createDataFrame([(1, None, "s"), (2, "", "s"), (None, "one two", "s"), (3, "one two", "s"), (3, "one two", "s")], ITEMS)
    found = decontaminate.leaks(docs(odd), items)
    assert sorted((r.doc_id or 0, r.item_id) for r in found.collect()) == [(0, 3), (4, 3), (5, 3), (5, 3)]
    assert decontaminate.without_leaks(docs(odd), items).count() == len(odd) - 4


def test_empty(spark, docs, odd):
    none = spark.createDataFrame([], ITEMS)
    assert decontaminate.leaks(docs(odd), none).count() == 0
    assert decontaminate.without_leaks(docs(odd), none).count() == len(odd)
    assert decontaminate.leaks(docs([]), spark.createDataFrame([(1, "a b", "s")], ITEMS)).count() == 0


def test_similarity_of_multisets():
    a = np.array([1, 1, 2], np.uint64)
    b = np.array([1, 2, 3], np.uint64)
    assert decontaminate.similarity(a, np.ones(3), b, np.ones(3)) == 0.5
    assert decontaminate.matches(pa.array([None], pa.string()), decontaminate.Index.of([]), 0.8) == []
