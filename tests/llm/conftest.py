import random

import pytest

SCHEMA = "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG, score STRING, digest STRING, toxic STRING, `group` STRING"


def prose(seed: int, count: int, vocabulary: int = 4000) -> str:
    draw = random.Random(seed)
    return " ".join(f"w{draw.randrange(vocabulary)}" for _ in range(count))


@pytest.fixture
def docs(spark):
    """Makes documents with columns whose names the operators use themselves."""

    def make(rows):
        return spark.createDataFrame(
            [(i, t, None, None, None, "s", "d", "t", "g") for i, t in rows], SCHEMA
        )

    return make


@pytest.fixture
def odd():
    """Nulls, empty, blank and very long texts, ties and repeated rows."""
    return [
        (1, None), (2, ""), (3, "   "), (4, "one two"), (5, "one two"), (5, "one two"), (None, "one two"),
        (None, None), (6, "long " * 60_000), (7, prose(1, 300)), (8, prose(1, 300)), (9, "é😀 " + prose(2, 50)),
    ]
