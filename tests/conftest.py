import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from filinglake.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, memory="4g", name="tests")
    yield session
    session.stop()


@pytest.fixture
def values(spark):
    """Evaluate a column expression over a list of texts."""

    def run(expression, texts):
        from pyspark.sql import functions as F

        rows = [(n, value) for n, value in enumerate(texts)]
        df = spark.createDataFrame(rows, "n INT, x STRING")
        found = df.select("n", expression(F.col("x")).alias("y")).orderBy("n").collect()
        return [row.y for row in found]

    return run
