"""How much the queries of near_dedup ask of the driver: joins of each plan, and bytes of a task's result."""

import pytest
from pyspark.sql import functions as F

from filinglake.llm import common, near_dedup
from tests.llm.conftest import prose


@pytest.fixture
def joins(monkeypatch):
    """Joins of the plan of each landed table, by its label."""
    found, land = {}, common.land

    def counted(df, label):
        found[label] = max(found.get(label, 0), df._jdf.queryExecution().optimizedPlan().toString().count("Join "))
        return land(df, label)

    monkeypatch.setattr(common, "land", counted)
    return found


def test_rounds_of_components_repeat_no_join(spark, joins):
    edges = spark.range(40).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {r.root for r in common.components(edges, "plan").collect()} == {0}
    assert max(joins.values()) == 1


def test_plans_of_classes_are_small(docs, joins):
    rows = [(i, f"{prose(i // 4, 200)} tail{i}") for i in range(24)]
    found, _ = near_dedup.classes(docs(rows))
    assert {(r.doc_id, r.class_id) for r in found.collect()} == {(i, i // 4 * 4) for i in range(24)}
    assert max(joins.values()) <= 3


def test_sketch_comes_in_small_parts(docs, monkeypatch):
    texts = docs([(i, prose(i, 50)) for i in range(20)]).select("text")
    sizes, iterate = [], type(texts).toLocalIterator

    def measured(df, *args, **kwargs):
        by_task = df.groupBy(F.spark_partition_id()).agg(F.sum(F.length("part")).alias("n"))
        sizes.extend(r.n for r in by_task.collect())
        return iterate(df, *args, **kwargs)

    monkeypatch.setattr(type(texts), "toLocalIterator", measured)
    near_dedup.frequencies(texts)
    assert sum(sizes) == 8 << 20 and max(sizes) <= 2 << 20
