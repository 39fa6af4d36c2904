"""What round 3 found: work that grew faster than the input."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filinglake import schemas, session
from filinglake.catalog import views
from filinglake.functions import dates, text
from filinglake.operators import keyed
from filinglake.operators.checks import BrokenRows
from filinglake.plans import file_merge
from filinglake.sources import tsv


def text_lines(spark, *texts, key="f"):
    return spark.createDataFrame([(key, n, text) for n, text in enumerate(texts)], "archive_key STRING, ord LONG, line STRING")


@pytest.mark.parametrize("scan", [tsv.records, tsv.strict_records])
def test_lines_of_one_file_do_not_meet_in_one_task(spark, monkeypatch, scan):
    lines = text_lines(spark, "A\tB", *[f"{n}\tx" for n in range(50)])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = scan(lines, ["A", "B"])
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        monkeypatch.setattr(tsv, "BROADCAST_FILES", 0)
        assert sorted(scan(lines, ["A", "B"]).collect()) == sorted(rows.collect()) and rows.count() == 50
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_pieces_to_parse_grow_with_the_table(spark, monkeypatch, tmp_path):
    spark.range(20_000).repartition(1).write.parquet(f"{tmp_path}/t")
    table = spark.read.parquet(f"{tmp_path}/t")
    cores = spark.sparkContext.defaultParallelism
    assert views.spread(table).rdd.getNumPartitions() == cores
    monkeypatch.setattr(views, "PIECE", 2_000)
    many = views.spread(table)
    assert many.rdd.getNumPartitions() > 4 * cores and many.distinct().count() == 20_000


def test_cheaper_cells_read_the_same(values):
    plain = ["31-OCT-2025", "1-feb-2024", "30-Feb-2024", "29-FEB-2023", "01-anf-2025", "1-Jan-0000", "", None, "01-OCT-25"]
    old = lambda c: F.when(
        c.rlike(dates._SEC_SHAPE), F.try_to_date(F.initcap(F.lower(F.replace(c, F.lit("-"), F.lit(" ")))), "d MMM yyyy")
    ).cast("string")
    assert values(lambda c: dates.sec_date(c).cast("string"), plain) == values(old, plain)
    cells = [None, "", " ", " ", " a ", " a ", "﻿b\n", "é", "TRUE", "fALSE", "1", "0", "2"]
    assert values(text.nested_text, cells) == values(text.text, cells)
    assert values(text.flag, cells) == [None] * 8 + [True, False, True, False, None]


def test_splits_are_lowered_and_never_raised(spark):
    name = "spark.sql.files.maxPartitionBytes"
    try:
        for given, kept in (("128m", str(session.SPLIT)), ("1m", "1m")):
            spark.conf.set(name, given)
            assert session.prepare(spark).conf.get(name) == kept
    finally:
        spark.conf.unset(name)


def test_last_rows_carry_their_order_once(spark):
    rows = spark.createDataFrame([("a", 1, "x", None), ("a", 3, "y", 1.0), ("a", 2, "z", 2.0), ("b", None, "n", 3.0)], "k STRING, ord INT, v STRING, w DOUBLE")
    last = keyed.last_per_key(rows, ["k"], "ord", seen=F.count("v"))
    assert last.columns == ["k", "ord", "v", "w", "seen"]
    assert {tuple(r) for r in last.collect()} == {("a", 3, "y", 1.0, 3), ("b", None, None, None, 1)}
    assert [tuple(r) for r in keyed.first_per_key(rows.where("k = 'a'"), ["k"], "ord").collect()] == [("a", 1, "x", None)]
    plan = last._jdf.queryExecution().optimizedPlan().toString()
    assert "max_by" not in plan
    mapped = rows.withColumn("m", F.create_map("k", "v")).where("k = 'a'")
    assert keyed.last_per_key(mapped, ["k"], "ord").first().m == {"a": "y"}


def test_a_merge_lands_each_table_once_and_names_foreign_sources(spark, tmp_path, monkeypatch):
    names = []
    landed = file_merge._landed
    monkeypatch.setattr(file_merge, "_landed", lambda s, rows, label, paths: names.append(label) or landed(s, rows, label, paths))
    known = {"rawArchiveKey": "k", "availabilitySource": schemas.SOURCE_13F_DATASET, "accession": "a"}

    def table(name, *cells):
        shape = T.StructType([*schemas.TABLES[name].fields, T.StructField("ord", T.LongType())])
        full = [{**known, **c, "ord": n} for n, c in enumerate(cells)]
        rows = spark.createDataFrame([tuple(c.get(f.name) for f in shape.fields) for c in full], T.StructType([T.StructField(f.name, f.dataType) for f in shape.fields]))
        return rows.withColumn("availableAt", F.lit("2026-05-01").cast("timestamp"))

    filings = table("institutional_filings", {})
    good = table("institutional_holdings", {"infoTableSk": "1", "value": 1.0}, {"infoTableSk": "1", "value": 2.0})
    merged = file_merge.merge_institutional(spark, str(tmp_path), filings, good)
    assert [r.value for r in merged.rows("institutional_holdings").collect()] == [2.0]
    assert names.count("institutional_filings") == names.count("institutional_holdings") == 1
    bad = table("institutional_holdings", {"infoTableSk": "1", "availabilitySource": "other"}, {"infoTableSk": "1"})
    with pytest.raises(BrokenRows, match="unknown source other x1"):
        file_merge.merge_institutional(spark, str(tmp_path), filings, bad)
