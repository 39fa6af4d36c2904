"""The versioned lake: merges by file, atomic versions of both tables, views over named files."""

import datetime as dt
import glob

import pytest
from pyspark.sql import functions as F
from rows import table

from filinglake import schemas
from filinglake.operators.checks import BrokenRows
from filinglake.plans import file_merge, pipelines
from filinglake.sinks import lake, versions

DATASET, DAILY = schemas.SOURCE_345_DATASET, schemas.SOURCE_ACCEPTANCE


def at(text):
    return dt.datetime.fromisoformat(text)


def insider(spark, *parts, when="2026-09-11T20:00:00"):
    filings = [{"accession": a, "availabilitySource": s, "availableAt": at(when)} for a, s, _ in parts]
    legs = [{"accession": a, "availabilitySource": s, "rowSk": k, "availableAt": at(when)} for a, s, ks in parts for k in ks]
    return tuple(table(spark, n, r).drop("window", "ord") for n, r in (("insider_filings", filings), ("insider_transactions", legs)))


def legs(one):
    return sorted((r.accession, r.rowSk, r.availabilitySource) for r in one.rows("insider_transactions").collect())


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "lake")


def test_insider_merge_equals_that_of_whole_years(spark, root, tmp_path):
    reads = [
        insider(spark, ("A", DATASET, ["901"]), ("B", DAILY, ["1"]), ("C", DATASET, ["902"])),
        insider(spark, ("A", DAILY, ["1"]), ("B", DAILY, ["1", "2"]), ("D", DATASET, ["7"]), when="2027-01-02T00:00:00"),
        insider(spark, ("A", DATASET, ["5"]), ("D", DATASET, ["8", "8"])),
    ]
    for filings, transactions in reads:
        found = file_merge.merge_insider(spark, root, filings, transactions)
        pipelines.refresh_insider(spark, str(tmp_path / "plain"), filings, transactions)
        for name in ("insider_filings", "insider_transactions"):
            columns = schemas.TABLES[name].fieldNames()
            want = lake.read_table(spark, name, str(tmp_path / "plain")).select(*columns)
            assert found.rows(name).select(*columns).exceptAll(want).count() == 0 == want.exceptAll(found.rows(name).select(*columns)).count()
    assert found.version == 3 and legs(found)[-1] == ("D", "8", DATASET)
    assert {r.availableYear for r in found.rows("insider_transactions").collect()} == {2026, 2027}


def test_old_versions_stay_whole_and_refused_merges_leave_none(spark, root):
    one = file_merge.merge_insider(spark, root, *insider(spark, ("A", DATASET, ["1"])))
    two = file_merge.merge_insider(spark, root, *insider(spark, ("A", DAILY, ["2"]), ("B", DAILY, ["3"])))
    assert legs(one) == [("A", "1", DATASET)] and legs(two) == [("A", "2", DAILY), ("B", "3", DAILY)]
    with pytest.raises(BrokenRows, match="unknown source"):
        file_merge.merge_insider(spark, root, *insider(spark, ("B", "elsewhere", ["9"])))
    assert versions.snapshot(spark, root).version == 2 and legs(versions.snapshot(spark, root, 1)) == legs(one)
    with pytest.raises(FileNotFoundError):
        versions.snapshot(spark, root, 9)


def test_a_writer_that_stops_leaves_no_row(spark, root, monkeypatch):
    file_merge.merge_insider(spark, root, *insider(spark, ("A", DATASET, ["1"])))
    add, calls = versions.add_rows, []

    def failing(*args):
        calls.append(args[2])
        if len(calls) == 2:
            raise OSError("stopped between the tables")
        return add(*args)

    monkeypatch.setattr(versions, "add_rows", failing)
    with pytest.raises(OSError):
        file_merge.merge_insider(spark, root, *insider(spark, ("A", DAILY, ["2"])))
    monkeypatch.setattr(versions, "add_rows", add)
    now = versions.snapshot(spark, root)
    assert now.version == 1 and legs(now) == [("A", "1", DATASET)] and now.rows("insider_filings").count() == 1
    assert versions.expire(spark, root, older_than_hours=-1) == 1
    assert legs(versions.snapshot(spark, root)) == [("A", "1", DATASET)]


def test_the_second_of_two_writers_starts_again(spark, root, monkeypatch):
    file_merge.merge_insider(spark, root, *insider(spark, ("A", DATASET, ["1"])))
    base = versions.snapshot(spark, root)
    rows = [versions.add_rows(spark, df, n, root) for n, df in zip(("insider_filings", "insider_transactions"), insider(spark, ("Z", DAILY, ["9"])), strict=True)]
    commit, raced = versions.commit, []

    def late(seen, *args):
        if not raced:
            raced.append(commit(base, rows))
        return commit(seen, *args)

    monkeypatch.setattr(versions, "commit", late)
    done = file_merge.merge_insider(spark, root, *insider(spark, ("A", DAILY, ["2"])))
    assert done.version == 3 and legs(done) == [("A", "2", DAILY), ("Z", "9", DAILY)]
    with pytest.raises(versions.Conflict):
        commit(base, rows)


def holdings(spark, *cells, when="2026-05-01T00:00:00"):
    filings = [{"accession": a, "availableAt": at(when)} for a in sorted({a for a, *_ in cells})]
    rows = [{"accession": a, "infoTableSk": k, "value": v, "cusip": c, "availableAt": at(when)} for a, k, v, c in cells]
    return tuple(table(spark, n, r).drop("window") for n, r in (("institutional_filings", filings), ("institutional_holdings", rows)))


def test_one_accession_rewrites_only_its_files(spark, root):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "20")
    try:
        cells = [(f"F{i:04d}", "1", float(i), f"{i % 20:09d}") for i in range(400)]
        one = file_merge.merge_institutional(spark, root, *holdings(spark, *cells))
        before = set(one.paths("institutional_holdings"))
        assert len(before) >= 18
        two = file_merge.merge_institutional(spark, root, *holdings(spark, ("F0007", "1", -1.0, "x"), ("F0007", "1", -2.0, "y"), ("F0007", "2", 3.0, "z")))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    after = set(two.paths("institutional_holdings"))
    assert len(before - after) <= 2
    values = {(r.accession, r.infoTableSk): r.value for r in two.rows("institutional_holdings").collect()}
    assert len(values) == 401 and values["F0007", "1"] == -2.0 and values["F0008", "1"] == 8.0
    assert one.rows("institutional_holdings").count() == 400 and two.rows("institutional_filings").count() == 400
    with pytest.raises(BrokenRows, match="unknown source"):
        bad = holdings(spark, ("G", "1", 1.0, "c"))
        file_merge.merge_institutional(spark, root, bad[0], bad[1].withColumn("availabilitySource", F.lit("daily")))
    assert versions.snapshot(spark, root).version == 2


def test_views_read_named_files_of_one_version(spark, root):
    file_merge.merge_insider(spark, root, *insider(spark, ("A", DATASET, ["1"])))
    stray = insider(spark, ("STRAY", DATASET, ["1"]))[1]
    versions.add_rows(spark, stray, "insider_transactions", root)
    names = versions.publish(spark, root, "lake", prefix="v_")
    file_merge.merge_insider(spark, root, *insider(spark, ("B", DATASET, ["2"])))
    assert [r.accession for r in spark.sql("SELECT accession FROM v_insider_transactions").collect()] == ["A"]
    assert spark.sql("SELECT version FROM v_dataset_snapshot").first()[0] == 1 and len(names) == 5
    assert spark.table("v_institutional_holdings").columns[: len(schemas.TABLES["institutional_holdings"])] == schemas.TABLES["institutional_holdings"].fieldNames()
    versions.publish(spark, root, "lake", "insider_filings", [1990], prefix="v_")
    assert spark.table("v_insider_filings").count() == 0
    now = versions.snapshot(spark, root)
    lake.remove(spark, [f"{root}/{now.paths('insider_filings')[0]}"])
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        now.rows("insider_filings").count()


def test_expired_versions_and_their_files_go(spark, root):
    for k in "123":
        file_merge.merge_insider(spark, root, *insider(spark, ("A", DATASET, [k])))
    stored = lambda: len(glob.glob(f"{root}/insider_*/commit=*/*/*.parquet"))
    assert stored() == 6 and versions.expire(spark, root, keep=1) == 0  # too young
    assert versions.expire(spark, root, keep=1, older_than_hours=-1) == 4 and stored() == 2
    assert legs(versions.snapshot(spark, root)) == [("A", "3", DATASET)]
    with pytest.raises(FileNotFoundError):
        versions.snapshot(spark, root, 1)


def test_an_empty_lake(spark, root):
    empty = versions.snapshot(spark, root)
    assert empty.version == 0 and empty.rows("insider_filings").count() == 0
    done = file_merge.merge_insider(spark, root, *insider(spark))
    assert done.version == 1 and done.rows("insider_transactions").count() == 0
