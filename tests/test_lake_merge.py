import datetime as dt

import pytest
from pyspark.sql import functions as F
from rows import table

from filinglake import schemas
from filinglake.operators import merge
from filinglake.operators.checks import BrokenRows
from filinglake.plans import analytics, pipelines
from filinglake.sinks import lake
from filinglake.sources import footers

DATASET, DAILY = schemas.SOURCE_345_DATASET, schemas.SOURCE_ACCEPTANCE


def at(text):
    return dt.datetime.fromisoformat(text)


def insider(spark, *parts, when=None):
    """(accession, source, [row keys]) parts as filings and transactions."""
    filings = [{"accession": a, "availabilitySource": s, "availableAt": at(when or "2026-09-11T20:00:00")} for a, s, _ in parts]
    legs = [{"accession": a, "availabilitySource": s, "rowSk": k, "availableAt": at(when or "2026-09-11T20:00:00")} for a, s, ks in parts for k in ks]
    return tuple(table(spark, n, r).drop("window", "ord") for n, r in (("insider_filings", filings), ("insider_transactions", legs)))


def legs_of(df):
    return sorted((r.accession, r.rowSk, r.availabilitySource) for r in df.collect())


def test_insider_precedence(spark):
    existing = insider(spark, ("A", DATASET, ["901"]), ("B", DAILY, ["1"]), ("C", DATASET, ["902"]))
    incoming = insider(spark, ("A", DAILY, ["1"]), ("B", DAILY, ["1", "2"]), ("D", DATASET, ["7"]))
    filings, legs = merge.merge_insider(existing, incoming)
    assert legs_of(legs.strict()) == [("A", "1", DAILY), ("B", "1", DAILY), ("B", "2", DAILY), ("C", "902", DATASET), ("D", "7", DATASET)]
    assert filings.strict().count() == 4
    # A later data set does not displace an acceptance-time read.
    _, again = merge.merge_insider(insider(spark, ("A", DAILY, ["1"])), insider(spark, ("A", DATASET, ["901"])))
    assert legs_of(again.strict()) == [("A", "1", DAILY)]


def test_insider_sources_must_be_known_and_single(spark):
    mixed = (insider(spark, ("A", DAILY, []))[0], insider(spark, ("A", DATASET, ["1"]))[1])
    none = insider(spark, )
    with pytest.raises(BrokenRows, match="mixed"):
        merge.merge_insider(mixed, none)[0].strict()
    with pytest.raises(BrokenRows, match="unknown source"):
        merge.merge_insider(none, insider(spark, ("A", "elsewhere", ["1"])))[0].strict()


def test_institutional_upsert_is_idempotent(spark):
    def rows(*pairs):
        return table(spark, "institutional_holdings", [{"infoTableSk": k, "value": v} for k, v in pairs])

    old, new = rows(("1", 1.0), ("2", 2.0)), rows(("2", 20.0), ("2", 21.0), ("3", 3.0))
    merged = merge.merge_institutional("institutional_holdings", old, new, "ord").strict()
    assert sorted((r.infoTableSk, r.value) for r in merged.collect()) == [("1", 1.0), ("2", 21.0), ("3", 3.0)]
    twice = merge.merge_institutional("institutional_holdings", merged, new, "ord").strict()
    assert twice.count() == 3
    other = table(spark, "institutional_holdings", [{"availabilitySource": "daily"}])
    with pytest.raises(BrokenRows, match="unknown source daily"):
        merge.merge_institutional("institutional_holdings", old, other, "ord").strict()


def test_year_shards_clustering_and_as_of(spark, tmp_path):
    rows = [{"accession": f"A{n}", "cusip": f"C{n % 5}", "infoTableSk": str(n),
             "availableAt": at("2026-01-01T04:59:59.999" if n % 2 else "2025-06-01T00:00:00")} for n in range(40)]
    lake.write_lake(table(spark, "institutional_holdings", rows), "institutional_holdings", str(tmp_path))
    assert lake.shard_years(spark, f"{tmp_path}/institutional_holdings") == [2025, 2026]
    back = lake.read_table(spark, "institutional_holdings", str(tmp_path))
    assert back.columns == [*schemas.INSTITUTIONAL_HOLDINGS.names, lake.SHARD] and back.count() == 40
    known = lake.as_of(back, "2025-12-31")
    assert known.count() == 20
    assert "availableYear#" in known._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("]")[0]


def test_legacy_shard_derives_only_the_absent_column(spark, tmp_path):
    new = table(spark, "insider_filings", [{"accession": "N", "issuerTicker": "(SIRI)", "resolvedTicker": None}])
    lake.write_lake(new, "insider_filings", str(tmp_path))
    old = table(spark, "insider_filings", [{"accession": "O", "issuerTicker": "(SIRI)"}]).drop("resolvedTicker", "window", "ord")
    old.write.parquet(f"{tmp_path}/insider_filings/availableYear=2010")
    got = {r.accession: r.resolvedTicker for r in lake.read_table(spark, "insider_filings", str(tmp_path)).collect()}
    assert got == {"N": None, "O": "SIRI"}


def test_year_with_old_and_new_files_is_right_in_both(spark, tmp_path):
    """Absent in a file is not null in a file, also within one year, and reading some years reads no other's files."""
    root = str(tmp_path)
    rows = [{"accession": a, "issuerTicker": "(SIRI)", "resolvedTicker": None, "availableAt": at(f"{y}-06-01T00:00:00")} for a, y in (("N", 2010), ("M", 2011))]
    lake.write_lake(table(spark, "insider_filings", rows), "insider_filings", root)
    old = table(spark, "insider_filings", [{"accession": "O", "issuerTicker": "(SIRI)"}]).drop("resolvedTicker", "window", "ord")
    old.write.mode("append").parquet(f"{root}/insider_filings/availableYear=2010")
    read = lake.read_table(spark, "insider_filings", root)
    assert {(r.accession, r.availableYear, r.resolvedTicker) for r in read.collect()} == {("N", 2010, None), ("M", 2011, None), ("O", 2010, "SIRI")}
    only = lake.read_table(spark, "insider_filings", root, years=[2011])
    assert [r.accession for r in only.collect()] == ["M"] and all("availableYear=2011" in f for f in only.inputFiles())
    found = footers.read_footers(spark, [f"{root}/insider_filings"])
    assert found.agg(F.sum("n_rows")).first()[0] == 3
    assert sorted("resolvedTicker" in names for names, _ in footers.schema_groups(found)) == [False, True]
    assert lake.read_table(spark, "insider_filings", root, years=[1999]).count() == 0


def test_file_with_a_column_of_another_type_is_refused_by_name(spark, tmp_path):
    root = str(tmp_path)
    lake.write_lake(table(spark, "insider_filings", [{"accession": "N"}]), "insider_filings", root)
    bad = table(spark, "insider_filings", [{"accession": "B"}]).withColumn("issuerTicker", F.lit(7)).drop("window", "ord")
    bad.write.mode("append").parquet(f"{root}/insider_filings/availableYear=2010")
    with pytest.raises(ValueError, match="availableYear=2010.*issuerTicker is whole, not text"):
        lake.read_table(spark, "insider_filings", root)


def test_typed_read_names_the_field(spark):
    rows = table(spark, "insider_transactions", [{}, {"securityTitle": None}, {"rowKind": "other"}, {"shares": float("nan")}])
    with pytest.raises(BrokenRows, match="rowKind unknown x1.*securityTitle x1.*shares not finite x1"):
        lake.check_table(rows, "insider_transactions").strict()


def test_refresh_moves_an_accession_between_years_and_drops_the_empty_shard(spark, tmp_path):
    root = str(tmp_path)
    pipelines.refresh_insider(spark, root, *insider(spark, ("A", DATASET, ["1"]), when="2026-01-02T04:59:59"))
    pipelines.refresh_insider(spark, root, *insider(spark, ("B", DATASET, ["1"]), when="2025-05-02T04:59:59"))
    years = pipelines.refresh_insider(spark, root, *insider(spark, ("A", DAILY, ["1", "2"]), when="2025-12-31T23:00:00"))
    assert years == [2025, 2026]
    legs = lake.read_table(spark, "insider_transactions", root)
    assert legs_of(legs) == [("A", "1", DAILY), ("A", "2", DAILY), ("B", "1", DATASET)]
    assert lake.shard_years(spark, f"{root}/insider_transactions") == [2025]
    pipelines.refresh_insider(spark, root, *insider(spark, ("A", DAILY, ["1", "2"]), when="2025-12-31T23:00:00"))
    assert legs_of(lake.read_table(spark, "insider_transactions", root)) == [("A", "1", DAILY), ("A", "2", DAILY), ("B", "1", DATASET)]


def test_publish_a_slice(spark, tmp_path):
    rows = [{"accession": "A", "availableAt": at("2024-05-01T00:00:00")}, {"accession": "B", "availableAt": at("2025-05-01T00:00:00")}]
    lake.write_lake(table(spark, "insider_transactions", rows), "insider_transactions", str(tmp_path))
    made = lake.publish_views(spark, str(tmp_path), ("d", "now", 3), "insider_transactions", 2024, prefix="slice_")
    assert made == ["slice_insider_transactions", "slice_dataset_snapshot"]
    assert [r.accession for r in spark.sql("select accession from slice_insider_transactions").collect()] == ["A"]
    assert tuple(spark.table("slice_dataset_snapshot").first()) == ("d", "now", 3)
    with pytest.raises(FileNotFoundError):
        lake.publish_views(spark, str(tmp_path), ("d", "now", 3), "insider_transactions", 1999)
    lake.publish_views(spark, str(tmp_path), ("d", "now", 3), prefix="all_")
    assert spark.table("all_institutional_filings").count() == 0


def test_report_is_only_written_on_a_run(spark, tmp_path):
    report = spark.range(1).selectExpr("id AS windows")
    lake.write_report(report, str(tmp_path), "r", "lags")
    assert not (tmp_path / "reports").exists()
    lake.write_report(report, str(tmp_path), "r", "lags", run=True)
    assert spark.read.json(f"{tmp_path}/reports/r/lags").first().windows == 0


def test_joint_filings_do_not_multiply_shares(spark):
    filings = table(spark, "insider_filings", [{"ownerCik": "1"}, {"ownerCik": "2"}, {"ownerCik": "2"}])
    legs = table(spark, "insider_transactions", [{"acquiredDisposed": "A", "shares": 5.0}, {"rowSk": "2", "acquiredDisposed": "D", "shares": 2.0}])
    found = {r.ownerCik: (r.filings, r.legs, r.acquired, r.disposed) for r in analytics.owner_activity(filings, legs).collect()}
    assert found == {"1": (1, 2, 5.0, 2.0), "2": (1, 2, 5.0, 2.0)}
    assert analytics.cluster_buying(filings, legs).first().buyers == 2


def test_whole_13f_chain(spark, tmp_path):
    """Re-reading a window replaces it; units and tickers follow from the stored rows."""
    def window(value):
        filings = table(spark, "institutional_filings", [{"filingDate": dt.date(2020, 5, 15)}]).drop("window")
        rows = [{"value": 1.0}, {"value": value}, {"infoTableSk": "11", "accession": "Z", "value": 3.0}]
        return filings, table(spark, "institutional_holdings", rows).drop("window")

    for value in (2.0, 5.0):
        pipelines.refresh_institutional(spark, str(tmp_path), *window(value))
    filings, holdings = (lake.read_table(spark, n, str(tmp_path)) for n in ("institutional_filings", "institutional_holdings"))
    spans = spark.createDataFrame([("123456789", "EX", None, None, 0)], "cusip STRING, ticker STRING, fromDate DATE, toDate DATE, ord LONG")
    got = pipelines.resolved_holdings(filings, holdings, spans).orderBy("infoTableSk").collect()
    assert [(r.value, r.valueUnitSource, r.resolvedTicker) for r in got] == [(5000.0, "date", "EX"), (3.0, "unknown", "EX")]
