import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F
from rows import table

from filinglake.operators import availability, incremental, integrity


def test_holdings_window(spark):
    filings = table(spark, "institutional_filings", [
        {"accession": "1"}, {"accession": "2", "submissionType": "13F-NT/A", "managerName": None}, {"accession": "3", "submissionType": "13F-HR/A", "periodOfReport": None}])
    holdings = table(spark, "institutional_holdings", [
        {"accession": "1"}, {"accession": "1"}, {"accession": "9"}, {"accession": "2", "infoTableSk": "7"},
        {"accession": "1", "infoTableSk": "11", "issuerName": None, "cusip": "000000000", "value": 0.0, "sharesAmount": None, "figi": "B", "putCall": "Put"}])
    (r,) = integrity.holdings_integrity(filings, holdings, "ord").collect()
    assert (r.filings, r.holdings, r.orphanHoldings, r.distinctCusips, r.nullIssuerHoldings) == (3, 5, 1, 2, 1)
    assert (r.zeroPositionHoldings, r.placeholderCusips, r.figiCoverage, r.nullManagerFilings, r.noticeFilingsWithHoldings) == (1, 1, 1, 1, 1)
    assert r.duplicateHoldingKeys == ["1/10"] and r.putCall == {"NULL": 3, "Put": 1}
    assert r.submissionTypes == {"13F-HR": 1, "13F-HR/A": 1, "13F-NT/A": 1}
    assert (r.lag_p50, r.lag_p95, r.lag_max) == (90, 90, 90)


def test_hot_key_gives_one_entry_per_repeat_up_to_the_cap(spark):
    filings = table(spark, "institutional_filings", [{"accession": "1"}])
    rows = [{"accession": "1", "infoTableSk": "late"}] + [{"accession": "1", "infoTableSk": "hot"}] * 500 + [{"accession": "1", "infoTableSk": "late"}]
    (r,) = integrity.holdings_integrity(filings, table(spark, "institutional_holdings", rows), "ord").collect()
    assert r.duplicateHoldingKeys == ["1/hot"] * 20
    plan = integrity.repeated_keys(table(spark, "institutional_holdings", rows), "ord")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan  # each task forgets the surplus before the shuffle


def test_empty_side_still_reports_the_window(spark):
    (r,) = integrity.holdings_integrity(table(spark, "institutional_filings", []), table(spark, "institutional_holdings", [{}]), "ord").collect()
    assert (r.filings, r.holdings, r.orphanHoldings, r.distinctCusips, r.putCall, r.duplicateHoldingKeys) == (0, 1, 1, 0, {}, [])


def test_insider_window(spark):
    filings = table(spark, "insider_filings", [{"accession": "1"}, {"accession": "1"}, {"accession": "1", "ownerCik": "3"}, {"accession": "2", "formType": "4/A"}])
    legs = table(spark, "insider_transactions", [
        {"accession": "1"}, {"accession": "9"}, {"accession": "1", "transactionDate": dt.date(2026, 4, 9)}, {"accession": "1", "transactionCode": None},
        {"accession": "1", "issuerTicker": None, "shares": None}, {"accession": "1", "pricePerShare": -1.0}])
    report = integrity.insider_integrity(filings, legs, "ord")
    (r,) = report.collect()
    assert (r.filings, r.accessions, r.transactions, r.orphanTransactions, r.futureDatedTransactions) == (4, 2, 6, 1, 1)
    assert (r.nullTickerTransactions, r.nullSharesTransactions, r.negativeAmounts, r.amendmentsWithoutOriginalDate) == (1, 1, 1, 1)
    assert r.duplicateFilingKeys == ["1 x2"] and r.transactionCodes == {"NULL": 1, "P": 4}
    total = integrity.rollup(report, ["filings", "orphanTransactions"], ["transactionCodes"], "duplicateFilingKeys").first()
    assert (total.windows, total.filings, total.transactionCodes, total.duplicateFilingKeys) == (1, 4, {"NULL": 1, "P": 4}, ["1 x2"])


def test_boundaries_and_spread(spark):
    day = dt.date
    rows = [("a", day(2024, 1, 1), day(2024, 3, 31)), ("b", day(2024, 3, 31), day(2024, 6, 30)), ("c", day(2024, 7, 1), day(2024, 9, 30)), ("n", None, None)]
    df = spark.createDataFrame(rows, "window STRING, minFilingDate DATE, maxFilingDate DATE")
    assert [(r.previous, r.window) for r in integrity.boundary_overlaps(df).collect()] == [("a", "b")]
    filings = table(spark, "institutional_filings", [{"accession": "1", "window": "a"}, {"accession": "1", "window": "b"}, {"accession": "2", "window": "b"}, {"accession": "2", "window": "b"}])
    assert integrity.accession_spread(filings).first().asDict() == {"distinctAccessions": 2, "multiWindowAccessions": 1}


def test_lags_split_originals_from_amendments(spark):
    day = dt.date(2025, 12, 31)
    rows = [{"periodOfReport": day - dt.timedelta(days=n)} for n in range(10)] + [{"submissionType": "13F-HR/A", "periodOfReport": None}, {"submissionType": "13F-HR/A"}]
    found = {r.kind: (r.n, r.p50, r.p95, r.max) for r in integrity.filing_lags(table(spark, "institutional_filings", rows)).collect()}
    assert found == {"original": (10, 95, 99, 99), "amendment": (1, 90, 90, 90)}


def test_coverage(spark):
    objects = spark.createDataFrame([("raw/x/2013q2/b.zip",), ("raw/x/2013q2/a.zip",), ("raw/x/../c.zip",), ("other/2014q1/a.zip",), ("raw/x/2014q1/z.zip",), ("raw/x/loose.zip",)], "key STRING")
    ledger = spark.createDataFrame([("form13f:2013q2",), ("form13f:2015q1",)], "identity STRING")
    found = {(r.label, r.status) for r in integrity.coverage(objects, ledger, "form13f", "raw/x").collect()}
    assert found == {("2015q1", "missing_raw"), ("2014q1", "unreceipted")}
    assert {r.label: r.key for r in integrity.archives_by_label(objects, "raw/x").collect()}["2013q2"] == "raw/x/2013q2/a.zip"


def test_buckets_are_stable_and_complete(spark):
    items = spark.range(200).select(F.concat(F.lit("form13f:item-"), "id").alias("identity"))
    got = {r.identity: r.bucket for r in incremental.with_bucket(items, "identity", 32).collect()}
    assert got == {i: int.from_bytes(hashlib.sha256(i.encode()).digest()[:4], "big") % 32 for i in got}
    done = items.limit(120)
    pending = [r.identity for b in range(32) for r in incremental.pending_work(items, done, 32, b).collect()]
    assert len(pending) == 80 == len(set(pending))


def test_ledger_append_drop_and_limits(spark):
    ledger = spark.createDataFrame([("r1", "a", '{"status":"ok"}'), ("r1", "b", '{"status":"failed"}'), ("r2", "b", "{}")], "roundId STRING, identity STRING, body STRING")
    keep = F.get_json_object("body", "$.status") == "ok"
    assert incremental.reprocess_report(ledger, "r1", keep).first().asDict() == {"inspected": 2, "dropped": 1}
    assert sorted((r.roundId, r.identity) for r in incremental.drop_from_ledger(ledger, "r1", keep).collect()) == [("r1", "a"), ("r2", "b")]
    new = spark.createDataFrame([("b", "again"), ("c", "x"), ("c", "y")], "identity STRING, body STRING")
    after = {(r.roundId, r.identity): r.body for r in incremental.append_to_ledger(ledger, new, "r1").collect()}
    assert after[("r1", "b")] == "again" and after[("r2", "b")] == "{}" and len(after) == 4
    with pytest.raises(ValueError):
        incremental.check_round_id("no/slash")
    taken, counts = incremental.take_first(spark.range(7), 5, "id")
    assert [r.id for r in taken.collect()] == [0, 1, 2, 3, 4] and counts.first().asDict() == {"pending": 7, "deferred": 2}


def test_raw_keys_and_conflicts(spark):
    df = spark.createDataFrame([("k", "a"), ("k", "a"), ("m", "a"), ("m", "b")], "key STRING, content STRING")
    assert [(r.key, r.n) for r in incremental.key_conflicts(df, "key", "content").collect()] == [("m", 2)]
    made = incremental.with_raw_key(df, "raw/p", "key", "content").first().rawKey
    assert made == f"raw/p/k/{hashlib.sha256(b'a').hexdigest()}.zip"


def test_availability_bounds_are_inclusive(spark):
    filed = dt.datetime(2026, 9, 11)
    shifts = {"a": -96, "b": -97, "c": 48, "d": 49, "e": None}
    filings = spark.createDataFrame([(k, filed) for k in shifts], "accession STRING, filed TIMESTAMP")
    accepted = spark.createDataFrame([(k, filed + dt.timedelta(hours=h)) for k, h in shifts.items() if h is not None], "accession STRING, accepted TIMESTAMP")
    found = {r.accession: (r.availableAt, r.availabilitySource) for r in availability.filing_availability(filings, accepted).collect()}
    late = (filed + dt.timedelta(hours=24), "filed-date-fallback")
    assert found["a"] == (filed - dt.timedelta(hours=96) + dt.timedelta(minutes=1), "submissions")
    assert found["c"][1] == "submissions" and found["b"] == found["d"] == found["e"] == late
