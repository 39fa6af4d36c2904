import json

import pytest
from test_sources import zipped

from filinglake.operators.checks import BrokenRows
from filinglake.plans import reports

HEAD = "ACCESSION_NUMBER\tFILING_DATE\tSUBMISSIONTYPE\tPERIODOFREPORT\n"


def test_lag_report_reads_submissions_of_all_archives(spark, tmp_path):
    folder = tmp_path / "raw/sec13f/datasets"
    rows = {
        "2025q4/a": "A\t14-FEB-2026\t13F-HR\t31-DEC-2025\nB\t15-JAN-2026\t13F-HR\t31-DEC-2025\nC\t\t13F-HR\t31-DEC-2025\n",
        "2026q1/b": "D\t01-MAR-2026\t13F-HR/A\t31-DEC-2025\nE\t10-JAN-2026\t13F-NT\t31-DEC-2025\nF\t10-JAN-2026\t13F-NT\t\n",
    }
    for name, body in rows.items():
        (folder / name).parent.mkdir(parents=True)
        zipped(folder / f"{name}.zip", {"stem/SUBMISSION.tsv" if name.endswith("b") else "SUBMISSION.tsv": HEAD + body})
    (r,) = reports.lag_report(spark, str(tmp_path), str(tmp_path / "out"), "r1", run=True).collect()
    assert (r.windows, r.filings, tuple(r.original), tuple(r.amendment)) == (2, 4, (3, 15, 45, 45), (1, 60, 60, 60))
    (written,) = (tmp_path / "out/reports/r1/filing-lags").glob("*.json")
    assert json.loads(written.read_text())["original"]["p95"] == 45
    with pytest.raises(ValueError, match="round id"):
        reports.lag_report(spark, str(tmp_path), str(tmp_path / "out"), run=True)
    zipped(folder / "2026q1/c.zip", {"SUBMISSION.tsv": HEAD + "Z\t31-FEB-2026\t13F-HR\t31-DEC-2025\n"})
    with pytest.raises(BrokenRows, match="FILING_DATE x1, e.g. Z"):
        reports.lag_report(spark, str(tmp_path), str(tmp_path / "dry"))
    assert not (tmp_path / "dry").exists()


def test_lag_report_of_a_kind_without_filings(spark):
    dated = spark.createDataFrame([], "submissionType STRING, filingDate DATE, periodOfReport DATE")
    (r,) = reports.lag_totals(dated, spark.range(3)).collect()
    assert (r.windows, r.filings, tuple(r.original), tuple(r.amendment)) == (3, 0, (0, None, None, None), (0, None, None, None))


def test_crosswalk_from_an_archive(spark, tmp_path):
    holdings = "\n".join([
        "ACCESSION\tHOLDING_ID\tISSUER_NAME\tISSUER_CUSIP", "x\t1\tFirst\t594918104", "x\t2\tLater\t594918104", "x\t3\tNone\t000000000",
        "x\t4\tOther\t037833100", "x\t5\tNo ticker\t111111111", "x\t6\tshifted\tby\t222222222", "",
    ])
    identifiers = "\n".join([
        "HOLDING_ID\tIDENTIFIER_ISIN\tIDENTIFIER_TICKER", "1\tUS5949181045\t", "1\t\tmsft", "2\t\tMSFT", "3\t\tZZZ", "4\tUS0000000000\tAAPL", "5\tUS1\t", "6\t\tQ", "",
    ])
    path = tmp_path / "2026q2_nport.zip"
    zipped(path, {"FUND_REPORTED_HOLDING.tsv": holdings, "IDENTIFIERS.tsv": identifiers})
    pairs, stats = reports.nport_crosswalk(spark, str(path), "nport:2026q2", str(tmp_path / "out"))
    assert [tuple(r) for r in pairs.collect()] == [("594918104", "MSFT", "First", "US5949181045", "nport:2026q2")]
    assert tuple(stats.first()) == (6, 7, 5, 1, 1, 1, 1, 1)
    zipped(tmp_path / "bad.zip", {"FUND_REPORTED_HOLDING.tsv": "HOLDING_ID\n1\n", "IDENTIFIERS.tsv": identifiers})
    with pytest.raises(BrokenRows, match="ISSUER_CUSIP"):
        reports.nport_crosswalk(spark, str(tmp_path / "bad.zip"), "s", str(tmp_path / "no"))
