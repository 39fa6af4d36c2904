import hashlib
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from filinglake import schemas
from filinglake.operators.checks import BrokenRows
from filinglake.plans import pipelines
from filinglake.sources import archives, daily_index, links, manifest, submissions, tsv


def lines(spark, *texts, key="f"):
    return spark.createDataFrame([(key, n, t) for n, t in enumerate(texts)], "archive_key STRING, ord LONG, line STRING")


def test_tsv_files_of_two_layouts_in_one_pass(spark, tmp_path):
    (tmp_path / "a.tsv").write_bytes("﻿A \tB\tB\r\n1\t2\t3\textra\r\n \t \r\n4\r\n\"q\tx\rz\ty\r\n".encode())
    (tmp_path / "b.tsv").write_bytes(b"OTHER\tA\nskip\t9\n")
    read = tsv.records(tsv.read_lines(spark, str(tmp_path)), ["A"], ["B"])
    got = {(r.A, r.B) for r in read.collect()}
    # The last B counts, short rows read blank, quotes and lone carriage returns are text.
    assert got == {("1", "3"), ("4", ""), ('"q', "y"), ("9", "")}
    with pytest.raises(BrokenRows, match="b.tsv lacks B"):
        tsv.records(tsv.read_lines(spark, str(tmp_path)), ["A", "B"])


def test_file_order_survives_splits(spark, tmp_path):
    body = "K\tN\n" + "".join(f"k{n % 7}\t{n}\n" for n in range(5000))
    (tmp_path / "big.tsv").write_text(body)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        read = tsv.records(tsv.read_lines(spark, str(tmp_path)), ["K", "N"])
        assert read.rdd.getNumPartitions() > 3
        got = read.groupBy("K").agg(F.min_by("N", "ord").alias("first"), F.max_by("N", "ord").alias("last"), F.count("*").alias("n")).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sum(r.n for r in got) == 5000
    assert {r.K: (r.first, r.last) for r in got} == {f"k{k}": (str(k), str(max(n for n in range(k, 5000, 7)))) for k in range(7)}


def test_strict_rows_flag_width(spark):
    read = tsv.strict_records(lines(spark, "A\tB\tA", "1\t2\t3", "x\ty", "", "4\t5\t6"), ["A", "B"])
    assert [(r.A, r.B, r.malformed) for r in read.orderBy("ord").collect()] == [("1", "2", False), (None, None, True), ("4", "5", False)]
    assert tsv.width_counts(read).first().asDict() == {"rows": 3, "malformed": 1}


def zipped(path, members):
    with zipfile.ZipFile(path, "w") as z:
        for name, body in members.items():
            z.writestr(name, body)


SUB = "ACCESSION_NUMBER\tFILING_DATE\tSUBMISSIONTYPE\tCIK\tPERIODOFREPORT\nA\t31-MAR-2026\t13F-HR\t1\t31-DEC-2025\n"
COVER = "ACCESSION_NUMBER\tISAMENDMENT\tFILINGMANAGER_NAME\nA\tN\tManager\n"
INFO = "\t".join(schemas.MEMBERS_13F["INFOTABLE.tsv"]["required"]) + "\nA\t10\tIssuer\tCOM\t123456789\t\t1,392\t6,864\tSH\t\tSOLE\t6864\t0\t0\n"


@pytest.mark.parametrize("folder", ["", "stem/"])
def test_archive_to_rows(spark, tmp_path, folder):
    landing = tmp_path / "landing"
    landing.mkdir()
    zipped(landing / "w.zip", {f"{folder}SUBMISSION.tsv": SUB, f"{folder}COVERPAGE.tsv": COVER, f"{folder}INFOTABLE.tsv": INFO, "readme.htm": "x"})
    scanned = archives.scan_archives(spark, str(landing), list(schemas.MEMBERS_13F), nested=True)
    archives.land_archives(scanned, str(tmp_path / "bronze"))
    filings, holdings = pipelines.institutional_rows(spark.read.parquet(str(tmp_path / "bronze")))
    (f,), (h,) = filings.strict().collect(), holdings.strict().collect()
    assert (f.managerName, f.isAmendment, h.value, h.votingSole) == ("Manager", False, 1392.0, 6864.0)
    assert h.rawArchiveKey.endswith("w.zip") and h.otherManager is None
    assert archives.archive_sizes(spark, str(landing)).first().bytes == (landing / "w.zip").stat().st_size


def test_every_member_is_a_task_of_its_own(spark, tmp_path):
    for n in range(10):
        zipped(tmp_path / f"{n}.zip", {"a.tsv": "".join(f"{n} {i}\r\n" for i in range(n)), "b.tsv": "\ufeffhead\nlast"})
    zipped(tmp_path / "big.zip", {"a.tsv": "x\n" * 45_000, "b.tsv": ""})
    read = archives.scan_archives(spark, str(tmp_path), ["a.tsv", "b.tsv"])
    assert read.rdd.getNumPartitions() == 22
    got = read.groupBy("archive_key", "member").agg(F.sort_array(F.collect_list(F.struct("line_no", "line"))).alias("lines")).collect()
    found = {(r.archive_key.rsplit("/")[-1], r.member): [tuple(x) for x in r.lines] for r in got}
    assert found[("3.zip", "a.tsv")] == [(0, "3 0"), (1, "3 1"), (2, "3 2")] and found[("7.zip", "b.tsv")] == [(0, "head"), (1, "last")]
    assert [n for n, _ in found[("big.zip", "a.tsv")]] == list(range(45_000))
    assert len(found) == 20  # empty members have no lines
    by_content = archives.read_archives(spark.read.format("binaryFile").load(str(tmp_path)), ["a.tsv", "b.tsv"])
    assert by_content.exceptAll(read).isEmpty() and read.exceptAll(by_content).isEmpty()
    assert archives.scan_members(spark, [], ["a.tsv"]).isEmpty()
    with pytest.raises(Exception, match="9.zip is missing c.tsv"):
        archives.scan_members(spark, [str(tmp_path / "9.zip")], ["c.tsv"]).collect()


def test_archive_layout_errors(spark, tmp_path):
    zipped(tmp_path / "two.zip", {"a/SUBMISSION.tsv": SUB, "b/SUBMISSION.tsv": SUB})
    with pytest.raises(Exception, match="2 candidates"):
        archives.scan_archives(spark, str(tmp_path), ["SUBMISSION.tsv"], nested=True).collect()
    assert archives.member_prefix(["x/SUBMISSION.tsv", "SUBMISSION.tsv"], "SUBMISSION.tsv") == ""


def test_daily_index(spark):
    body = [
        "Description: Daily Index", "Form Type   Company Name", "-" * 40 + " ",
        "4                Acme  Holdings   Inc      1304492     20260911    edgar/data/1304492/0001-26-1.txt   ",
        "1-A POS          Other Co  77  20260911  edgar/data/77/0002-26-2.txt", "   ",
        "3/A              X  78  20260911  edgar/data/78/0003-26-3.txt",
    ]
    read = daily_index.read_index(lines(spark, *body))
    first = read.strict().orderBy("ord").first()
    assert (first.formType, first.companyName, first.cik, first.dateFiled, first.accession) == (
        "4", "Acme  Holdings   Inc", "1304492", "2026-09-11", "0001-26-1")
    assert [r.formType for r in daily_index.insider_entries(read.rows).orderBy("ord").collect()] == ["4", "3/A"]
    with pytest.raises(BrokenRows, match="index line"):
        daily_index.read_index(lines(spark, *body, "garbage")).strict()
    with pytest.raises(BrokenRows, match="separator"):
        daily_index.read_index(lines(spark, "no", "separator")).strict()


def submission(accession="0001-26-1", accepted="20260911120708", owners=2, body=""):
    people = "".join(
        f"<reportingOwner><reportingOwnerId><rptOwnerCik>{n}</rptOwnerCik><rptOwnerName>Owner {n}</rptOwnerName></reportingOwnerId>"
        f"<reportingOwnerRelationship><isOfficer>{int(n == 1)}</isOfficer><isTenPercentOwner>true</isTenPercentOwner>"
        f"<officerTitle>Chief &amp; Co</officerTitle></reportingOwnerRelationship></reportingOwner>" for n in range(1, owners + 1))
    return (
        f"<SEC-HEADER>\n<ACCEPTANCE-DATETIME>{accepted}\nACCESSION NUMBER:\t\t{accession}\nFILED AS OF DATE:\t\t20260911\n</SEC-HEADER>\n"
        f"<XML>\n<?xml version=\"1.0\"?>\n<ownershipDocument>\n<documentType>4</documentType><periodOfReport>2026-09-08-05:00</periodOfReport>"
        f"<issuer><issuerCik>7</issuerCik><issuerName>Acme</issuerName><issuerTradingSymbol>NYSE: KRC</issuerTradingSymbol></issuer>{people}{body}"
        f"</ownershipDocument>\n</XML>")


LEGS = (
    "<nonDerivativeTable><nonDerivativeTransaction><securityTitle><value>Common</value></securityTitle><transactionAmounts>"
    "<transactionShares><value>293</value><footnoteId id=\"F1\"/></transactionShares><transactionPricePerShare><footnoteId id=\"F2\"/></transactionPricePerShare>"
    "</transactionAmounts></nonDerivativeTransaction><nonDerivativeTransaction><securityTitle><value>Common</value></securityTitle></nonDerivativeTransaction></nonDerivativeTable>"
    "<derivativeTable><derivativeTransaction><securityTitle><value>Swap</value></securityTitle><transactionDate><value>2026-09-10-04:00</value></transactionDate>"
    "<transactionAmounts><transactionTotalValue><value>2500000</value></transactionTotalValue></transactionAmounts></derivativeTransaction></derivativeTable>")


def docs(spark, *texts):
    return spark.createDataFrame([(f"raw/{n}.txt", t) for n, t in enumerate(texts)], "archive_key STRING, raw STRING")


def test_submission_rows(spark):
    read = submissions.parse_submissions(docs(spark, submission(body=LEGS)))
    one, two = read.filings.orderBy("ownerCik").collect()
    assert str(one.availableAt) == "2026-09-11 16:08:08" and str(one.periodOfReport) == "2026-09-08"
    assert (one.isOfficer, two.isOfficer, one.isDirector, one.officerTitle, one.resolvedTicker) == (True, False, False, "Chief & Co", "KRC")
    legs = read.transactions.orderBy("rowKind", "rowSk").collect()
    assert [(r.rowKind, r.rowSk, r.shares, r.pricePerShare, r.totalValue) for r in legs] == [
        ("deriv", "1", None, None, 2500000.0), ("nonderiv", "1", 293.0, None, None), ("nonderiv", "2", None, None, None)]
    assert str(legs[0].transactionDate) == "2026-09-10" and read.rejects.count() == 0


def test_broken_submissions_are_whole_rejects(spark):
    good = submission(body=LEGS)
    broken = docs(spark, good.replace("<ACCEPTANCE-DATETIME>20260911120708\n", ""), good.split("<XML>")[0], submission(owners=0),
                  good.replace(">293<", ">many<"), good.replace("<issuerName>Acme</issuerName>", "<issuerName> </issuerName>"))
    read = submissions.parse_submissions(broken)
    assert read.filings.count() == 0 and read.transactions.count() == 0
    found = {r.archive_key: r.broken[0] for r in read.rejects.collect()}
    assert found == {"raw/0.txt": "ACCEPTANCE-DATETIME", "raw/1.txt": "ownershipDocument", "raw/2.txt": "reportingOwner",
                     "raw/3.txt": "transaction cell", "raw/4.txt": "documentType, issuerCik or issuerName"}


def test_links(spark):
    html = ('<a href="/files/2013q2_form13f.zip">a</a><a href="/x/01mar2026-31may2026_form13f.zip">b</a><a href="/x/2013q2_form13f.zip">again</a>'
            '<a href="/x/readme.zip">c</a><a href="../2013q3_form13f.txt">d</a>'
            '<a class="k" href="/n/2026q2_nport.zip">e</a><a href="https://e.org/2026q2_nport.zip">f</a><a href="/n/2026q7_nport.zip">g</a>')
    pages = spark.createDataFrame([(1, html)], "page INT, html STRING")
    assert [r.stem for r in links.discover_windows(pages).collect()] == ["01mar2026-31may2026_form13f", "2013q2_form13f"]
    assert [tuple(r) for r in links.discover_fund_quarters(pages, "page").collect()] == [(2026, 2, "https://e.org/2026q2_nport.zip")]


def snapshot(files, table="insider_filings", **more):
    entry = {"rows": 1, "years": [2024], "manifests": [{"year": 2024, "files": files}]}
    return json.dumps({"schemaVersion": 1, "dataset": "d", "generatedAt": "t", "totals": {"rows": 1}, "tables": {table: entry}, **more})


def test_manifest_and_verification(spark, tmp_path):
    (tmp_path / "data").mkdir()
    (tmp_path / "data" / "a.bin").write_bytes(b"one")
    (tmp_path / "data" / "b.bin").write_bytes(b"two")
    digest = hashlib.sha256(b"one").hexdigest()
    files = [{"publicPath": f"data/{n}.bin", "size": 3, "sha256": digest} for n in "abc"]
    (tmp_path / "snapshot.json").write_text(snapshot(files))
    read = manifest.read_manifest(manifest.read_snapshot_file(spark, str(tmp_path / "snapshot.json")))
    chosen = manifest.require_files(read.strict(), "insider_filings", 2024)
    checked = manifest.verify_files(chosen, manifest.scan_contents(spark, str(tmp_path)))
    assert {r.publicPath: r.status for r in checked.collect()} == {"data/a.bin": "ok", "data/b.bin": "different", "data/c.bin": "missing"}
    assert {r.status: (r.files, r.bytes) for r in manifest.verification_totals(checked).collect()}["ok"] == (1, 3)
    with pytest.raises(BrokenRows):
        manifest.require_files(read.rows, year=1999)


@pytest.mark.parametrize("path", ["/etc/x", "data/../x", "data//x", "other/x", "data\\x", "data/./x", ""])
def test_unsafe_paths_are_rejected(spark, path):
    text = snapshot([{"publicPath": path, "size": 1, "sha256": "a" * 64}])
    read = manifest.read_manifest(spark.createDataFrame([("s", text)], "snapshot_id STRING, json STRING"))
    assert read.rows.count() == 0
    with pytest.raises(BrokenRows, match="publicPath"):
        read.strict()


def test_broken_manifests(spark):
    ok = [{"publicPath": "data/x", "size": 1, "sha256": "a" * 64}]
    for text, words in [
        (snapshot(ok, table="passwords"), "unknown table"), (snapshot(ok, schemaVersion=-1), "schemaVersion"),
        (snapshot([{**ok[0], "sha256": "A" * 64}]), "sha256"), (snapshot([{**ok[0], "size": 1.5}]), "size"),
        (snapshot(ok, totals={"rows": -4}), "totals"), ("not json", "tables"),
    ]:
        read = manifest.read_manifest(spark.createDataFrame([("s", text)], "snapshot_id STRING, json STRING"))
        with pytest.raises(BrokenRows, match=words):
            read.strict()
