import json
import shutil

import pytest
from test_sources import COVER, INFO, SUB, zipped

from filinglake import schemas
from filinglake.operators.integrity import MissingRaw
from filinglake.plans import audit
from filinglake.streaming import backfill

PREFIX = {"form13f": "raw/sec13f/datasets", "form345": "raw/sec345/datasets"}


@pytest.fixture
def world(spark, tmp_path):
    def finish(dataset, *labels):
        rows = [("r1", f"{dataset}:{label}", "{}") for label in labels]
        spark.createDataFrame(rows, backfill.LEDGER).write.mode("overwrite").parquet(str(tmp_path / "ledger"))

    def land(dataset, label, digest, members):
        folder = tmp_path / PREFIX[dataset] / label
        if folder.exists():
            shutil.rmtree(folder)
        folder.mkdir(parents=True)
        zipped(folder / f"{digest}.zip", members)

    def run(dataset, **more):
        args = dict(landing=str(tmp_path / PREFIX[dataset]), state_root=str(tmp_path / "state"), ledger=str(tmp_path / "ledger"),
                    round_id="r1", reports=str(tmp_path / "lake"))
        return audit.audit_round(spark, dataset, **args, **more)

    return finish, land, run


@pytest.fixture
def read_windows(monkeypatch):
    """The windows whose archives a run reads."""
    seen, real = [], audit._audit_archives
    monkeypatch.setattr(audit, "_audit_archives", lambda spark, state, batch: (seen.extend(r.window for r in batch), real(spark, state, batch)))
    return seen


def institutional(*accessions, doubled=False):
    sub = SUB.split("\n")[0] + "\n" + "".join(SUB.split("\n")[1].replace("A\t", f"{a}\t", 1) + "\n" for a in accessions)
    info = INFO.split("\n")[0] + "\n" + "".join(INFO.split("\n")[1].replace("A\t", f"{a}\t", 1) + "\n" for a in accessions for _ in range(1 + doubled))
    return {"SUBMISSION.tsv": sub, "COVERPAGE.tsv": COVER, "INFOTABLE.tsv": info}


def test_archives_to_json_and_only_new_windows_are_read(spark, world, read_windows, tmp_path):
    finish, land, run = world
    land("form13f", "2025q1", "a" * 64, institutional("A", "B"))
    land("form13f", "2025q2", "b" * 64, institutional("B", "C", doubled=True))
    finish("form13f", "2025q1")
    first = run("form13f").first()
    assert (first.windows, first.totalFilings, first.totalRows, first.distinctAccessions, first.multiWindowAccessions) == (2, 4, 6, 3, 1)
    assert first.unreceiptedRaw == ["form13f:2025q2"] and first.duplicateHoldingKeys == ["B/10", "C/10"]
    assert read_windows == ["2025q1", "2025q2"] and not (tmp_path / "lake").exists()  # a dry run writes nothing

    read_windows.clear()
    land("form13f", "2025q3", "c" * 64, institutional("C", "D"))
    again = run("form13f", run=True).first()
    assert read_windows == ["2025q3"]
    assert (again.windows, again.totalFilings, again.distinctAccessions, again.multiWindowAccessions) == (3, 6, 4, 2)
    (text,) = (tmp_path / "lake/reports/r1/integrity-form13f").glob("*.json")
    written = json.loads(text.read_text())
    assert written["totalRows"] == 8 and written["submissionTypes"] == {"13F-HR": 6} and written["roundId"] == "r1"
    assert "reports" not in backfill.read_ledger(spark, str(tmp_path / "ledger")).first().identity

    # Another content under the same label replaces the window, its accessions included.
    read_windows.clear()
    land("form13f", "2025q2", "d" * 64, institutional("E"))
    last = run("form13f").first()
    assert read_windows == ["2025q2"]
    assert (last.windows, last.totalFilings, last.distinctAccessions, last.multiWindowAccessions) == (3, 5, 5, 0)
    assert last.duplicateHoldingKeys == []


def test_finished_windows_without_raw_fail_the_audit(world, read_windows):
    finish, land, run = world
    land("form13f", "2025q1", "a" * 64, institutional("A"))
    land("form13f", "2025q2", "b" * 64, institutional("B"))
    finish("form13f", "2025q1", "2024q1", "2024q2")
    with pytest.raises(MissingRaw, match="2 finished window.*2024q1, 2024q2"):
        run("form13f")
    assert read_windows == []
    part = run("form13f", max_windows=1).first()  # a part is audited without the gate
    assert (part.windows, part.totalFilings, part.unreceiptedRaw) == (1, 1, []) and read_windows == ["2025q1"]


def insider(*rows, legs=1):
    """Archive members from (accession, filing day); each has one owner and `legs` transactions."""
    def member(name, cells):
        names = [*schemas.MEMBERS_345[name]["required"], *schemas.MEMBERS_345[name]["optional"]]
        return "\t".join(names) + "\n" + "".join("\t".join(row.get(n, "") for n in names) + "\n" for row in cells)

    return {
        "SUBMISSION.tsv": member("SUBMISSION.tsv", [
            {"ACCESSION_NUMBER": a, "FILING_DATE": day, "DOCUMENT_TYPE": "4", "ISSUERCIK": "7", "ISSUERNAME": "Acme", "ISSUERTRADINGSYMBOL": "EX"} for a, day in rows]),
        "REPORTINGOWNER.tsv": member("REPORTINGOWNER.tsv", [{"ACCESSION_NUMBER": a, "RPTOWNERCIK": "1", "RPTOWNERNAME": "O"} for a, _ in rows]),
        "NONDERIV_TRANS.tsv": member("NONDERIV_TRANS.tsv", [
            {"ACCESSION_NUMBER": a, "NONDERIV_TRANS_SK": str(n), "SECURITY_TITLE": "Common", "TRANS_DATE": "01-JAN-2030", "TRANS_CODE": "P", "TRANS_SHARES": "5"}
            for a, _ in rows for n in range(legs)]),
        "DERIV_TRANS.tsv": member("DERIV_TRANS.tsv", []),
    }


def test_insider_rounds_list_overlaps_and_empty_windows(world, read_windows):
    finish, land, run = world
    land("form345", "2025q1", "a" * 64, insider(("A", "02-JAN-2025"), ("B", "31-MAR-2025")))
    land("form345", "2025q2", "b" * 64, insider(("C", "31-MAR-2025"), ("D", "30-JUN-2025")))
    land("form345", "2025q3", "c" * 64, insider())
    finish("form345", "2025q1", "2025q2", "2025q3")
    found = run("form345").first()
    assert (found.windows, found.totalFilings, found.totalRows, found.futureDatedTransactions) == (3, 4, 4, 4)
    assert found.boundaryOverlaps == ["2025q1[2025-03-31] x 2025q2[2025-03-31]"] and found.transactionCodes == {"P": 4}
    assert found.unreceiptedRaw == []
    read_windows.clear()
    run("form345")
    assert read_windows == []  # an archive without rows is known as well
