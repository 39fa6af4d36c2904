"""The index-driven refresh: listing, landing and limits in any order, restarts, reports."""

import hashlib

import pytest
from test_sources import LEGS, submission

from filinglake.operators.checks import BrokenRows
from filinglake.sinks import lake, versions
from filinglake.sources import manifest
from filinglake.streaming import daily

HEAD = "Form Type   Company Name   CIK   Date Filed   File Name\n" + "-" * 80 + "\n"


@pytest.fixture
def paths(tmp_path):
    for name in ("index", "submissions"):
        (tmp_path / name).mkdir()
    return daily.DailyPaths(*[str(tmp_path / n) for n in ("index", "submissions", "lake", "state")])


def list_day(paths, day, *accessions, form="4", text=None):
    lines = "".join(f"{form:<17}Acme Inc    7   {day}   edgar/data/7/{a}.txt\n" for a in accessions)
    with open(f"{paths.index}/form.{day}.idx", "w") as target:
        target.write(text if text is not None else HEAD + lines)


def land(paths, name, text):
    with open(f"{paths.submissions}/{name}.txt", "w") as target:
        target.write(text)


def held(spark, paths):
    return sorted(r.accession for r in versions.snapshot(spark, paths.lake).rows("insider_filings").select("accession").distinct().collect())


def told(done):
    return done.listed, done.processed, done.deferred, sorted((r.accession, r.reason) for r in done.failures.collect()), done.unpublished


def test_an_index_before_with_and_after_its_documents(spark, paths):
    list_day(paths, "20260910", "A", "B")
    land(paths, "B", submission("B", body=LEGS))
    land(paths, "C", submission("C"))
    assert told(daily.run_daily(spark, paths, 10, ["20260910", "20260911"])) == (2, 2, 0, [("A", "not landed")], ["20260911"])
    assert held(spark, paths) == ["B"]
    land(paths, "A", submission("A"))
    land(paths, "D", submission("D", owners=0))
    list_day(paths, "20260911", "B", "C", "D")
    list_day(paths, "20260912", text="not an index")
    done = daily.run_daily(spark, paths, 10, ["20260910", "20260911"])
    assert (done.listed, done.processed, done.deferred, done.unpublished) == (4, 3, 0, [])
    failures = {r.accession.rsplit("/")[-1]: r.reason for r in done.failures.collect()}
    assert failures == {"D": "reportingOwner", "form.20260912.idx": "index separator"}
    assert held(spark, paths) == ["A", "B", "C"]
    # The document that failed is offered again, and a good copy of it is taken.
    assert told(daily.run_daily(spark, paths, 10)) == (1, 1, 0, [("D", "reportingOwner")], [])
    land(paths, "D-again", submission("D", body=LEGS))
    assert told(daily.run_daily(spark, paths, 10)) == (1, 1, 0, [], [])
    assert told(daily.run_daily(spark, paths, 10)) == (0, 0, 0, [], [])
    now = versions.snapshot(spark, paths.lake)
    assert held(spark, paths) == ["A", "B", "C", "D"] and now.rows("insider_transactions").count() == 6
    assert now.rows("insider_filings").count() == 8


def test_a_limit_defers_and_a_stopped_pass_is_done_again(spark, paths, monkeypatch):
    list_day(paths, "20260910", "X", "A", "B", "C")
    list_day(paths, "20260911", "K", form="10-K")
    for name in "ABC":
        land(paths, name, submission(name, body=LEGS))
    # What isn't landed doesn't hold up what is.
    assert told(daily.run_daily(spark, paths, 1)) == (4, 1, 3, [], []) and held(spark, paths) == ["A"]
    note = daily._note

    def stopped(*_):
        raise OSError("stopped before the note")

    monkeypatch.setattr(daily, "_note", stopped)
    with pytest.raises(OSError):
        daily.run_daily(spark, paths, 1)
    monkeypatch.setattr(daily, "_note", note)
    assert held(spark, paths) == ["A", "B"]
    assert told(daily.run_daily(spark, paths, 9)) == (3, 2, 0, [("X", "not landed")], [])
    now = versions.snapshot(spark, paths.lake)
    assert held(spark, paths) == ["A", "B", "C"] and now.rows("insider_transactions").count() == 9
    assert lake.remove(spark, []) is None


def test_a_slice_is_verified_by_its_own_files(spark, tmp_path):
    root = tmp_path / "data"
    (root / "insider" / "2020").mkdir(parents=True)
    rows = []
    for year, name, text in ((2020, "a", "one"), (2020, "b", "two"), (2020, "c", None), (2021, "d", "four")):
        path = f"data/insider/{year}/{name}.parquet"
        rows.append(("s", "insider_filings", year, path, len(text or ""), hashlib.sha256((text if text != "two" else "x").encode() if text else b"").hexdigest()))
        if text and year == 2020:
            (tmp_path / path).write_text(text)
    (root / "insider" / "2020" / "unlisted.parquet").write_text("?")
    files = spark.createDataFrame(rows, "snapshot_id STRING, table STRING, year INT, publicPath STRING, size LONG, sha256 STRING")
    found = {r.publicPath[-9:]: r.status for r in manifest.verify_slice(spark, files, str(tmp_path), "insider_filings", 2020).collect()}
    assert found == {"a.parquet": "ok", "b.parquet": "different", "c.parquet": "missing"}
    assert [r.path for r in manifest.slice_contents(spark, str(tmp_path), files.where("year = 2020")).select("path").orderBy("path").collect()] == [
        "data/insider/2020/a.parquet", "data/insider/2020/b.parquet"]
    assert [r.status for r in manifest.verify_slice(spark, files, str(tmp_path), year=2021).collect()] == ["missing"]
    with pytest.raises(BrokenRows):
        manifest.verify_slice(spark, files, str(tmp_path), "insider_filings", 1999)
