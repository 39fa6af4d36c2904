import pytest
from pyspark.sql import functions as F
from test_sources import COVER, INFO, LEGS, SUB, submission, zipped

from filinglake.sinks import lake
from filinglake.streaming import backfill, refresh


@pytest.fixture
def paths(tmp_path):
    (tmp_path / "landing").mkdir()
    names = ("landing", "lake", "checkpoint", "rejects")
    return refresh.RefreshPaths(*[str(tmp_path / n) for n in names])


def land(paths, name, text):
    with open(f"{paths.landing}/{name}.txt", "w") as target:
        target.write(text)


def accessions(spark, paths):
    return sorted(r.accession for r in lake.read_table(spark, "insider_filings", paths.lake).select("accession").distinct().collect())


def test_refresh_resumes_and_offers_rejects_again(spark, paths):
    land(paths, "a", submission("A", body=LEGS))
    land(paths, "bad", submission("B", owners=0))
    refresh.run_refresh(spark, paths, max_files=1)
    assert accessions(spark, paths) == ["A"]
    assert [r.accession for r in spark.read.parquet(paths.rejects).collect()] == ["B"]
    # A second run only sees what is new; the reject is tried again and stays.
    land(paths, "c", submission("C", accepted="20251231190000"))
    land(paths, "a-copy", submission("A", body=LEGS))
    refresh.run_refresh(spark, paths, max_files=10)
    assert accessions(spark, paths) == ["A", "C"]
    assert lake.read_table(spark, "insider_transactions", paths.lake).count() == 3
    assert [r.accession for r in spark.read.parquet(paths.rejects).collect()] == ["B"]


def test_backfill_records_each_archive_once(spark, tmp_path):
    prefix = "raw/sec13f/datasets"
    folder = tmp_path / prefix / "2026q1"
    folder.mkdir(parents=True)
    zipped(folder / ("a" * 64 + ".zip"), {"SUBMISSION.tsv": SUB, "COVERPAGE.tsv": COVER, "INFOTABLE.tsv": INFO})
    args = dict(dataset="form13f", landing=str(tmp_path / prefix), root=str(tmp_path / "lake"), bronze=str(tmp_path / "bronze"),
                ledger=str(tmp_path / "ledger"), round_id="r1", prefix=prefix)
    backfill.run_backfill(spark, **args)
    backfill.run_backfill(spark, **args)
    (row,) = backfill.read_ledger(spark, str(tmp_path / "ledger")).collect()
    assert (row.roundId, row.identity) == ("r1", "form13f:2026q1")
    assert '"filings":1,"rows":1' in row.body
    assert lake.read_table(spark, "institutional_holdings", str(tmp_path / "lake")).count() == 1


def test_backfill_redoes_dropped_rows_and_isolates_a_bad_archive(spark, tmp_path):
    prefix = "raw/sec13f/datasets"
    for n, quarter in enumerate(("2026q1", "2026q2", "2026q3")):
        folder = tmp_path / prefix / quarter
        folder.mkdir(parents=True)
        sub = SUB.replace("31-", "99-") if quarter == "2026q2" else SUB
        sub = sub if sub != SUB or quarter != "2026q2" else SUB.replace("-20", "-x0")
        zipped(folder / (f"{n}" * 64 + ".zip"), {"SUBMISSION.tsv": sub, "COVERPAGE.tsv": COVER, "INFOTABLE.tsv": INFO})
    args = dict(dataset="form13f", landing=str(tmp_path / prefix), root=str(tmp_path / "lake"), bronze=str(tmp_path / "bronze"),
                ledger=str(tmp_path / "ledger"), prefix=prefix)
    refused = backfill.run_backfill(spark, round_id="r1", **args)
    assert list(refused) == ["form13f:2026q2"]
    done = lambda: sorted((r.roundId, r.identity) for r in backfill.read_ledger(spark, args["ledger"]).collect())
    assert done() == [("r1", "form13f:2026q1"), ("r1", "form13f:2026q3")]
    backfill.drop_finished(spark, args["ledger"], "r1", F.col("identity") != "form13f:2026q1")
    assert done() == [("r1", "form13f:2026q3")]
    backfill.run_backfill(spark, round_id="r1", **args)
    backfill.run_backfill(spark, round_id="r2", **args)
    assert done() == [(r, f"form13f:2026q{q}") for r in ("r1", "r2") for q in (1, 3)]
    rounds = {r["round"] for r in spark.read.parquet(args["bronze"]).select("round").distinct().collect()}
    assert rounds == {"r1", "r2"}


def test_refresh_keeps_all_legs_when_it_stops_between_the_tables(spark, paths, monkeypatch):
    land(paths, "a", submission("A", body=LEGS))
    publish, calls = lake.publish_stage, []

    def failing(*args):
        calls.append(args[2])
        if len(calls) == 2:
            raise OSError("stopped between the tables")
        return publish(*args)

    monkeypatch.setattr(lake, "publish_stage", failing)
    with pytest.raises(Exception):
        refresh.run_refresh(spark, paths)
    monkeypatch.setattr(lake, "publish_stage", publish)
    for _ in range(2):
        refresh.run_refresh(spark, paths)
    assert accessions(spark, paths) == ["A"]
    assert lake.read_table(spark, "insider_transactions", paths.lake).count() == 3


def test_refresh_takes_the_good_copy(spark, paths):
    land(paths, "1", submission("A", owners=0))
    land(paths, "2", submission("A", body=LEGS))
    refresh.run_refresh(spark, paths)
    assert accessions(spark, paths) == ["A"]
    assert lake.read_table(spark, "insider_transactions", paths.lake).count() == 3
    assert [r.archive_key.rsplit("/")[-1] for r in spark.read.parquet(paths.rejects).collect()] == ["1.txt"]
