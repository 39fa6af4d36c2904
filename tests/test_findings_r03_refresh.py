"""F14 of round 3: the daily refresh read its index twice, and made and shuffled texts that nobody asked for."""

from pyspark.sql import functions as F
from test_sources import LEGS, docs, submission

from filinglake.catalog.registry import all_queries
from filinglake.functions import dates, securities
from filinglake.sources import daily_index, submissions


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_documents_are_made_for_listed_entries_alone(spark):
    rows = all_queries()["t1_daily_refresh"].run(spark, "/root/testdata/sf0.001")
    plan = plan_of(rows)
    assert "SEC-HEADER" in plan and "event_id" not in plan  # the index has been read, once
    assert "SEC-HEADER" not in plan.split("Join LeftSemi")[1]  # no text below the choice of documents
    listed = [(r.accession, r.listed) for r in rows.select("accession", "listed").distinct().collect()]
    assert listed and len(dict(listed)) == len(listed) and {form for _, form in listed} == {"3/A", "4", "5"}


def test_a_text_is_made_once_whatever_is_asked_of_its_accession(spark):
    parts = docs(spark, submission(body=LEGS), submission("0002", owners=1)).select(
        "archive_key", F.concat(F.substring("raw", 1, 40), F.expr("substring(raw, 41)")).alias("raw"))
    wanted = spark.createDataFrame([("0001-26-1",), ("0003",)], "accession STRING")
    found = submissions.parse_submissions(parts).filings.join(wanted, "accession")
    assert sorted(r.ownerCik for r in found.collect()) == ["1", "2"]
    assert plan_of(found).count("substring(raw") <= 2  # in the text, not in a filter below it
    assert "ACCESSION NUMBER:" not in "".join(line for line in plan_of(found).splitlines() if "Filter" in line)


def test_filings_judge_the_cells_of_legs_and_make_none(spark):
    read = submissions.parse_submissions(docs(spark, submission(body=LEGS), submission("0002", body=LEGS.replace("2026-09-10", "2026-13-10"))))
    assert {r.accession for r in read.filings.collect()} == {"0001-26-1"} and read.transactions.count() == 3
    assert [r.broken for r in read.rejects.collect()] == [["transaction cell"]]
    assert "rowSk" not in plan_of(read.filings) and "rowSk" in plan_of(read.transactions)


def test_a_body_stands_between_the_first_tags_in_order(spark):
    opened, closed = "<ownershipDocument", "</ownershipDocument>"
    good = submission()
    texts = [good, closed + good, good.replace(closed, ""), good.replace(opened, "<other"), good + submission("0002"), opened + ">" + good, None]
    read = submissions.parse_submissions(docs(spark, *texts))
    missing = {int(r.archive_key[4:-4]) for r in read.rejects.collect() if "ownershipDocument" in r.broken}
    assert {r.rawArchiveKey for r in read.filings.collect()} == {"raw/0.txt", "raw/4.txt"} and missing == {1, 2, 3}


def test_short_ways_read_the_same(values, monkeypatch):
    cells = ["KRC", "AND", "AND.B", "ANDA", "AND/B", "BRK/B", "N/AA", "N/AA\u0085", "KRC\u0085", "NA", "n/a", "NYSE: krc", "É", "ß", "A B C", "(brk.b)", "O'B", "ABCDEF", "", None]
    short = values(securities.issuer_ticker, cells)
    monkeypatch.setattr(securities, "_ONE_TOKEN", r"^\b\B")
    assert short == values(securities.issuer_ticker, cells) and short[:4] == ["KRC", None, None, "ANDA"]
    clocks = ["20260911120708", "20261311120708", "20260911", "2026091112070a", "", None]
    assert values(lambda c: dates.acceptance_instant(c).cast("string"), clocks) == ["2026-09-11 16:07:08"] + [None] * 5
    assert [str(day) for day in values(dates.compact_date, clocks[:3])] == ["None", "None", "2026-09-11"]


def test_separators_of_few_files_are_found_once(spark, monkeypatch):
    body = [(f"{n}.idx", k, text) for n in range(3) for k, text in enumerate(
        ["head", "-" * 19 if n == 2 else "-" * 20 + " ", f"4                Acme  1304492     20260911    edgar/data/1/000{n}.txt", " ", "garbage"])]
    lines = spark.createDataFrame(body, "archive_key STRING, ord LONG, line STRING")
    read = daily_index.read_index(lines)
    assert "strategy=broadcast" in plan_of(read.rows) and "Aggregate" not in plan_of(read.rows)
    few = sorted(map(tuple, read.rows.collect())), sorted(map(str, read.rejects.collect()))
    monkeypatch.setattr(daily_index, "BROADCAST_FILES", 2)
    many = daily_index.read_index(lines)
    assert "Aggregate" in plan_of(many.rows)
    assert (sorted(map(tuple, many.rows.collect())), sorted(map(str, many.rejects.collect()))) == few and len(few[0]) == 2 and len(few[1]) == 3
