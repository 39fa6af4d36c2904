"""The other findings of round 3: joins, lists and merges whose work grew faster than the input."""

import random

from pyspark.sql import functions as F
from rows import raw, table

from filinglake import schemas
from filinglake.operators import checks, crosswalk, figi, integrity, merge, normalize, spans
from filinglake.plans import file_merge


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_spans_are_met_in_one_join_of_holdings(spark):
    pick = random.Random(3)
    day = lambda: pick.choice([None, pick.randint(-400, 40_000)])
    some = [("A" if n % 3 else "B", f"T{pick.randint(0, 9)}", day(), day(), pick.randint(0, 150)) for n in range(500)]
    some += [("C", "open", None, None, 9), ("C", "day", 128, 128, 1), ("C", "bucket", 256, 383, 2), ("D", "late", 20_000, None, 1), ("E", "never", 9, 8, 1)]
    asked = [(c, d) for c in "ABCDEF" for d in [None, *range(-200, 500, 9), *range(16_000, 41_000, 611), 127, 128, 129, 255, 256, 383, 384, 2_900_000]]
    at = lambda name: F.date_add(F.lit("1970-01-01").cast("date"), F.col(name)).alias(name)
    listed = spark.createDataFrame(some, "cusip STRING, ticker STRING, fromDate INT, toDate INT, ord INT").select("cusip", "ticker", at("fromDate"), at("toDate"), "ord")
    held = spark.createDataFrame(asked, "cusip STRING, d INT").select("cusip", "d", at("d").cast("timestamp").alias("availableAt"), F.lit("old").alias("resolvedTicker"))

    def first(cusip, d):
        over = [(o, t) for c, t, a, z, o in some if c == cusip and d is not None and (a is None or a <= d) and (z is None or d <= z)]
        return min(over)[1] if over else None

    found = spans.resolve_tickers(held, listed)
    assert {(r.cusip, r.d): r.resolvedTicker for r in found.collect()} == {(c, d): first(c, d) for c, d in asked}
    # Holdings are neither multiplied nor reduced to their days and joined back.
    assert plan_of(found).count("Generate") == 1
    report = spans.ticker_report(held, listed).first()
    missed = [c for c, d in asked if first(c, d) is None]
    assert tuple(report) == (len(asked) - len(missed), len(missed), 1, sum(c != "F" for c in missed))


def test_a_list_of_repeats_ends_where_those_of_few_keys_do(spark, monkeypatch):
    pick = random.Random(5)
    rows = [{"window": "many" if n % 50 else "few", "accession": f"A{pick.randint(0, 40)}", "infoTableSk": str(pick.randint(0, 30))} for n in range(3000)]
    held = table(spark, "institutional_holdings", rows)
    filed = spark.createDataFrame([(w, f"A{n}") for w in ("many", "few") for n in range(0, 41, 2)], "window STRING, accession STRING")
    seen, want = set(), {"many": [], "few": []}
    for row in rows:
        key = tuple(row.values())
        if key in seen and int(row["accession"][1:]) % 2 == 0:
            want[row["window"]].append(f"{row['accession']}/{row['infoTableSk']}")
        seen.add(key)
    monkeypatch.setattr(integrity, "PILOT", 4)
    repeats = integrity.repeated_keys(held, "ord", filed)
    assert repeats.filter("window = 'many'").count() < len(want["many"]) / 2
    lists = {r.window: r.l for r in integrity._first(repeats, ["window"], "entry", "_ord", "l").collect()}
    assert lists == {w: l[:20] for w, l in want.items() if l}


def test_the_row_that_speaks_for_a_security_is_sent_once(spark):
    rows = [("a", "GR", " t1", "F1", None, "x", 1), ("a", "US", None, "F1", "own", "y", 3), ("a", "US", " t3 ", "F2", None, "z", 2), ("b", "GR", "q", None, None, "w", 2), ("b", None, "p", "", "own", "v", 1)]
    venues = spark.createDataFrame(rows, "cusip STRING, exchCode STRING, ticker STRING, shareClassFIGI STRING, securityType STRING, name STRING, ord INT")
    found = figi.share_class(venues.withColumns({"securityType2": F.lit("two"), "marketSector": F.lit("Equity")}))
    assert sorted(map(tuple, found.collect())) == [
        ("a", "F1", "T3", ["T1", "T3"], "two", "Equity", "z", 3), ("b", None, None, ["P", "Q"], "own", "Equity", "v", 2)]
    assert plan_of(found).count("min_by(") == 1  # of the FIGI counts alone


def test_cells_of_a_submission_are_read_after_its_last_row_is_known(spark):
    columns = ["ACCESSION_NUMBER", "FILING_DATE", "DOCUMENT_TYPE", "ISSUERCIK", "ISSUERNAME", "ISSUERTRADINGSYMBOL", "PERIOD_OF_REPORT", "DATE_OF_ORIG_SUB", "AFF10B5ONE"]
    cells = {"ACCESSION_NUMBER": "A", "FILING_DATE": "31-MAR-2026", "DOCUMENT_TYPE": "4", "ISSUERCIK": "7", "ISSUERTRADINGSYMBOL": "none"}
    facts = normalize._submission_facts(raw(spark, columns, [cells, {**cells, "ISSUERTRADINGSYMBOL": "NYSE: EX", "PERIOD_OF_REPORT": "x"}]))
    (row,) = facts.collect()
    assert (row.resolved_symbol, row.issuer_symbol, row.known, row.period_broken, row.original_broken, str(row.filing_day)) == ("EX", "NYSE: EX", True, True, False, "2026-03-31")
    assert plan_of(facts.select("form_type")).count("RLIKE") == 0  # no symbol is resolved where none is asked for


def test_rows_and_rejects_can_be_counted_in_one_pass(spark):
    rows = spark.createDataFrame([("a", "1"), ("b", ""), ("c", "3")], "k STRING, v STRING")
    checked = checks.split_broken("t", rows, {"no v": F.col("v") == ""}, {"v": F.col("v")}, F.col("k"))
    assert sorted(map(tuple, checked.verdicts.collect())) == [(False, "a"), (False, "c"), (True, "b")]
    assert checked.rows.count() == 2 and checked.rejects.first().sample == "b"


def test_a_merge_reads_the_sources_of_each_side_once(spark, tmp_path, monkeypatch):
    calls = []
    sources = merge.sources
    monkeypatch.setattr(merge, "sources", lambda *tables: calls.append(1) or sources(*tables))
    filings, legs = table(spark, "insider_filings", [{}, {"ownerCik": "3"}]), table(spark, "insider_transactions", [{}, {"rowSk": "2"}, {"accession": "B"}])
    for _ in range(2):
        calls.clear()
        merged = file_merge.merge_insider(spark, str(tmp_path), filings, legs)
        assert len(calls) == 2
    assert (merged.rows("insider_filings").count(), merged.rows("insider_transactions").count()) == (2, 3)
    found = sources(filings, legs.withColumn("availabilitySource", F.when(F.col("accession") == "B", F.lit(None)).otherwise(F.lit("z"))))
    assert {r.accession: (r.source, r.other, r.missing) for r in found.collect()} == {"A-1": (schemas.SOURCE_345_DATASET, "z", False), "B": (None, None, True)}


def test_one_fold_of_identifiers_serves_counts_and_join(spark):
    names = "archive_key STRING, ord INT, malformed BOOLEAN, "
    held = spark.createDataFrame([("h", 1, False, "1", "C00000001", "n"), ("h", 2, True, None, None, None)], names + "HOLDING_ID STRING, ISSUER_CUSIP STRING, ISSUER_NAME STRING")
    marks = spark.createDataFrame([("i", 1, False, "1", "t", ""), ("i", 2, False, "1", "", "GB0002374006")], names + "HOLDING_ID STRING, IDENTIFIER_TICKER STRING, IDENTIFIER_ISIN STRING")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        stats = crosswalk.crosswalk_stats(held, marks)
        assert "ReusedExchange" in stats._jdf.queryExecution().executedPlan().toString()
        assert tuple(stats.first()) == (2, 2, 1, 1, 1, 0, 0, 1)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
