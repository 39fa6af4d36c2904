import json

from filinglake import schemas
from filinglake.operators import crosswalk, figi, ranks
from filinglake.sources import figi as responses
from filinglake.sources import tsv

H = ["ACCESSION_NUMBER", "HOLDING_ID", "ISSUER_NAME", "ISSUER_CUSIP"]
I = ["HOLDING_ID", "IDENTIFIER_ISIN", "IDENTIFIER_TICKER"]


def member(spark, header, rows, columns):
    lines = ["\t".join(header), *["\t".join(r) for r in rows]]
    df = spark.createDataFrame([("f", n, line) for n, line in enumerate(lines)], "archive_key STRING, ord LONG, line STRING")
    return tsv.strict_records(df, columns)


def build(spark, holdings, identifiers):
    h = member(spark, H, holdings, schemas.MEMBERS_NPORT["FUND_REPORTED_HOLDING.tsv"])
    i = member(spark, I, identifiers, schemas.MEMBERS_NPORT["IDENTIFIERS.tsv"])
    pairs = crosswalk.build_pairs(h, i, "nport:2026q2").orderBy("cusip", "ticker").collect()
    return [tuple(p) for p in pairs], crosswalk.crosswalk_stats(h, i).first().asDict()


def test_identifiers_on_separate_rows_fold_to_the_last_non_blank(spark):
    pairs, stats = build(
        spark,
        [["a", "1", "Celsius", "15118v207"], ["b", "2", "no ticker", "037833100"]],
        [["1", "US15118V2079", ""], ["1", "", "old"], ["1", "", "celh"], ["2", "US0378331005", ""], ["", "", "X"]],
    )
    assert pairs == [("15118V207", "CELH", "Celsius", "US15118V2079", "nport:2026q2")]
    assert (stats["holdingsWithTicker"], stats["holdingRows"], stats["identifierRows"]) == (1, 2, 5)


def test_mismatch_placeholder_and_shifted_rows_are_counted_not_paired(spark):
    pairs, stats = build(
        spark,
        [["a", "1", "Akamai", "037833100"], ["b", "2", "Cash", "000000000"], ["c", "3", "None", "N/A"],
         ["d", "4", "Apple\tInc", "037833100"], ["e", "5", "Foreign", "123456789"]],
        [["1", "US00971T1016", "AKAM"], ["2", "", "CASH"], ["3", "", "NA"], ["4", "", "AAPL"], ["5", "GB0002374006", "FOR"], ["6", "", "a\tb"]],
    )
    assert [p[:2] for p in pairs] == [("123456789", "FOR")]
    assert (stats["isinMismatches"], stats["placeholderCusips"], stats["fieldCountMismatches"]) == (1, 2, 2)


def test_one_pair_however_many_holdings_and_the_first_names_it(spark):
    holdings = [["a", "1", "Apple Inc", "037833100"], ["b", "2", "APPLE", "037833100"], ["c", "3", "Apple C", "037833100"]]
    pairs, stats = build(spark, holdings, [["1", "", "AAPL"], ["2", "", "aapl"], ["3", "", "AAPL2"]])
    assert [p[:3] for p in pairs] == [("037833100", "AAPL", "Apple Inc"), ("037833100", "AAPL2", "Apple C")]
    assert (stats["pairs"], stats["distinctCusips"]) == (2, 1)


def venues():
    return [
        {"exchCode": "GR", "ticker": "tweur", "shareClassFIGI": "S2", "name": "first", "securityType2": "Family"},
        {"exchCode": "US", "ticker": " twtr ", "shareClassFIGI": "S1", "name": "us", "securityType": "Common", "marketSector": "Equity"},
        {"exchCode": "LN", "shareClassFIGI": "S1"},
        {"exchCode": "SW", "ticker": "twtr", "shareClassFIGI": "S2"},
    ]


def test_responses_pair_by_position_and_take_the_mode(spark):
    body = json.dumps([{"data": venues()}, {"warning": "No identifier found."}, {"data": venues()[:1]}])
    df = spark.createDataFrame([(["A", "B", "C"], body), (["X", "Y"], body)], "request ARRAY<STRING>, response STRING")
    read = responses.ingest_figi(df)
    a, b, c = read.rows.orderBy("cusip").collect()
    assert (a.shareClassFigi, a.usTicker, a.tickers, a.securityType, a.name, a.venueRows) == ("S1", "TWTR", ["TWEUR", "TWTR"], "Common", "us", 4)
    assert (b.outcome, b.shareClassFigi, b.tickers, b.venueRows) == ("not_found", None, [], 0)
    assert (c.usTicker, c.securityType, c.name) == (None, "Family", "first")
    assert read.rejects.count() == 1


def test_table_form_agrees_with_the_response_form(spark):
    cells = ("exchCode", "ticker", "name", "shareClassFIGI", "securityType", "securityType2", "marketSector")
    rows = [("A", n, *[v.get(c) for c in cells]) for n, v in enumerate(venues())]
    df = spark.createDataFrame(rows, "cusip STRING, ord LONG, " + ", ".join(f"{c} STRING" for c in cells))
    (got,) = figi.share_class(df).collect()
    assert (got.shareClassFigi, got.usTicker, got.tickers, got.securityType, got.name, got.venueRows) == (
        "S1", "TWTR", ["TWEUR", "TWTR"], "Common", "us", 4,
    )


def test_batches_hold_each_cusip_once(spark):
    df = spark.createDataFrame([(f"C{n % 37:02d}",) for n in range(500)], "cusip STRING")
    one = figi.lookup_batches(df, 10).orderBy("batch").collect()
    assert [len(r.cusips) for r in one] == [10, 10, 10, 7] and one[0].cusips[0] == "C00"
    spread = figi.lookup_batches(df, 10).orderBy("batch").collect()
    assert [c for r in spread for c in r.cusips] == [f"C{n:02d}" for n in range(37)]
    small = ranks.batches(df, "cusip", 10, part_rows=5).orderBy("batch").collect()
    assert [(r.batch, r.cusip) for r in small] == [(r.batch, r.cusips) for r in spread]
    many = [c for r in figi.lookup_batches(df, 10, buckets=4).collect() for c in r.cusips]
    assert sorted(many) == sorted({f"C{n:02d}" for n in range(37)})
