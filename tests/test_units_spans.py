import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from rows import table

from filinglake.operators import quantiles, spans, units


def filings(spark, *pairs):
    return table(spark, "institutional_filings", [{"accession": a, "filingDate": dt.date.fromisoformat(d)} for a, d in pairs])


def holdings(spark, rows):
    return table(spark, "institutional_holdings", [
        {"accession": a, "infoTableSk": str(n), "value": v, "sharesAmount": s, **(more[0] if more else {})}
        for n, (a, v, s, *more) in enumerate(rows)
    ]).drop("window", "ord")


def decide(spark, dated, rows):
    f, h = filings(spark, *dated), holdings(spark, rows)
    found = units.to_dollars(f, h, "ord").orderBy("accession", "infoTableSk").collect()
    return [(r.value, r.valueUnitSource) for r in found], units.value_report(f, h, "ord").first().asDict()


def test_date_decides_when_rows_are_few(spark):
    got, report = decide(spark, [("A", "2022-12-31"), ("B", "2023-01-01")], [("A", 7.0, 1.0), ("B", 7.0, 1.0), ("C", 42.0, 1.0), ("A", None, 1.0)])
    assert got == [(7000.0, "date"), (None, None), (7.0, "date"), (42.0, "unknown")]
    assert report == {"scaled": 1, "untouched": 1, "unresolvedFilingDate": 1, "overrodeDate": 0, "decidedByDateAlone": 2}


def test_dollars_before_the_change_and_thousands_after_it(spark):
    early = [("A", 170.0 * k, 10.0) for k in range(1, 6)]  # 17 and more a share: not thousands
    late = [("B", 0.04 * k, 1.0) for k in range(1, 6)]  # a few cents a share: not dollars
    got, report = decide(spark, [("A", "2013-12-09"), ("B", "2024-05-15")], early + late)
    assert [s for _, s in got] == ["median"] * 10
    assert got[0][0] == 170.0 and got[5][0] == pytest.approx(40.0)
    assert (report["overrodeDate"], report["scaled"], report["untouched"]) == (2, 5, 5)


def test_only_ordinary_share_rows_judge(spark):
    rows = [("A", 1.0, 1000.0, {"sharesType": "PRN"})] * 3 + [("A", 1.0, 1000.0, {"putCall": "Put"})] * 3
    rows += [("A", 0.0, 10.0), ("A", 5.0, 0.0)] + [("A", 900.0, 10.0, {"putCall": ""})] * 4
    _, report = decide(spark, [("A", "2024-05-15")], rows)
    assert report["decidedByDateAlone"] == 1


def test_thresholds_follow_the_upper_median(spark):
    """Counting on each side of a threshold agrees with sorting, ties and even counts included."""
    random.seed(5)
    dated, rows, want = [], [], {}
    for n in range(120):
        early = n % 2 == 0
        edge = 5.0 if early else 0.5
        prices = [random.choice([edge, edge * 0.5, edge * 2, edge * random.random() * 2 + 1e-9]) for _ in range(random.randint(5, 9))]
        middle = sorted(prices)[len(prices) // 2]
        flipped = middle > 5 if early else middle < 0.5
        key = f"F{n:03d}"
        dated.append((key, "2020-01-01" if early else "2024-01-01"))
        rows += [(key, p, 1.0) for p in prices]
        want[key] = early != flipped
    found = units.unit_decisions(filings(spark, *dated), holdings(spark, rows), "ord").collect()
    assert {r.accession: r.scaled for r in found} == want


def test_converted_rows_are_refused(spark):
    h = holdings(spark, [("A", 1.0, 1.0, {"valueUnitSource": "date"})])
    with pytest.raises(Exception, match="already converted"):
        units.to_dollars(filings(spark, ("A", "2020-01-01")), h, "ord").collect()


def test_exact_order_statistics(spark):
    random.seed(2)
    data = {k: [round(random.lognormvariate(0, 3), 3) * random.choice([1, 1, 1, -1, 0]) for _ in range(n)] for k, n in (("a", 501), ("b", 2), ("c", 1), ("d", 800))}
    data["d"] += [7.25] * 400  # a third of the group in one value
    df = spark.createDataFrame([(k, v) for k, vs in data.items() for v in vs], "k STRING, v DOUBLE")
    got = {r.k: (r.n, r.m) for r in quantiles.upper_median(df, "k", "v", "m").collect()}
    assert got == {k: (len(v), sorted(v)[len(v) // 2]) for k, v in data.items()}
    days = spark.createDataFrame([(k, int(v) % 40) for k, vs in data.items() for v in vs], "k STRING, v INT")
    got = {r.k: (r.p50, r.p95, r.max) for r in quantiles.floor_quantiles(days, ["k"], "v", {"p50": 0.5, "p95": 0.95, "max": 1.0}).collect()}
    for k, vs in data.items():
        levels = sorted(int(v) % 40 for v in vs)
        at = [levels[min(len(levels) - 1, int(q * len(levels)))] for q in (0.5, 0.95, 1.0)]
        assert got[k] == tuple(at)


def span_table(spark, rows):
    ddl = "cusip STRING, ticker STRING, fromDate DATE, toDate DATE, ord LONG"
    return spark.createDataFrame([(*r, n) for n, r in enumerate(rows)], ddl)


def held(spark, *pairs):
    return table(spark, "institutional_holdings", [
        {"cusip": c, "availableAt": dt.datetime.fromisoformat(d), "infoTableSk": str(n), "resolvedTicker": "STALE"} for n, (c, d) in enumerate(pairs)
    ]).drop("window", "ord")


D = dt.date
RENAMED = [("30303M102", "FB", D(2012, 5, 18), D(2022, 6, 8)), ("30303M102", "META", D(2022, 6, 9), None)]


def test_span_of_the_rows_own_day(spark):
    h = held(spark, ("30303M102", "2013-08-14"), (" 30303m102 ", "2024-02-14"), ("30303M102", "2010-01-04"), ("999", "2020-01-01"),
             ("30303M102", "2022-06-09T03:59:59.999"))
    s = span_table(spark, RENAMED)
    found = spans.resolve_tickers(h, s).orderBy("infoTableSk").collect()
    # The last row is filed on FB's last day and known after midnight UTC: the next span's day.
    assert [r.resolvedTicker for r in found] == ["FB", "META", None, None, "META"]
    report = spans.ticker_report(h, s).first().asDict()
    assert report == {"resolved": 3, "unresolved": 2, "unresolvedCusips": 1, "outsideEverySpan": 1}


def test_first_span_wins_case_is_kept_and_blanks_do_not_count(spark):
    s = span_table(spark, [(" x1 ", "  ", None, None), ("X1", "MTLp", None, None), ("X1", "LATER", None, None)])
    assert [r.resolvedTicker for r in spans.resolve_tickers(held(spark, ("x1", "2020-01-01")), s).collect()] == ["MTLp"]


@pytest.mark.parametrize("number", [1, 16, 17, 500])
def test_any_number_of_spans_with_shared_orders_and_far_days(spark, number):
    random.seed(number)
    days = [D(1, 1, 1), D(1600, 2, 29), D(1849, 12, 31), D(1850, 1, 1), D(2000, 1, 1), D(2208, 11, 1), D(2301, 6, 1), D(9000, 1, 1)]

    def near():
        return random.choice(days) + dt.timedelta(days=random.randint(0, 400))

    rows = []
    for n in range(number):
        ends = sorted((near(), near()))
        rows.append(("C", f"T{n:03}", random.choice([None, ends[0]]), random.choice([None, ends[1]]), random.randint(0, 5)))
    s = spark.createDataFrame(rows, "cusip STRING, ticker STRING, fromDate DATE, toDate DATE, ord LONG")
    asked = [near() for _ in range(60)]
    want = []
    for at in asked:
        hits = [(o, t) for _, t, lo, hi, o in rows if (lo is None or lo <= at) and (hi is None or at <= hi)]
        want.append(min(hits)[1] if hits else None)
    own_day = F.element_at(F.array(*[F.lit(day.isoformat()).cast("timestamp") for day in asked]), F.col("infoTableSk").cast("int") + 1)
    h = held(spark, *[("C", "2020-01-01") for _ in asked]).withColumn("availableAt", own_day)
    found = spans.resolve_tickers(h, s).select("infoTableSk", "resolvedTicker").collect()
    assert {int(r.infoTableSk): r.resolvedTicker for r in found} == dict(enumerate(want))


def test_spans_agree_with_brute_force(spark):
    random.seed(9)
    start = D(2015, 1, 1)
    rows = []
    for n in range(300):
        low = None if random.random() < 0.1 else start + dt.timedelta(days=random.randint(0, 900))
        high = None if random.random() < 0.1 else (low or start) + dt.timedelta(days=random.randint(-3, 120))
        rows.append((random.choice(["HOT"] * 3 + ["B", "C", "E"]), f"T{n}", low, high))
    asked = [(random.choice(["HOT", "B", "C", "E", "NONE"]), (start + dt.timedelta(days=random.randint(-30, 1100))).isoformat()) for _ in range(400)]
    want = []
    for cusip, day in asked:
        at = D.fromisoformat(day)
        hit = [t for c, t, lo, hi in rows if c == cusip and (lo is None or lo <= at) and (hi is None or at <= hi)]
        want.append(hit[0] if hit else None)
    found = spans.resolve_tickers(held(spark, *asked), span_table(spark, rows)).collect()
    assert {int(r.infoTableSk): r.resolvedTicker for r in found} == dict(enumerate(want))
