import datetime as dt

import pytest
from pyspark.sql import functions as F

from filinglake.functions import dates, securities, text

# Filed text and the symbol it must give.
SYMBOLS = [
    ("AAPL", "AAPL"), ("BRK.B", "BRK.B"), ("GEF-B", "GEF-B"), (" msft ", "MSFT"), ("vicr", "VICR"),
    ('"""OMEX"""', "OMEX"), ("(SIRI)", "SIRI"), ("NYSE: KRC", "KRC"), ("NASDAQ:SVC", "SVC"),
    ("BF'B", "BF.B"), ("N O G", "NOG"), ("LEN, LEN.B", "LEN"), ("Z AND ZG", "Z"), ("BIO BIO.B", "BIO"),
    ("MOGA/MOGB", "MOGA"), ("GTII/GTBIF", "GTII"), ("MTLp", "MTLp"), ("CELGr", "CELGr"),
    (None, None), ("   ", None), ("none", None), ("n/a", None), ("1314152", None), ("GRAYBAR", None),
    ("NOT TRADED", None), ("BRK/B", "BRK/B"), ("A;B;C", "ABC"), (" IBM ", "IBM"), ("ABC/", None),
]


def test_issuer_ticker(values):
    assert values(securities.issuer_ticker, [s for s, _ in SYMBOLS]) == [t for _, t in SYMBOLS]


def test_text_strips_every_kind_of_space(values):
    assert values(text.text, ["  x y\t", "﻿a", " \t\r\n", "", None, "é", " é "]) == [
        "x y", "a", None, None, None, "é", "é",
    ]


@pytest.mark.parametrize(
    "cell, plain, commas",
    [
        ("1392", 1392.0, 1392.0), ("1,392", None, 1392.0), ("-1.5e3", -1500.0, -1500.0), (".5", 0.5, 0.5),
        ("5.", 5.0, 5.0), ("1d", None, None), ("NaN", None, None), ("Infinity", None, None),
        ("1e999", None, None), ("0x1F", 31.0, 31.0), ("", None, None), (",", None, None), ("1 2", None, None),
    ],
)
def test_number(values, cell, plain, commas):
    assert values(text.number, [cell]) == [plain]
    assert values(lambda x: text.number(text.without_commas(x)), [cell]) == [commas]


def test_number_broken_tells_blank_from_wrong(values):
    cells = ["", "12", "x", "1e999", ","]
    assert values(lambda x: text.number_broken(x, text.number(x)), cells) == [False, False, True, True, True]
    assert values(lambda x: text.number_broken(text.without_commas(x), text.parse_number(text.without_commas(x))), cells) == [
        False, False, True, True, False,
    ]


def test_flags(values):
    assert values(text.yes_no, ["y", "N", "", "yes"]) == [True, False, None, None]
    assert values(text.flag, ["1", "TRUE", "0", "false", "", "2"]) == [True, True, False, False, None, None]
    relation = ["Director, Officer", " ten percent owner ", "Directors", ""]
    assert values(lambda x: text.listed(x, "OFFICER"), relation) == [True, False, False, False]
    assert values(lambda x: text.listed(x, "TENPERCENTOWNER"), relation) == [False, True, False, False]
    assert values(lambda x: text.listed(x, "DIRECTOR"), relation) == [True, False, False, False]


def test_sec_dates(values):
    cells = ["31-OCT-2025", "1-jan-2024", "31-FEB-2024", "29-FEB-2024", "2024-01-01", "1-XXX-2024", "", "10-ANF-2024"]
    found = values(dates.sec_date, cells)
    assert found == [
        dt.date(2025, 10, 31), dt.date(2024, 1, 1), None, dt.date(2024, 2, 29), None, None, None, None,
    ]
    broken = values(lambda x: dates.sec_date_broken(x, dates.sec_date(x)), cells)
    assert broken == [False, False, True, False, True, True, False, True]


def test_xml_dates_ignore_the_zone(values):
    assert values(dates.xml_date, ["2026-09-08-05:00", "2026-02-30", "x", None]) == [
        dt.date(2026, 9, 8), None, None, None,
    ]


def test_end_of_day_follows_new_york(values):
    days = ["2026-03-31", "2025-12-15", "2026-03-08", "2026-11-01"]
    found = values(lambda x: dates.end_of_day_new_york(x.cast("date")).cast("string"), days)
    assert found == [
        "2026-04-01 03:59:59.999", "2025-12-16 04:59:59.999", "2026-03-09 03:59:59.999", "2026-11-02 04:59:59.999",
    ]


def test_acceptance_is_new_york_clock_time(values):
    found = values(lambda x: dates.available_after(dates.acceptance_instant(x)).cast("string"),
                   ["20260911120708", "20260111120708", "20261301000000", "2026"])
    assert found == ["2026-09-11 16:08:08", "2026-01-11 17:08:08", None, None]


def test_cusips(values):
    assert values(securities.cusip_of_isin, ["US15118V2079", "GB0002374006", "US123"]) == ["15118V207", None, None]
    assert values(securities.placeholder_cusip, ["000000000", "999999999", "N/A", "037833100", "909090909"]) == [
        True, True, True, False, False,
    ]


def test_shard_is_the_utc_year(values):
    found = values(lambda x: dates.available_year(dates.end_of_day_new_york(x.cast("date"))), ["2025-12-31", "2025-12-30"])
    assert found == [2026, 2025]
    assert values(lambda x: dates.utc_day(F.to_timestamp(x)).cast("string"), ["2026-04-01 03:59:59"]) == ["2026-04-01"]


def test_radix_numbers_of_any_length(values):
    from filinglake.functions import text

    cells = ["0xff", "0x" + "0" * 80 + "1", "0x" + "F" * 20, "0b" + "1" * 70, "0o7", "0x" + "f" * 400, "0X"]
    found = values(text.parse_number, cells)
    assert found[:2] == [255.0, 1.0] and found[4] == 7.0 and found[6] is None
    assert abs(found[2] / (2.0**80) - 1) < 1e-15 and abs(found[3] / 2.0**70 - 1) < 1e-15
    assert found[5] == float("inf")
    assert values(text.number, cells)[5] is None


def test_dates_with_months_in_any_case(values):
    from filinglake.functions import dates

    found = values(dates.sec_date, ["31-OCT-2025", "1-jan-2024", "29-Feb-2023", "31-ABC-2024", "1-13-2024", "", None, "29-feb-2024"])
    assert [str(d) if d else None for d in found] == ["2025-10-31", "2024-01-01", None, None, None, None, None, "2024-02-29"]
