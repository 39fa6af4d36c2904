import datetime as dt

import pytest
from rows import raw

from filinglake import schemas
from filinglake.operators import normalize
from filinglake.operators.checks import BrokenRows

SUB = schemas.member_columns(schemas.MEMBERS_13F["SUBMISSION.tsv"])
COVER = schemas.member_columns(schemas.MEMBERS_13F["COVERPAGE.tsv"])
INFO = schemas.member_columns(schemas.MEMBERS_13F["INFOTABLE.tsv"])
SUB345 = schemas.member_columns(schemas.MEMBERS_345["SUBMISSION.tsv"])
OWNER = schemas.member_columns(schemas.MEMBERS_345["REPORTINGOWNER.tsv"])
NONDERIV = schemas.member_columns(schemas.MEMBERS_345["NONDERIV_TRANS.tsv"])
DERIV = schemas.member_columns(schemas.MEMBERS_345["DERIV_TRANS.tsv"])


def sub13f(**more):
    return {"ACCESSION_NUMBER": "A", "FILING_DATE": "31-MAR-2026", "SUBMISSIONTYPE": "13F-HR", "CIK": "1", **more}


def info(**more):
    return {"ACCESSION_NUMBER": "A", "INFOTABLE_SK": "1", "CUSIP": " 12345 6789 ", "VALUE": "1,392", "SSHPRNAMT": "6,864", **more}


def test_13f_filing_takes_the_first_cover_page(spark):
    covers = [
        {"ACCESSION_NUMBER": "A", "FILINGMANAGER_NAME": "first", "ISAMENDMENT": "Y", "REPORTCALENDARORQUARTER": "12-31-2025"},
        {"ACCESSION_NUMBER": "A", "FILINGMANAGER_NAME": "second"},
    ]
    made = normalize.filings_13f(
        raw(spark, SUB, [sub13f(PERIODOFREPORT="31-DEC-2025"), sub13f(ACCESSION_NUMBER="B")]), raw(spark, COVER, covers)
    )
    a, b = made.strict().orderBy("accession").collect()
    assert made.rows.schema == schemas.INSTITUTIONAL_FILINGS or made.rows.columns == schemas.INSTITUTIONAL_FILINGS.names
    assert (a.managerName, a.isAmendment, a.reportCalendarOrQuarter) == ("first", True, "12-31-2025")
    assert a.availableAt == dt.datetime(2026, 4, 1, 3, 59, 59, 999000)
    assert a.periodOfReport == dt.date(2025, 12, 31)
    assert (b.managerName, b.isAmendment, b.periodOfReport) == (None, None, None)


def test_13f_holdings_are_cleaned_and_available_with_their_filing(spark):
    subs = raw(spark, SUB, [sub13f(), sub13f(FILING_DATE="01-APR-2026")])
    (row,) = normalize.holdings_13f(raw(spark, INFO, [info(CUSIP="12345678 a")]), subs).strict().collect()
    assert (row.cusip, row.value, row.sharesAmount) == ("12345678A", 1392.0, 6864.0)
    assert row.availableAt == dt.datetime(2026, 4, 1, 3, 59, 59, 999000)  # the first submission's
    assert (row.resolvedTicker, row.valueUnitSource, row.votingSole) == (None, None, None)


@pytest.mark.parametrize(
    "change, words",
    [
        ({"ACCESSION_NUMBER": "Z"}, "unknown accession"),
        ({"VALUE": "12x"}, "INFOTABLE VALUE"),
        ({"CUSIP": "  "}, "INFOTABLE CUSIP"),
        ({"INFOTABLE_SK": ""}, "INFOTABLE_SK"),
    ],
)
def test_broken_holdings_are_refused_or_kept_apart(spark, change, words):
    checked = normalize.holdings_13f(raw(spark, INFO, [info(), info(**change)]), raw(spark, SUB, [sub13f()]))
    assert checked.rows.count() == 1
    assert checked.rejects.count() == 1
    with pytest.raises(BrokenRows, match=words):
        checked.strict()


def test_broken_filings_name_the_field(spark):
    subs = [sub13f(FILING_DATE="31-FEB-2026"), sub13f(PERIODOFREPORT="soon")]
    with pytest.raises(BrokenRows, match="FILING_DATE x1.*PERIODOFREPORT x1"):
        normalize.filings_13f(raw(spark, SUB, subs), raw(spark, COVER, [])).strict()


def test_archives_are_read_on_their_own(spark):
    subs = raw(spark, SUB, [sub13f()], "raw/one").unionByName(raw(spark, SUB, [sub13f(FILING_DATE="01-MAY-2026")], "raw/two"))
    infos = raw(spark, INFO, [info()], "raw/one").unionByName(raw(spark, INFO, [info()], "raw/two"))
    found = normalize.holdings_13f(infos, subs).strict().orderBy("rawArchiveKey").collect()
    assert [(r.rawArchiveKey, r.availableAt.month) for r in found] == [("raw/one", 4), ("raw/two", 5)]


def _insider(spark):
    subs = [
        {"ACCESSION_NUMBER": "A", "FILING_DATE": "31-OCT-2025", "DOCUMENT_TYPE": "4", "ISSUERCIK": "9", "ISSUERNAME": "old"},
        {"ACCESSION_NUMBER": "A", "FILING_DATE": "15-DEC-2025", "DOCUMENT_TYPE": "4/A", "ISSUERCIK": "9",
         "ISSUERNAME": "new", "ISSUERTRADINGSYMBOL": "NYSE: KRC", "AFF10B5ONE": "true"},
    ]
    owners = [
        {"ACCESSION_NUMBER": "A", "RPTOWNERCIK": "1", "RPTOWNER_RELATIONSHIP": "Director,TenPercentOwner"},
        {"ACCESSION_NUMBER": "A", "RPTOWNERCIK": "2", "RPTOWNERNAME": "Two", "RPTOWNER_TITLE": "CFO"},
    ]
    return raw(spark, SUB345, subs), raw(spark, OWNER, owners)


def test_insider_filings_repeat_per_owner_and_take_the_last_submission(spark):
    one, two = normalize.filings_insider(*_insider(spark)).strict().orderBy("ownerCik").collect()
    assert (one.issuerName, one.formType, one.issuerTicker, one.resolvedTicker) == ("new", "4/A", "NYSE: KRC", "KRC")
    assert one.availableAt == dt.datetime(2025, 12, 16, 4, 59, 59, 999000)
    assert (one.isDirector, one.isTenPercentOwner, one.isOfficer, one.isOther) == (True, True, False, False)
    assert (two.officerTitle, two.isDirector, two.aff10b5One, one.ownerName) == ("CFO", False, True, None)


def test_insider_transactions_hold_both_kinds_once(spark):
    subs, _ = _insider(spark)
    nonderiv = raw(spark, NONDERIV, [{"ACCESSION_NUMBER": "A", "NONDERIV_TRANS_SK": "5", "SECURITY_TITLE": "Common", "TRANS_SHARES": "10"}])
    deriv = raw(spark, DERIV, [{"ACCESSION_NUMBER": "A", "DERIV_TRANS_SK": "6", "SECURITY_TITLE": "Option",
                               "CONV_EXERCISE_PRICE": "1.5", "EXPIRATION_DATE": "1-JAN-2030", "EQUITY_SWAP_INVOLVED": "0"}])
    plain, option = normalize.transactions_insider(subs, nonderiv, deriv).strict().orderBy("rowSk").collect()
    assert (plain.rowKind, plain.shares, plain.exercisePrice, plain.expirationDate) == ("nonderiv", 10.0, None, None)
    assert (option.rowKind, option.exercisePrice, option.expirationDate) == ("deriv", 1.5, dt.date(2030, 1, 1))
    assert (plain.equitySwapInvolved, option.equitySwapInvolved) == (None, False)


def test_insider_numbers_keep_no_commas(spark):
    subs, _ = _insider(spark)
    leg = {"ACCESSION_NUMBER": "A", "NONDERIV_TRANS_SK": "5", "SECURITY_TITLE": "Common", "TRANS_SHARES": "1,000"}
    with pytest.raises(BrokenRows, match="TRANS_SHARES"):
        normalize.transactions_insider(subs, raw(spark, NONDERIV, [leg]), raw(spark, DERIV, [])).strict()
