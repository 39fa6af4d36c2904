"""Raw members to typed lake rows (P1-P4, with the joins J1-J4 inside).

A raw member is a DataFrame of strings as `sources.tsv.records` returns it, plus `archive_key`
(where the bytes came from) and `ord` (position in file order). Joins run on the archive and
the accession, because every archive is read on its own: the same accession in two archives
stays two rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filinglake import schemas
from filinglake.functions import dates, securities, text
from filinglake.operators.checks import Checked, split_broken, typed
from filinglake.operators.keyed import first_per_key, last_per_key

KEY = ["archive_key", "accession"]


def _with_key(member: DataFrame) -> DataFrame:
    return member.withColumn("accession", text.text(F.col("ACCESSION_NUMBER")))


def _cells(df: DataFrame) -> DataFrame:
    """Every raw cell trimmed, once, so that rules and types read the same text."""
    return df.select(
        *[
            F.col(name) if name in ("archive_key", "ord", "accession") else text.trimmed(F.col(name)).alias(name)
            for name in df.columns
        ]
    )


def _keyed(member: DataFrame) -> DataFrame:
    """Trimmed cells, and the accession they belong to."""
    return _cells(member).withColumn("accession", text.present(F.col("ACCESSION_NUMBER")))


def _typed(table: str, **columns: Column) -> dict[str, Column]:
    """Columns of a lake table, in its order and with its types."""
    return {f.name: columns.get(f.name, F.lit(None)).cast(f.dataType) for f in schemas.TABLES[table]}


def cover_left(submission: DataFrame, cover: DataFrame) -> DataFrame:
    """Submissions with the first cover page of their accession, or nulls."""
    pages = _with_key(cover)
    wanted = [c for c in pages.columns if c not in submission.columns or c in KEY]
    first = first_per_key(pages.select(*wanted, F.col("ord").alias("_ord")), KEY, "_ord")
    return _with_key(submission).join(first.drop("_ord"), KEY, "left")


def filings_13f(submission: DataFrame, cover: DataFrame, keep: Sequence[str] = ()) -> Checked:
    """Institutional filings: one row per submission, the reported quarter kept verbatim."""
    c = F.col
    joined = _cells(cover_left(submission, cover))
    day = dates.sec_date(c("FILING_DATE"))
    columns = _typed(
        "institutional_filings",
        accession=c("accession"),
        filingDate=day,
        availableAt=dates.end_of_day_new_york(day),
        availabilitySource=F.lit(schemas.SOURCE_13F_DATASET),
        submissionType=text.present(c("SUBMISSIONTYPE")),
        cik=text.present(c("CIK")),
        managerName=text.present(c("FILINGMANAGER_NAME")),
        periodOfReport=dates.sec_date(c("PERIODOFREPORT")),
        reportCalendarOrQuarter=text.present(c("REPORTCALENDARORQUARTER")),
        isAmendment=text.yes_no(c("ISAMENDMENT")),
        amendmentNo=text.present(c("AMENDMENTNO")),
        amendmentType=text.present(c("AMENDMENTTYPE")),
        dateReported=dates.sec_date(c("DATEREPORTED")),
        rawArchiveKey=c("archive_key"),
    )
    rules = {
        "SUBMISSION ACCESSION_NUMBER": c("accession").isNull(),
        "SUBMISSION FILING_DATE": typed("filingDate").isNull(),
        "SUBMISSION SUBMISSIONTYPE": typed("submissionType").isNull(),
        "SUBMISSION CIK": typed("cik").isNull(),
        "SUBMISSION PERIODOFREPORT": dates.sec_date_broken(c("PERIODOFREPORT"), typed("periodOfReport")),
        "COVERPAGE DATEREPORTED": dates.sec_date_broken(c("DATEREPORTED"), typed("dateReported")),
    }
    columns.update({name: c(name) for name in keep})
    good = split_broken("institutional_filings", joined, rules, columns, c("accession"))
    blank_cover = split_broken(
        "institutional_filings",
        _keyed(cover),
        {"COVERPAGE ACCESSION_NUMBER": c("accession").isNull()},
        {"accession": c("accession")},
        c("archive_key"),
    )
    return Checked(good.table, good.rows, good.rejects.unionByName(blank_cover.rejects))


def first_availability(submission: DataFrame) -> DataFrame:
    """Filing day of the first submission per archive and accession."""
    days = _keyed(submission).select(
        *KEY, dates.sec_date(F.col("FILING_DATE")).alias("filing_day"), "ord"
    )
    return first_per_key(days, KEY, "ord").drop("ord")


def holdings_13f(info: DataFrame, submission: DataFrame, keep: Sequence[str] = ()) -> Checked:
    """Institutional holdings, available when their filing was."""
    c = F.col
    joined = _keyed(info).join(first_availability(submission), KEY, "left")
    cusip = text.compact(c("CUSIP"))
    amounts = {
        "value": "VALUE",
        "sharesAmount": "SSHPRNAMT",
        "votingSole": "VOTING_AUTH_SOLE",
        "votingShared": "VOTING_AUTH_SHARED",
        "votingNone": "VOTING_AUTH_NONE",
    }
    labels = {
        "infoTableSk": "INFOTABLE_SK",
        "issuerName": "NAMEOFISSUER",
        "titleOfClass": "TITLEOFCLASS",
        "figi": "FIGI",
        "sharesType": "SSHPRNAMTTYPE",
        "putCall": "PUTCALL",
        "discretion": "INVESTMENTDISCRETION",
        "otherManager": "OTHERMANAGER",
    }
    joined = joined.withColumns({raw: text.without_commas(c(raw)) for raw in amounts.values()})
    columns = _typed(
        "institutional_holdings",
        accession=c("accession"),
        availableAt=dates.end_of_day_new_york(c("filing_day")),
        availabilitySource=F.lit(schemas.SOURCE_13F_DATASET),
        cusip=cusip,
        rawArchiveKey=c("archive_key"),
        **{name: text.present(c(raw)) for name, raw in labels.items()},
        **{name: text.parse_number(c(raw)) for name, raw in amounts.items()},
    )
    rules = {
        "INFOTABLE ACCESSION_NUMBER": c("accession").isNull(),
        "INFOTABLE unknown accession": c("accession").isNotNull() & c("filing_day").isNull(),
        "INFOTABLE INFOTABLE_SK": typed("infoTableSk").isNull(),
        "INFOTABLE CUSIP": typed("cusip").isNull(),
        **{
            f"INFOTABLE {raw}": text.number_broken(c(raw), typed(name))
            for name, raw in amounts.items()
        },
    }
    columns.update({name: c(name) for name in keep})
    where = F.concat_ws("/", c("accession"), c("INFOTABLE_SK"))
    return split_broken("institutional_holdings", joined, rules, columns, where)


def _submission_facts(submission: DataFrame) -> DataFrame:
    """What transactions and owners take from the last submission of their accession."""
    c = F.col
    cells = ["DOCUMENT_TYPE", "FILING_DATE", "ISSUERCIK", "ISSUERNAME", "ISSUERTRADINGSYMBOL", "PERIOD_OF_REPORT", "DATE_OF_ORIG_SUB", "AFF10B5ONE"]
    # Cells are read after the last row is known: once an accession, and only those somebody asks for.
    last = last_per_key(_keyed(submission).select(*KEY, *cells, "ord"), KEY, "ord")
    period, original = dates.sec_date(c("PERIOD_OF_REPORT")), dates.sec_date(c("DATE_OF_ORIG_SUB"))
    placed = c("ord").isNotNull()
    return last.select(
        *KEY,
        text.present(c("DOCUMENT_TYPE")).alias("form_type"),
        dates.sec_date(c("FILING_DATE")).alias("filing_day"),
        text.present(c("ISSUERCIK")).alias("issuer_cik"),
        text.present(c("ISSUERNAME")).alias("issuer_name"),
        text.present(c("ISSUERTRADINGSYMBOL")).alias("issuer_symbol"),
        F.when(placed, securities.issuer_ticker(c("ISSUERTRADINGSYMBOL"))).alias("resolved_symbol"),
        period.alias("period_day"),
        dates.sec_date_broken(c("PERIOD_OF_REPORT"), period).alias("period_broken"),
        original.alias("original_day"),
        dates.sec_date_broken(c("DATE_OF_ORIG_SUB"), original).alias("original_broken"),
        text.flag(c("AFF10B5ONE")).alias("aff10b5one"),
        F.when(placed, F.lit(True)).alias("known"),
    )


def _fact_columns() -> dict[str, Column]:
    c = F.col
    return dict(
        accession=c("accession"),
        formType=c("form_type"),
        availableAt=dates.end_of_day_new_york(c("filing_day")),
        availabilitySource=F.lit(schemas.SOURCE_345_DATASET),
        issuerCik=c("issuer_cik"),
        issuerTicker=c("issuer_symbol"),
        resolvedTicker=c("resolved_symbol"),
        rawArchiveKey=c("archive_key"),
    )


def _fact_rules(member: str) -> dict[str, Column]:
    c = F.col
    return {
        f"{member} ACCESSION_NUMBER": c("accession").isNull(),
        f"{member} unknown accession": c("accession").isNotNull() & c("known").isNull(),
        "SUBMISSION FILING_DATE": c("known") & c("filing_day").isNull(),
        "SUBMISSION DOCUMENT_TYPE": c("known") & c("form_type").isNull(),
        "SUBMISSION ISSUERCIK": c("known") & c("issuer_cik").isNull(),
    }


def submission_rejects(submission: DataFrame) -> DataFrame:
    """Submission rows that lack or break a field, whether or not an owner or a leg refers to them."""
    c = F.col
    rows = _keyed(submission)
    rules = {
        "SUBMISSION ACCESSION_NUMBER": c("accession").isNull(),
        "SUBMISSION FILING_DATE": dates.sec_date(c("FILING_DATE")).isNull(),
        "SUBMISSION DOCUMENT_TYPE": text.present(c("DOCUMENT_TYPE")).isNull(),
        "SUBMISSION ISSUERCIK": text.present(c("ISSUERCIK")).isNull(),
    }
    return split_broken("submission", rows, rules, {"accession": c("accession")}, F.coalesce("accession", F.lit("(none)"))).rejects


def filings_insider(submission: DataFrame, owners: DataFrame, keep: Sequence[str] = ()) -> Checked:
    """Insider filings: one row per accession and reporting owner.

    Rejects name every broken submission row as well as every broken owner row.
    """
    c = F.col
    joined = _keyed(owners).join(_submission_facts(submission), KEY, "left")
    relation = c("RPTOWNER_RELATIONSHIP")
    columns = _typed(
        "insider_filings",
        **_fact_columns(),
        filingDate=c("filing_day"),
        periodOfReport=c("period_day"),
        dateOfOriginalSubmission=c("original_day"),
        issuerName=c("issuer_name"),
        ownerCik=text.present(c("RPTOWNERCIK")),
        ownerName=text.present(c("RPTOWNERNAME")),
        isDirector=text.listed(relation, "DIRECTOR"),
        isOfficer=text.listed(relation, "OFFICER"),
        isTenPercentOwner=text.listed(relation, "TENPERCENTOWNER"),
        isOther=text.listed(relation, "OTHER"),
        officerTitle=text.present(c("RPTOWNER_TITLE")),
        ownerRelationshipText=text.present(c("RPTOWNER_TXT")),
        aff10b5One=c("aff10b5one"),
    )
    rules = {
        **_fact_rules("REPORTINGOWNER"),
        "SUBMISSION PERIOD_OF_REPORT": c("period_broken"),
        "SUBMISSION DATE_OF_ORIG_SUB": c("original_broken"),
        "REPORTINGOWNER RPTOWNERCIK": typed("ownerCik").isNull(),
    }
    columns.update({name: c(name) for name in keep})
    found = split_broken("insider_filings", joined, rules, columns, c("accession"))
    return Checked(found.table, found.rows, submission_rejects(submission).unionByName(found.rejects))


# Raw header to lake column, by kind of cell. Data set spelling kept.
_LEG_DATES = {"transactionDate": "TRANS_DATE", "deemedExecutionDate": "DEEMED_EXECUTION_DATE"}
_LEG_TEXT = {
    "securityTitle": "SECURITY_TITLE",
    "transactionFormType": "TRANS_FORM_TYPE",
    "transactionCode": "TRANS_CODE",
    "acquiredDisposed": "TRANS_ACQUIRED_DISP_CD",
    "directIndirect": "DIRECT_INDIRECT_OWNERSHIP",
    "natureOfOwnership": "NATURE_OF_OWNERSHIP",
}
_LEG_NUMBERS = {
    "shares": "TRANS_SHARES",
    "pricePerShare": "TRANS_PRICEPERSHARE",
    "sharesOwnedFollowing": "SHRS_OWND_FOLWNG_TRANS",
}
_DERIV_DATES = {"exerciseDate": "EXCERCISE_DATE", "expirationDate": "EXPIRATION_DATE"}
_DERIV_TEXT = {"underlyingTitle": "UNDLYNG_SEC_TITLE"}
_DERIV_NUMBERS = {
    "totalValue": "TRANS_TOTAL_VALUE",
    "exercisePrice": "CONV_EXERCISE_PRICE",
    "underlyingShares": "UNDLYNG_SEC_SHARES",
}


def _legs(member: DataFrame, kind: str, sk: str) -> DataFrame:
    """One leg table with the columns both kinds share; derivative-only ones null elsewhere."""
    own = {**_DERIV_DATES, **_DERIV_TEXT, **_DERIV_NUMBERS}
    shared = {**_LEG_DATES, **_LEG_TEXT, **_LEG_NUMBERS}
    derivative = [F.col(raw) if kind == "deriv" else F.lit(None).cast("string").alias(raw)
                  for raw in own.values()]
    return _keyed(member).select(
        *KEY,
        F.lit(kind).alias("row_kind"),
        text.present(F.col(sk)).alias("row_sk"),
        *[F.col(raw) for raw in shared.values()],
        F.col("EQUITY_SWAP_INVOLVED"),
        *derivative,
    )


def transactions_insider(submission: DataFrame, nonderiv: DataFrame, deriv: DataFrame) -> Checked:
    """Insider transactions: both leg tables together, once per leg."""
    c = F.col
    legs = _legs(nonderiv, "nonderiv", "NONDERIV_TRANS_SK").unionByName(
        _legs(deriv, "deriv", "DERIV_TRANS_SK")
    )
    joined = legs.join(_submission_facts(submission), KEY, "left")
    days = {**_LEG_DATES, **_DERIV_DATES}
    numbers = {**_LEG_NUMBERS, **_DERIV_NUMBERS}
    columns = _typed(
        "insider_transactions",
        **_fact_columns(),
        rowKind=c("row_kind"),
        rowSk=c("row_sk"),
        equitySwapInvolved=text.flag(c("EQUITY_SWAP_INVOLVED")),
        **{name: dates.sec_date(c(raw)) for name, raw in days.items()},
        **{name: text.present(c(raw)) for name, raw in {**_LEG_TEXT, **_DERIV_TEXT}.items()},
        **{name: text.parse_number(c(raw)) for name, raw in numbers.items()},
    )
    rules = {
        **_fact_rules("transaction"),
        "transaction row key": c("row_sk").isNull(),
        "transaction SECURITY_TITLE": typed("securityTitle").isNull(),
        **{f"transaction {raw}": dates.sec_date_broken(c(raw), typed(name)) for name, raw in days.items()},
        **{f"transaction {raw}": text.number_broken(c(raw), typed(name)) for name, raw in numbers.items()},
    }
    where = F.concat_ws("/", c("accession"), c("row_kind"), c("row_sk"))
    found = split_broken("insider_transactions", joined, rules, columns, where)
    return Checked(found.table, found.rows, submission_rejects(submission).unionByName(found.rejects))


def with_resolved_ticker(df: DataFrame, source: str, target: str = "resolvedTicker") -> DataFrame:
    """Any table with a free-text symbol, plus the joinable symbol (P5)."""
    return df.withColumn(target, securities.issuer_ticker(F.col(source)))
