"""Ownership submissions: header text and an XML document to insider rows.

The document is parsed in the JVM with a declared schema. Positions in the arrays of owners and
legs become rows by `posexplode`; the 1-based position is the leg's key.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from filinglake import schemas
from filinglake.functions import dates, securities, text

# Element names of the ownership document. `<name>: value` is an element whose
# text sits in a nested `value`; a footnote next to it is not read.
_VALUE = "STRUCT<value: STRING>"
_LEG = f"""STRUCT<
    securityTitle: {_VALUE}, conversionOrExercisePrice: {_VALUE}, transactionDate: {_VALUE},
    deemedExecutionDate: {_VALUE},
    transactionCoding: STRUCT<
        transactionFormType: STRING, transactionCode: STRING, equitySwapInvolved: STRING>,
    transactionAmounts: STRUCT<
        transactionShares: {_VALUE}, transactionTotalValue: {_VALUE},
        transactionPricePerShare: {_VALUE}, transactionAcquiredDisposedCode: {_VALUE}>,
    exerciseDate: {_VALUE}, expirationDate: {_VALUE},
    underlyingSecurity: STRUCT<
        underlyingSecurityTitle: {_VALUE}, underlyingSecurityShares: {_VALUE}>,
    postTransactionAmounts: STRUCT<sharesOwnedFollowingTransaction: {_VALUE}>,
    ownershipNature: STRUCT<
        directOrIndirectOwnership: {_VALUE}, natureOfOwnership: {_VALUE}>>"""
DOCUMENT = f"""
    documentType STRING, periodOfReport STRING, dateOfOriginalSubmission STRING,
    issuer STRUCT<issuerCik: STRING, issuerName: STRING, issuerTradingSymbol: STRING>,
    reportingOwner ARRAY<STRUCT<
        reportingOwnerId: STRUCT<rptOwnerCik: STRING, rptOwnerName: STRING>,
        reportingOwnerRelationship: STRUCT<
            isDirector: STRING, isOfficer: STRING, isTenPercentOwner: STRING, isOther: STRING,
            officerTitle: STRING, otherText: STRING>>>,
    aff10b5One STRING,
    nonDerivativeTable STRUCT<nonDerivativeTransaction: ARRAY<{_LEG}>>,
    derivativeTable STRUCT<derivativeTransaction: ARRAY<{_LEG}>>
"""
_OPEN, _CLOSE = "<ownershipDocument", "</ownershipDocument>"


@dataclass(frozen=True)
class Submissions:
    """Typed rows of the good documents; the others with the reasons, to be offered again."""

    filings: DataFrame
    transactions: DataFrame
    rejects: DataFrame


def read_submissions(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: (archive_key, raw)."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("archive_key"), F.col("value").alias("raw")
    )


# The header fields of a submission.
ACCESSION_NUMBER = r"(?m)^ACCESSION NUMBER:\s*(\S+)"
ACCEPTANCE_DATETIME = r"<ACCEPTANCE-DATETIME>(\d{14})"
FILED_AS_OF_DATE = r"(?m)^FILED AS OF DATE:\s*(\d{8})"


def _header(raw: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(raw, pattern, 1), F.lit(""))


def accession_of(raw: Column) -> Column:
    """Accession in the header of a submission's text, null if it has none."""
    return _header(raw, ACCESSION_NUMBER)


def _parsed(documents: DataFrame) -> DataFrame:
    c = F.col
    # What is found in the text leaves a generator: the text is searched once for each, and filters on it are not
    # pushed to where the text is read or made.
    facts = {
        "accession": accession_of(c("raw")),
        "_accepted": dates.acceptance_instant(_header(c("raw"), ACCEPTANCE_DATETIME)),
        "_filed": dates.compact_date(_header(c("raw"), FILED_AS_OF_DATE)),
        "_cut": F.split("raw", _CLOSE, 2),
    }
    found = documents.select("*", F.inline(F.array(F.struct(*[fact.alias(name) for name, fact in facts.items()]))).alias(*facts)).select(
        "*",
        # What stands between the first opening tag and the first closing tag, null if they don't stand in this order.
        F.when(F.size("_cut") == 2, F.get(F.split(F.get("_cut", F.lit(0)), _OPEN, 2), F.lit(1))).alias("_body"),
    )
    # So does the document: filters on it are not pushed below, where each of their
    # terms would parse the text again.
    document = F.concat(F.lit(_OPEN), c("_body"), F.lit(_CLOSE))
    parsed = F.from_xml(document, DOCUMENT, {"rowTag": "ownershipDocument", "mode": "PERMISSIVE"})
    return found.select(
        *documents.columns,
        "accession",
        "_accepted",
        "_filed",
        F.when(c("raw").isNotNull(), c("_body").isNotNull()).alias("_has_body"),
        F.explode(F.array(parsed)).alias("_doc"),
    )


def _raw_cells(leg: Column, derivative: bool) -> dict[str, Column]:
    """Cells of one leg as they are in the document; some are on the derivative table only."""
    amounts, coding = leg["transactionAmounts"], leg["transactionCoding"]
    nature, under = leg["ownershipNature"], leg["underlyingSecurity"]
    shared = {
        "securityTitle": leg["securityTitle"]["value"],
        "transactionDate": leg["transactionDate"]["value"],
        "deemedExecutionDate": leg["deemedExecutionDate"]["value"],
        "transactionFormType": coding["transactionFormType"],
        "transactionCode": coding["transactionCode"],
        "equitySwapInvolved": coding["equitySwapInvolved"],
        "acquiredDisposed": amounts["transactionAcquiredDisposedCode"]["value"],
        "shares": amounts["transactionShares"]["value"],
        "pricePerShare": amounts["transactionPricePerShare"]["value"],
        "sharesOwnedFollowing": leg["postTransactionAmounts"]["sharesOwnedFollowingTransaction"]["value"],
        "directIndirect": nature["directOrIndirectOwnership"]["value"],
        "natureOfOwnership": nature["natureOfOwnership"]["value"],
    }
    own = {
        "totalValue": amounts["transactionTotalValue"]["value"],
        "exercisePrice": leg["conversionOrExercisePrice"]["value"],
        "exerciseDate": leg["exerciseDate"]["value"],
        "expirationDate": leg["expirationDate"]["value"],
        "underlyingTitle": under["underlyingSecurityTitle"]["value"],
        "underlyingShares": under["underlyingSecurityShares"]["value"],
    }
    return {**shared, **own} if derivative else shared


_DATES = ("transactionDate", "deemedExecutionDate", "exerciseDate", "expirationDate")
_NUMBERS = (
    "shares", "pricePerShare", "totalValue", "sharesOwnedFollowing", "exercisePrice", "underlyingShares",
)


def _legs(array: Column, derivative: bool) -> Column:
    """The legs of one table as structs of text, with kind and 1-based position."""
    def one(leg: Column, index: Column) -> Column:
        cells = {name: text.nested_text(cell) for name, cell in _raw_cells(leg, derivative).items()}
        return F.struct(
            F.lit("deriv" if derivative else "nonderiv").alias("rowKind"),
            (index + 1).cast("string").alias("rowSk"),
            *[cells.get(name, F.lit(None).cast("string")).alias(name) for name in _raw_cells(leg, True)],
        )

    return F.coalesce(F.transform(array, one), F.array())


def _leg_broken(derivative: bool):
    """Whether a leg as parsed has no title or a cell of another kind; no other cell of it is read."""
    rules = {
        **dict.fromkeys(_DATES, dates.xml_date_broken),
        **dict.fromkeys(_NUMBERS, lambda cell: cell.isNotNull() & text.number(cell).isNull()),
    }

    def broken(leg: Column) -> Column:
        raw = _raw_cells(leg, derivative)
        found = text.nested_text(raw["securityTitle"]).isNull()
        for name, rule in rules.items():
            if name in raw:
                found = found | (raw[name].isNotNull() & F.exists(F.array(text.nested_text(raw[name])), rule))
        return found

    return broken


def parse_submissions(documents: DataFrame) -> Submissions:
    """Insider rows of documents (archive_key, raw); one bad cell rejects its document."""
    c = F.col
    doc = c("_doc")
    parsed = _parsed(documents)
    owner_ok = lambda o: (
        text.nested_text(o["reportingOwnerId"]["rptOwnerCik"]).isNotNull()
        & text.nested_text(o["reportingOwnerId"]["rptOwnerName"]).isNotNull()
    )
    shaped = parsed.select(
        *documents.columns,
        "accession",
        "_accepted",
        "_filed",
        "_has_body",
        text.text(doc["documentType"]).alias("formType"),
        text.text(doc["issuer"]["issuerCik"]).alias("issuerCik"),
        text.text(doc["issuer"]["issuerName"]).alias("issuerName"),
        text.text(doc["issuer"]["issuerTradingSymbol"]).alias("issuerTicker"),
        text.text(doc["periodOfReport"]).alias("_period"),
        text.text(doc["dateOfOriginalSubmission"]).alias("_original"),
        text.flag(text.trimmed(doc["aff10b5One"])).alias("aff10b5One"),
        F.coalesce(doc["reportingOwner"], F.array()).alias("_owners"),
        doc["nonDerivativeTable"]["nonDerivativeTransaction"].alias("_nonderiv"),
        doc["derivativeTable"]["derivativeTransaction"].alias("_deriv"),
    ).withColumns({
        # Apart from the other rules, which are compiled where they need no lambda.
        "_owners_ok": F.forall("_owners", owner_ok),
        "_leg_broken": F.coalesce(F.exists("_nonderiv", _leg_broken(False)), F.lit(False))
        | F.coalesce(F.exists("_deriv", _leg_broken(True)), F.lit(False)),
    })
    rules = {
        "ACCESSION NUMBER": c("accession").isNull(),
        "ACCEPTANCE-DATETIME": c("_accepted").isNull(),
        "FILED AS OF DATE": c("_filed").isNull(),
        "ownershipDocument": ~c("_has_body"),
        "documentType, issuerCik or issuerName": c("_has_body")
        & (c("formType").isNull() | c("issuerCik").isNull() | c("issuerName").isNull()),
        "reportingOwner": c("_has_body") & (F.size("_owners") == 0),
        "owner without CIK or name": ~c("_owners_ok"),
        "periodOfReport": dates.xml_date_broken(c("_period")),
        "dateOfOriginalSubmission": dates.xml_date_broken(c("_original")),
        "transaction cell": c("_leg_broken"),
    }
    tested = {name: F.coalesce(rule, F.lit(False)) for name, rule in rules.items()}
    names = F.filter(
        F.array(*[F.when(rule, F.lit(name)) for name, rule in tested.items()]),
        lambda name: name.isNotNull(),
    )
    # Likewise one verdict per document, whatever is asked of it later.
    judged = shaped.select("*", F.explode(F.array(reduce(lambda a, b: a | b, tested.values()))).alias("_broken"))
    good = judged.filter(~c("_broken")).select(
        "*",
        securities.issuer_ticker(c("issuerTicker")).alias("resolvedTicker"),
        dates.available_after(c("_accepted")).alias("availableAt"),
        F.lit(schemas.SOURCE_ACCEPTANCE).alias("availabilitySource"),
        c("archive_key").alias("rawArchiveKey"),
    )
    owner, relation = c("_owner.reportingOwnerId"), c("_owner.reportingOwnerRelationship")
    role = lambda name: F.coalesce(text.flag(text.trimmed(relation[name])), F.lit(False)).alias(name)
    filings = good.withColumn("_owner", F.explode("_owners")).select(
        "*",
        c("_filed").alias("filingDate"),
        dates.xml_date(c("_period")).alias("periodOfReport"),
        dates.xml_date(c("_original")).alias("dateOfOriginalSubmission"),
        text.text(owner["rptOwnerCik"]).alias("ownerCik"),
        text.text(owner["rptOwnerName"]).alias("ownerName"),
        role("isDirector"),
        role("isOfficer"),
        role("isTenPercentOwner"),
        role("isOther"),
        text.text(relation["officerTitle"]).alias("officerTitle"),
        text.text(relation["otherText"]).alias("ownerRelationshipText"),
    )
    leg = c("_leg")

    def cell(name: str) -> Column:
        if name in _DATES:
            return dates.xml_date(leg[name])
        if name in _NUMBERS:
            return text.parse_number(leg[name])
        if name == "equitySwapInvolved":
            return text.flag(leg[name])
        return leg[name]

    own = {f.name for f in schemas.INSIDER_TRANSACTIONS.fields} - {
        "accession", "formType", "issuerCik", "issuerTicker", "resolvedTicker", "availableAt",
        "availabilitySource", "rawArchiveKey",
    }
    legs = F.concat(_legs(c("_nonderiv"), False), _legs(c("_deriv"), True))
    transactions = good.withColumn("_leg", F.explode(legs)).select(
        *[
            (cell(f.name) if f.name in own else c(f.name)).cast(f.dataType).alias(f.name)
            for f in schemas.INSIDER_TRANSACTIONS.fields
        ]
    )
    rejects = judged.filter("_broken").select(*documents.columns, "accession", names.alias("broken"))
    return Submissions(
        filings.select(*[c(f.name).cast(f.dataType).alias(f.name) for f in schemas.INSIDER_FILINGS.fields]),
        transactions,
        rejects,
    )
