"""Shapes of the four lake tables and of the raw members they are read from."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "STRING": T.StringType(),
    "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampType(),
    "BOOLEAN": T.BooleanType(),
    "DOUBLE": T.DoubleType(),
}


def _table(columns: str) -> T.StructType:
    """A schema from `name TYPE, ...`, without needing a session."""
    pairs = (column.split() for column in columns.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# Lake column names, order and types. Column order is the Parquet column order.
INSIDER_FILINGS = _table("""
    accession STRING, formType STRING, filingDate DATE, availableAt TIMESTAMP,
    availabilitySource STRING, periodOfReport DATE, dateOfOriginalSubmission DATE,
    issuerCik STRING, issuerName STRING, issuerTicker STRING, resolvedTicker STRING,
    ownerCik STRING, ownerName STRING, isDirector BOOLEAN, isOfficer BOOLEAN,
    isTenPercentOwner BOOLEAN, isOther BOOLEAN, officerTitle STRING,
    ownerRelationshipText STRING, aff10b5One BOOLEAN, rawArchiveKey STRING
""")

INSIDER_TRANSACTIONS = _table("""
    accession STRING, rowKind STRING, rowSk STRING, formType STRING, issuerCik STRING,
    issuerTicker STRING, resolvedTicker STRING, availableAt TIMESTAMP,
    availabilitySource STRING, securityTitle STRING, transactionDate DATE,
    deemedExecutionDate DATE, transactionFormType STRING, transactionCode STRING,
    equitySwapInvolved BOOLEAN, acquiredDisposed STRING, shares DOUBLE, pricePerShare DOUBLE,
    totalValue DOUBLE, sharesOwnedFollowing DOUBLE, directIndirect STRING,
    natureOfOwnership STRING, exercisePrice DOUBLE, exerciseDate DATE, expirationDate DATE,
    underlyingTitle STRING, underlyingShares DOUBLE, rawArchiveKey STRING
""")

INSTITUTIONAL_FILINGS = _table("""
    accession STRING, filingDate DATE, availableAt TIMESTAMP, availabilitySource STRING,
    submissionType STRING, cik STRING, managerName STRING, periodOfReport DATE,
    reportCalendarOrQuarter STRING, isAmendment BOOLEAN, amendmentNo STRING,
    amendmentType STRING, dateReported DATE, rawArchiveKey STRING
""")

INSTITUTIONAL_HOLDINGS = _table("""
    accession STRING, infoTableSk STRING, availableAt TIMESTAMP, availabilitySource STRING,
    issuerName STRING, titleOfClass STRING, cusip STRING, figi STRING, value DOUBLE,
    sharesAmount DOUBLE, sharesType STRING, putCall STRING, discretion STRING,
    otherManager STRING, votingSole DOUBLE, votingShared DOUBLE, votingNone DOUBLE,
    resolvedTicker STRING, valueUnitSource STRING, rawArchiveKey STRING
""")

TABLES = {
    "insider_filings": INSIDER_FILINGS,
    "insider_transactions": INSIDER_TRANSACTIONS,
    "institutional_filings": INSTITUTIONAL_FILINGS,
    "institutional_holdings": INSTITUTIONAL_HOLDINGS,
}

# Clustering order inside a year shard.
CLUSTER_KEYS = {
    "insider_filings": ("issuerTicker", "availableAt"),
    "insider_transactions": ("issuerTicker", "availableAt"),
    "institutional_filings": ("accession", "availableAt"),
    "institutional_holdings": ("cusip", "availableAt"),
}

# Further columns that make the clustering order total, so that one hot ticker or CUSIP
# still range-splits over many files.
CLUSTER_TIEBREAK = {
    "insider_filings": ("accession", "ownerCik"),
    "insider_transactions": ("accession", "rowKind", "rowSk"),
    "institutional_filings": ("cik",),
    "institutional_holdings": ("accession", "infoTableSk"),
}

# Non-null columns of a published table.
REQUIRED = {
    "insider_filings": (
        "accession", "formType", "filingDate", "availableAt", "availabilitySource", "issuerCik",
        "ownerCik", "isDirector", "isOfficer", "isTenPercentOwner", "isOther", "rawArchiveKey",
    ),
    "insider_transactions": (
        "accession", "rowKind", "rowSk", "formType", "issuerCik", "availableAt",
        "availabilitySource", "securityTitle", "rawArchiveKey",
    ),
    "institutional_filings": (
        "accession", "filingDate", "availableAt", "availabilitySource", "submissionType", "cik",
        "rawArchiveKey",
    ),
    "institutional_holdings": (
        "accession", "infoTableSk", "availableAt", "availabilitySource", "cusip", "rawArchiveKey",
    ),
}

ROW_KINDS = ("nonderiv", "deriv")

# Where an availableAt comes from.
SOURCE_345_DATASET = "sec_dataset_filing_date"
SOURCE_ACCEPTANCE = "sec_acceptance_datetime"
SOURCE_13F_DATASET = "sec_13f_quarterly_dataset"

# Higher rank wins when two sources carry the same insider accession.
INSIDER_SOURCE_RANK = {SOURCE_345_DATASET: 1, SOURCE_ACCEPTANCE: 2}

# Raw member headers. Only the required ones must be present.
MEMBERS_13F = {
    "SUBMISSION.tsv": {
        "required": ["ACCESSION_NUMBER", "FILING_DATE", "SUBMISSIONTYPE", "CIK", "PERIODOFREPORT"],
        "optional": [],
    },
    "COVERPAGE.tsv": {
        "required": ["ACCESSION_NUMBER", "ISAMENDMENT", "FILINGMANAGER_NAME"],
        "optional": ["REPORTCALENDARORQUARTER", "AMENDMENTNO", "AMENDMENTTYPE", "DATEREPORTED"],
    },
    "INFOTABLE.tsv": {
        "required": [
            "ACCESSION_NUMBER", "INFOTABLE_SK", "NAMEOFISSUER", "TITLEOFCLASS", "CUSIP", "FIGI",
            "VALUE", "SSHPRNAMT", "SSHPRNAMTTYPE", "PUTCALL", "INVESTMENTDISCRETION",
            "VOTING_AUTH_SOLE", "VOTING_AUTH_SHARED", "VOTING_AUTH_NONE",
        ],
        "optional": ["OTHERMANAGER"],
    },
}

MEMBERS_345 = {
    "SUBMISSION.tsv": {
        "required": ["ACCESSION_NUMBER", "FILING_DATE", "DOCUMENT_TYPE", "ISSUERCIK", "ISSUERNAME"],
        "optional": [
            "PERIOD_OF_REPORT", "DATE_OF_ORIG_SUB", "ISSUERTRADINGSYMBOL", "AFF10B5ONE",
        ],
    },
    "REPORTINGOWNER.tsv": {
        "required": [
            "ACCESSION_NUMBER", "RPTOWNERCIK", "RPTOWNERNAME", "RPTOWNER_RELATIONSHIP",
            "RPTOWNER_TITLE", "RPTOWNER_TXT",
        ],
        "optional": [],
    },
    "NONDERIV_TRANS.tsv": {
        "required": [
            "ACCESSION_NUMBER", "NONDERIV_TRANS_SK", "SECURITY_TITLE", "TRANS_DATE",
            "DEEMED_EXECUTION_DATE", "TRANS_FORM_TYPE", "TRANS_CODE", "EQUITY_SWAP_INVOLVED",
            "TRANS_SHARES", "TRANS_PRICEPERSHARE", "TRANS_ACQUIRED_DISP_CD",
            "SHRS_OWND_FOLWNG_TRANS", "DIRECT_INDIRECT_OWNERSHIP", "NATURE_OF_OWNERSHIP",
        ],
        "optional": [],
    },
    "DERIV_TRANS.tsv": {
        "required": [
            "ACCESSION_NUMBER", "DERIV_TRANS_SK", "SECURITY_TITLE", "CONV_EXERCISE_PRICE",
            "TRANS_DATE", "DEEMED_EXECUTION_DATE", "TRANS_FORM_TYPE", "TRANS_CODE",
            "EQUITY_SWAP_INVOLVED", "TRANS_SHARES", "TRANS_TOTAL_VALUE", "TRANS_PRICEPERSHARE",
            "TRANS_ACQUIRED_DISP_CD", "EXCERCISE_DATE", "EXPIRATION_DATE", "UNDLYNG_SEC_TITLE",
            "UNDLYNG_SEC_SHARES", "SHRS_OWND_FOLWNG_TRANS", "DIRECT_INDIRECT_OWNERSHIP",
            "NATURE_OF_OWNERSHIP",
        ],
        "optional": [],
    },
}

MEMBERS_NPORT = {
    "FUND_REPORTED_HOLDING.tsv": ["HOLDING_ID", "ISSUER_CUSIP", "ISSUER_NAME"],
    "IDENTIFIERS.tsv": ["HOLDING_ID", "IDENTIFIER_TICKER", "IDENTIFIER_ISIN"],
}


def member_columns(member: dict[str, list[str]]) -> list[str]:
    return [*member["required"], *member["optional"]]
