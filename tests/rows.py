"""Small builders: one default row per lake table, overridden by name."""

import datetime as dt

from filinglake import schemas

DAY = dt.date(2026, 3, 31)
AT = dt.datetime(2026, 4, 1, 3, 59, 59, 999000)

_DEFAULTS = {
    "accession": "A-1", "filingDate": DAY, "availableAt": AT, "rawArchiveKey": "raw/k", "cik": "1",
    "submissionType": "13F-HR", "managerName": "Manager", "periodOfReport": dt.date(2025, 12, 31),
    "infoTableSk": "10", "issuerName": "Issuer", "cusip": "123456789", "value": 100.0,
    "sharesAmount": 10.0, "sharesType": "SH", "formType": "4", "issuerCik": "7", "issuerTicker": "EX",
    "resolvedTicker": "EX", "ownerCik": "2", "ownerName": "Owner", "isDirector": False,
    "isOfficer": True, "isTenPercentOwner": False, "isOther": False, "rowKind": "nonderiv",
    "rowSk": "1", "securityTitle": "Common", "transactionCode": "P", "shares": 5.0,
    "pricePerShare": 2.0, "transactionDate": dt.date(2026, 3, 30),
}
_SOURCE = {
    "insider_filings": schemas.SOURCE_345_DATASET,
    "insider_transactions": schemas.SOURCE_345_DATASET,
    "institutional_filings": schemas.SOURCE_13F_DATASET,
    "institutional_holdings": schemas.SOURCE_13F_DATASET,
}


def table(spark, name, rows):
    """A lake table from dicts; `window` and `ord` are added in list order."""
    from pyspark.sql import types as T

    schema = T.StructType(
        [*schemas.TABLES[name].fields, T.StructField("window", T.StringType()), T.StructField("ord", T.LongType())]
    )
    made = []
    for n, row in enumerate(rows):
        full = {**_DEFAULTS, "availabilitySource": _SOURCE[name], "window": "w", "ord": n, **row}
        if name == "institutional_holdings":
            full.setdefault("resolvedTicker", None)
            if "resolvedTicker" not in row:
                full["resolvedTicker"] = None
        made.append(tuple(full.get(field.name) for field in schema.fields))
    return spark.createDataFrame(made, schema)


def raw(spark, columns, rows, key="raw/k"):
    """A raw member: strings by column name, with archive_key and ord in list order."""
    ddl = "archive_key STRING, ord LONG, " + ", ".join(f"{c} STRING" for c in columns)
    filled = [(key, n, *[row.get(c, "") for c in columns]) for n, row in enumerate(rows)]
    return spark.createDataFrame(filled, ddl)
