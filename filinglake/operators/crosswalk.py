"""CUSIP to ticker pairs from fund holdings and their identifiers.

`holdings` and `identifiers` are member scans by `sources.tsv.strict_records`: raw string
columns, `ord`, and `malformed` (the line's width differs from its header's). A fold and a
dedupe are aggregates, so the thousands of copies of a large issuer's pair shrink before the
shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filinglake.functions import securities, text
from filinglake.operators.keyed import side_by_side


def fold_identifiers(identifiers: DataFrame) -> DataFrame:
    """One row per holding id: last non-blank ticker and last non-blank ISIN, upper case (A1)."""
    c = F.col
    read = identifiers.filter(~c("malformed")).select(
        text.text(c("HOLDING_ID")).alias("holdingId"),
        F.upper(text.text(c("IDENTIFIER_TICKER"))).alias("ticker"),
        F.upper(text.text(c("IDENTIFIER_ISIN"))).alias("isin"),
        "ord",
    )
    named = read.filter(
        c("holdingId").isNotNull() & (c("ticker").isNotNull() | c("isin").isNotNull())
    )
    # A null order is ignored, so a blank never replaces a value.
    return named.groupBy("holdingId").agg(
        F.max_by("ticker", F.when(c("ticker").isNotNull(), c("ord"))).alias("ticker"),
        F.max_by("isin", F.when(c("isin").isNotNull(), c("ord"))).alias("isin"),
    )


def holdings_with_ticker(holdings: DataFrame, folded: DataFrame) -> DataFrame:
    """Fund holdings joined to the folded identifiers that name a ticker."""
    c = F.col
    read = holdings.filter(~c("malformed")).select(
        text.text(c("HOLDING_ID")).alias("holdingId"),
        F.upper(text.trimmed(c("ISSUER_CUSIP"))).alias("cusip"),
        text.trimmed(c("ISSUER_NAME")).alias("issuerName"),
        "ord",
    )
    return read.join(folded.filter(c("ticker").isNotNull()), "holdingId")


def verdict() -> Column:
    """What becomes of a joined row; the tests run in this order."""
    c = F.col
    stated = securities.cusip_of_isin(c("isin"))
    return (
        F.when(securities.placeholder_cusip(c("cusip")), "placeholder")
        .when(stated != c("cusip"), "mismatch")
        .otherwise("pair")
    )


def build_pairs(holdings: DataFrame, identifiers: DataFrame, source: str | Column) -> DataFrame:
    """Distinct (cusip, ticker) pairs; the first holding supplies name and ISIN (A2)."""
    judged = holdings_with_ticker(holdings, fold_identifiers(identifiers)).filter(verdict() == "pair")
    picked = judged.groupBy("cusip", "ticker").agg(
        F.min_by(F.struct("issuerName", "isin"), "ord").alias("first")
    )
    label = F.lit(source) if isinstance(source, str) else source
    return picked.select("cusip", "ticker", "first.issuerName", "first.isin", label.alias("source"))


def crosswalk_stats(holdings: DataFrame, identifiers: DataFrame) -> DataFrame:
    """One row with the eight counters of a build (A3)."""
    c = F.col
    folded = fold_identifiers(identifiers)
    judged = (
        holdings_with_ticker(holdings, folded)
        .select("cusip", "ticker", verdict().alias("verdict"))
        .groupBy("cusip", "ticker", "verdict")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("cusip")
        .agg(
            F.count_if(c("verdict") == "pair").alias("pairs"),
            F.sum(F.when(c("verdict") == "mismatch", c("n")).otherwise(0)).alias("mismatch"),
            F.sum(F.when(c("verdict") == "placeholder", c("n")).otherwise(0)).alias("placeholder"),
        )
        .agg(
            F.coalesce(F.sum("pairs"), F.lit(0)).alias("pairs"),
            F.count_if(c("pairs") > 0).alias("distinctCusips"),
            F.coalesce(F.sum("mismatch"), F.lit(0)).alias("isinMismatches"),
            F.coalesce(F.sum("placeholder"), F.lit(0)).alias("placeholderCusips"),
        )
    )
    lines = holdings.agg(
        F.count(F.lit(1)).alias("holdingRows"), F.count_if("malformed").alias("_bad_holdings")
    )
    marks = identifiers.agg(
        F.count(F.lit(1)).alias("identifierRows"), F.count_if("malformed").alias("_bad_identifiers")
    )
    # A fold without an ISIN has a ticker. Both columns are asked for, as by the join, so that one fold serves the two.
    named = folded.agg(F.count_if(c("ticker").isNotNull() | c("isin").isNull()).alias("holdingsWithTicker"))
    return (
        side_by_side(lines, marks, named, judged)
        .select(
            "holdingRows",
            "identifierRows",
            "holdingsWithTicker",
            "pairs",
            "distinctCusips",
            "isinMismatches",
            "placeholderCusips",
            (c("_bad_holdings") + c("_bad_identifiers")).alias("fieldCountMismatches"),
        )
    )
