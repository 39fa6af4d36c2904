"""The documented analyses over the four tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from filinglake.sinks.lake import as_of

# Fixed value: transaction code of an open-market purchase.
PURCHASE = "P"


def code_inventory(transactions: DataFrame) -> DataFrame:
    """Transactions per code, most frequent first."""
    return (
        transactions.groupBy("transactionCode")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.col("n").desc(), F.col("transactionCode").asc_nulls_last())
    )


def top_buyers(transactions: DataFrame, instant: datetime | str, limit: int = 10) -> DataFrame:
    """Tickers with the most open-market purchases known at `instant`."""
    bought = as_of(transactions, instant).filter(F.col("transactionCode") == PURCHASE)
    return (
        bought.groupBy("resolvedTicker")
        .agg(F.count(F.lit(1)).alias("purchases"))
        .orderBy(F.col("purchases").desc(), F.col("resolvedTicker").asc_nulls_last())
        .limit(limit)
    )


def figi_fill(holdings: DataFrame) -> DataFrame:
    """Share of holdings with a FIGI per year of availability, and the CUSIPs that carry one."""
    year = F.year("availableAt").alias("year")
    # Reduced to (year, cusip) first: a hot CUSIP is one row by then.
    per_cusip = holdings.groupBy(year, "cusip").agg(
        F.count(F.lit(1)).alias("rows"), F.count("figi").alias("filled")
    )
    return (
        per_cusip.groupBy("year")
        .agg(
            F.sum("rows").alias("rows"),
            F.sum("filled").alias("filled"),
            F.count_if(F.col("filled") > 0).alias("cusipsWithFigi"),
        )
        .withColumn("fillRate", F.col("filled") / F.col("rows"))
    )


def cluster_buying(filings: DataFrame, transactions: DataFrame, at_least: int = 2) -> DataFrame:
    """Issuers whose stock several owners bought in one month of availability.

    Purchases are reduced to (issuer, month, accession) before they meet the owners, because a
    joint filing repeats its owners, not its legs.
    """
    month = F.trunc(F.col("availableAt").cast("date"), "month").alias("month")
    bought = (
        transactions.filter(F.col("transactionCode") == PURCHASE)
        .groupBy("accession", "issuerCik", month)
        .agg(F.count(F.lit(1)).alias("legs"))
    )
    owners = filings.select("accession", "ownerCik").distinct()
    per_owner = (
        bought.join(owners, "accession")
        .groupBy("issuerCik", "month", "ownerCik")
        .agg(F.sum("legs").alias("legs"))
    )
    return (
        per_owner.groupBy("issuerCik", "month")
        .agg(F.count(F.lit(1)).alias("buyers"), F.max("legs").alias("mostLegsOfOneBuyer"))
        .filter(F.col("buyers") >= at_least)
    )


def manager_concentration(filings: DataFrame, holdings: DataFrame) -> DataFrame:
    """Largest position's share of each manager's reported value by period, and its change.

    `holdings` are in one unit (A4). Values are summed per (manager, period, CUSIP) first; what
    a manager's window then orders is one row per period.
    """
    period = F.col("periodOfReport")
    managers = filings.filter(period.isNotNull()).select("accession", "cik", "periodOfReport").distinct()
    money = F.col("value").cast("decimal(28,6)")
    by_position = (
        holdings.filter(F.col("value").isNotNull())
        .groupBy("accession", "cusip")
        .agg(F.sum(money).alias("value"))
        .join(managers, "accession")
        .groupBy("cik", "periodOfReport", "cusip")
        .agg(F.sum("value").alias("value"))
    )
    by_period = by_position.groupBy("cik", "periodOfReport").agg(
        F.count(F.lit(1)).alias("positions"),
        (F.max("value").cast("double") / F.nullif(F.sum("value").cast("double"), F.lit(0.0))).alias("topShare"),
    )
    earlier = F.lag("topShare").over(Window.partitionBy("cik").orderBy("periodOfReport"))
    return by_period.withColumn("change", F.col("topShare") - earlier)


def owner_activity(filings: DataFrame, transactions: DataFrame) -> DataFrame:
    """Per owner: filings with legs, legs, shares bought and sold.

    Legs are summed per accession before the join to owners, so a joint filing's shares reach
    each of its owners once and are never multiplied by the number of legs.
    """
    def shares(code: str):
        is_code = F.col("acquiredDisposed") == code
        return F.sum(F.when(is_code, F.col("shares").cast("decimal(28,6)")).otherwise(F.lit(0)))

    per_filing = transactions.groupBy("accession").agg(
        F.count(F.lit(1)).alias("legs"),
        shares("A").alias("acquired"),
        shares("D").alias("disposed"),
    )
    owners = filings.select("accession", "ownerCik").distinct()
    return owners.join(per_filing, "accession").groupBy("ownerCik").agg(
        F.count(F.lit(1)).alias("filings"),
        F.sum("legs").alias("legs"),
        F.sum("acquired").cast("double").alias("acquired"),
        F.sum("disposed").cast("double").alias("disposed"),
    )
