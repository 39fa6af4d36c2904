"""Share-class identity from venue rows (A10) and fixed-size lookup batches (L2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from filinglake.functions import text
from filinglake.operators.incremental import bucket_of
from filinglake.operators.ranks import batches

# Jobs per request without and with a key.
BATCH = 10
BATCH_WITH_KEY = 100


def share_class(venues: DataFrame) -> DataFrame:
    """One row per CUSIP from its venue rows (A10).

    The most common share-class FIGI, ties to the smallest; the US row, else the first row,
    speaks for the security. Counts are reduced per (CUSIP, FIGI) before the mode is taken.
    """
    c = F.col
    by_figi = (
        venues.filter(c("shareClassFIGI") != "")
        .groupBy("cusip", "shareClassFIGI")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("cusip")
        .agg(F.min_by("shareClassFIGI", F.struct(-c("n"), c("shareClassFIGI"))).alias("shareClassFigi"))
    )
    ticker = F.upper(text.text(c("ticker")))
    is_us = F.coalesce(c("exchCode") == "US", F.lit(False))
    # The first US row, else the first row: one row speaks, so its order and its cells travel once.
    speaker = F.struct(
        (~is_us).alias("foreign"),
        "ord",
        F.when(is_us & c("ticker").isNotNull(), F.upper(text.trimmed(c("ticker")))).alias("usTicker"),
        F.coalesce("securityType", "securityType2").alias("securityType"),
        "marketSector",
        "name",
    )
    rest = venues.groupBy("cusip").agg(
        # The distinct symbols of one security: the column's meaning, combined map-side.
        F.array_sort(F.collect_set(ticker)).alias("tickers"),
        F.min(speaker).alias("speaker"),
        F.count(F.lit(1)).alias("venueRows"),
    )
    return rest.join(by_figi, "cusip", "left").select(
        "cusip",
        "shareClassFigi",
        "speaker.usTicker",
        "tickers",
        "speaker.securityType",
        "speaker.marketSector",
        "speaker.name",
        "venueRows",
    )


def lookup_batches(
    holdings: DataFrame, size: int = BATCH, buckets: int | None = None, cusip: str = "cusip"
) -> DataFrame:
    """Distinct CUSIPs in batches of `size` for an external lookup (L2).

    The batches are the sorted list cut in order, numbered over any number of tasks. With `buckets`
    they are cut within stable hash buckets instead, so that a new CUSIP shifts only its bucket.
    """
    if buckets is None:
        return batches(holdings, cusip, size).withColumnRenamed(cusip, "cusips")
    distinct = holdings.select(cusip).distinct().withColumn("bucket", bucket_of(F.col(cusip), buckets))
    ranked = distinct.withColumn(
        "rank", F.row_number().over(Window.partitionBy("bucket").orderBy(cusip))
    )
    return (
        ranked.withColumn("batch", F.floor((F.col("rank") - 1) / size).cast("long"))
        .groupBy("bucket", "batch")
        .agg(F.array_sort(F.collect_list(cusip)).alias("cusips"))
    )
