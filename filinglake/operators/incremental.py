"""Knowing what is done: identities, buckets, the ledger and what is still pending."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filinglake.operators.keyed import first_per_key

# Fixed value: what a round may be called.
_ROUND_ID = re.compile(r"[A-Za-z0-9._-]{1,64}")


def bucket_of(identity: Column, buckets: int) -> Column:
    """First four bytes of SHA-256 of the identity, big-endian, modulo the bucket count."""
    if buckets < 1:
        raise ValueError("a bucket count is at least 1")
    head = F.conv(F.substring(F.sha2(identity.cast("binary"), 256), 1, 8), 16, 10).cast("long")
    return (head % F.lit(buckets)).cast("int")


def with_bucket(df: DataFrame, identity: str, buckets: int) -> DataFrame:
    return df.withColumn("bucket", bucket_of(F.col(identity), buckets))


def work_identity(dataset: Column, label: Column) -> Column:
    return F.concat_ws(":", dataset, label)


def raw_key(prefix: str, label: Column, content: Column, suffix: str) -> Column:
    """Where the bytes of a fetch are kept: named by their own digest (P10)."""
    digest = F.sha2(content.cast("binary"), 256)
    return F.concat(F.lit(f"{prefix}/"), label, F.lit("/"), digest, F.lit(suffix))


def with_raw_key(df: DataFrame, prefix: str, label: str, content: str, suffix: str = ".zip") -> DataFrame:
    return df.withColumn("rawKey", raw_key(prefix, F.col(label), F.col(content), suffix))


def key_conflicts(df: DataFrame, key: str, content: str) -> DataFrame:
    """Keys that were offered with different bytes; the same bytes again are no conflict (P10)."""
    digests = df.select(key, F.sha2(F.col(content).cast("binary"), 256).alias("sha256"))
    return (
        digests.groupBy(key)
        .agg(F.min("sha256").alias("low"), F.max("sha256").alias("high"), F.count(F.lit(1)).alias("n"))
        .filter(F.col("low") != F.col("high"))
        .select(key, "n")
    )


def unknown_entries(entries: DataFrame, known: DataFrame, key: str = "accession") -> DataFrame:
    """Entries whose accession the lake does not hold yet."""
    return entries.join(known.select(key).distinct(), key, "left_anti")


def one_entry_per_accession(entries: DataFrame, order: str | Column) -> DataFrame:
    """An index lists a filing once per party; the first listing stands."""
    return first_per_key(entries, ["accession"], order)


def take_first(pending: DataFrame, limit: int, *order: str) -> tuple[DataFrame, DataFrame]:
    """The first `limit` pending entries and a one-row table saying how many wait (L1)."""
    taken = pending.orderBy(*order).limit(limit)
    counts = pending.agg(
        F.count(F.lit(1)).alias("pending"),
        F.greatest(F.count(F.lit(1)) - F.lit(limit), F.lit(0)).alias("deferred"),
    )
    return taken, counts


def pending_work(items: DataFrame, ledger: DataFrame, buckets: int = 1, bucket: int | None = None) -> DataFrame:
    """Items (one bucket of them, if asked) whose identity has no ledger row."""
    if bucket is not None:
        items = items.filter(bucket_of(F.col("identity"), buckets) == bucket)
    return items.join(ledger.select("identity").distinct(), "identity", "left_anti")


def check_round_id(round_id: str) -> str:
    if not _ROUND_ID.fullmatch(round_id):
        raise ValueError(f"not a round id: {round_id!r}")
    return round_id


def round_rows(ledger: DataFrame, round_id: str) -> DataFrame:
    return ledger.filter(F.col("roundId") == check_round_id(round_id))


def append_to_ledger(ledger: DataFrame, finished: DataFrame, round_id: str) -> DataFrame:
    """The ledger after a round finished `finished` (identity, body): one row per identity (K4).

    Finishing an identity again replaces its row, as writing the same key again would.
    """
    new = first_per_key(
        finished.select(F.lit(check_round_id(round_id)).alias("roundId"), "identity", "body"),
        ["roundId", "identity"],
        "body",
    )
    kept = ledger.join(new.select("roundId", "identity"), ["roundId", "identity"], "left_anti")
    return kept.select("roundId", "identity", "body").unionByName(new)


def drop_from_ledger(ledger: DataFrame, round_id: str, keep: Column) -> DataFrame:
    """The ledger without the round's rows that fail `keep`, so the next run redoes them."""
    mine = F.col("roundId") == check_round_id(round_id)
    return ledger.filter(~mine | F.coalesce(keep, F.lit(False)))


def reprocess_report(ledger: DataFrame, round_id: str, keep: Column) -> DataFrame:
    """What dropping would do: rows inspected and rows dropped (G5, dry run)."""
    return round_rows(ledger, round_id).agg(
        F.count(F.lit(1)).alias("inspected"),
        F.count_if(~F.coalesce(keep, F.lit(False))).alias("dropped"),
    )


def receipt_counts(filings: DataFrame, rows: DataFrame, archives: DataFrame) -> DataFrame:
    """Per archive: filings, rows and bytes, as a finished-work row states them."""
    def counted(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("rawArchiveKey").agg(F.count(F.lit(1)).alias(name))

    return (
        archives.select(F.col("rawKey").alias("rawArchiveKey"), "bytes")
        .join(counted(filings, "filings"), "rawArchiveKey", "left")
        .join(counted(rows, "rows"), "rawArchiveKey", "left")
        .select(
            F.col("rawArchiveKey").alias("rawKey"),
            F.coalesce("filings", F.lit(0)).alias("filings"),
            F.coalesce("rows", F.lit(0)).alias("rows"),
            "bytes",
        )
    )
