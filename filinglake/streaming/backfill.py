"""Resumable backfill of quarterly archives.

The ledger alone says which identities of a round are finished: a run lists the landed archives, leaves
those out, and works through the rest in batches. An archive whose rows are refused does not hold up the
others of its batch, and gets no ledger row; a row taken out of the ledger is work again.
"""

from __future__ import annotations

from pyspark.errors import PythonException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from filinglake import schemas
from filinglake.operators import incremental
from filinglake.operators.checks import BrokenRows
from filinglake.operators.integrity import archive_label
from filinglake.plans import pipelines
from filinglake.session import work_path
from filinglake.sinks import lake
from filinglake.sources import archives

LEDGER = "roundId STRING, identity STRING, body STRING"
FILES = "path STRING, modificationTime TIMESTAMP, length LONG, content BINARY"


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    fs, at = lake._file_system(spark, path)
    if not fs.exists(at):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(path)


def _identity(dataset: str, prefix: str, path: Column) -> Column:
    relative = F.concat(F.lit(f"{prefix}/"), F.substring_index(path, f"/{prefix}/", -1))
    label = F.coalesce(archive_label(relative, prefix), F.substring_index(path, "/", -1))
    return incremental.work_identity(F.lit(dataset), label)


def finish(
    filings: DataFrame, rows: DataFrame, sizes: DataFrame, dataset: str, prefix: str
) -> DataFrame:
    """(identity, body) for every archive of a batch: its counts, bytes and key as JSON."""
    counts = incremental.receipt_counts(filings, rows, sizes)
    return counts.select(
        _identity(dataset, prefix, F.col("rawKey")).alias("identity"),
        F.to_json(F.struct("filings", "rows", "bytes", "rawKey")).alias("body"),
    )


def drop_finished(spark: SparkSession, ledger: str, round_id: str, keep: Column) -> None:
    """Take the round's rows that fail `keep` out of the ledger, so that the next run does them again."""
    kept = incremental.drop_from_ledger(read_ledger(spark, ledger), round_id, keep)
    staged = work_path(spark, "ledger")
    kept.write.parquet(staged)
    spark.read.schema(LEDGER).parquet(staged).write.mode("overwrite").parquet(ledger)
    lake.remove(spark, [staged])


def pending_archives(spark: SparkSession, dataset: str, landing: str, ledger: str, round_id: str, prefix: str) -> DataFrame:
    """(identity, path, bytes) of landed archives the round has not finished (J11); contents are not read."""
    listed = (
        spark.read.format("binaryFile")
        .schema(FILES)
        .option("pathGlobFilter", "*.zip")
        .option("recursiveFileLookup", "true")
        .load(landing)
        .select(_identity(dataset, prefix, F.col("path")).alias("identity"), "path", F.col("length").alias("bytes"))
    )
    return incremental.pending_work(listed, incremental.round_rows(read_ledger(spark, ledger), round_id))


def run_backfill(
    spark: SparkSession,
    dataset: str,
    landing: str,
    root: str,
    bronze: str,
    ledger: str,
    round_id: str,
    prefix: str,
    max_files: int = 25,
) -> dict[str, str]:
    """Read pending archives into the lake, batch by batch, and record each finished identity.

    Returns the identities that were refused and why. Lines are kept in bronze by round and identity,
    so another round, or the same one again, never writes over other archives' lines.
    """
    members = schemas.MEMBERS_13F if dataset == "form13f" else schemas.MEMBERS_345
    incremental.check_round_id(round_id)
    # One row per archive.
    pending = sorted(pending_archives(spark, dataset, landing, ledger, round_id, prefix).collect(), key=lambda r: (r.identity, r.path))

    def work(batch: list) -> None:
        paths = [r.path for r in batch]
        files = spark.read.format("binaryFile").schema(FILES).load(paths)
        lines = archives.read_archives(files, list(members), nested=dataset == "form13f")
        keyed = lines.withColumn("identity", _identity(dataset, prefix, F.col("archive_key")))
        target = f"{bronze}/round={round_id}"
        (
            keyed.repartitionByRange("identity", "member", "archive_key", "line_no")
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("identity", "member").parquet(target)
        )
        own = [r.identity for r in batch]
        landed = spark.read.parquet(target).filter(F.col("identity").isin(own))
        if dataset == "form13f":
            filings, rows = pipelines.institutional_rows(landed, keep=["ord"])
            pipelines.refresh_institutional(spark, root, filings.strict(), rows.strict())
        else:
            filings, rows = pipelines.insider_rows(landed)
            pipelines.refresh_insider(spark, root, filings.strict(), rows.strict())
        sizes = files.select(F.col("path").alias("rawKey"), F.col("length").alias("bytes"))
        done = finish(filings.rows, rows.rows, sizes, dataset, prefix)
        finished = incremental.round_rows(read_ledger(spark, ledger), round_id)
        (
            incremental.pending_work(done, finished)
            .select(F.lit(round_id).alias("roundId"), "identity", "body")
            .write.mode("append").parquet(ledger)
        )

    refused: dict[str, str] = {}

    def attempt(batch: list) -> None:
        try:
            work(batch)
        except (BrokenRows, PythonException) as problem:  # rows, or the layout of an archive
            if len({r.identity for r in batch}) == 1:
                refused[batch[0].identity] = str(problem)
                return
            middle = batch[len(batch) // 2].identity
            first = [r for r in batch if r.identity < middle] or [r for r in batch if r.identity == middle]
            attempt(first)
            attempt([r for r in batch if r not in first])

    for start in range(0, len(pending), max_files):
        attempt(pending[start : start + max_files])
    return refused
