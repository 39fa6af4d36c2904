"""Daily refresh of the insider tables from landed submissions.

Submissions are landed as files. Each run takes what is new (`availableNow`), at most
`max_files` per batch, parses it, and merges the good documents into the lake. The file source's
checkpoint makes a run resumable. A document that cannot be parsed is kept with its text in the
reject table and offered again with every later run; it is never recorded as done.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filinglake.operators import incremental
from filinglake.plans import pipelines
from filinglake.sinks import lake
from filinglake.sources import submissions
from filinglake.sources.daily_index import insider_entries

_REJECTS = T.StructType([
    T.StructField("archive_key", T.StringType()),
    T.StructField("raw", T.StringType()),
    T.StructField("accession", T.StringType()),
    T.StructField("broken", T.ArrayType(T.StringType())),
])


@dataclass(frozen=True)
class RefreshPaths:
    landing: str
    lake: str
    checkpoint: str
    rejects: str


def pending_entries(entries: DataFrame, known: DataFrame, order: str) -> DataFrame:
    """Index entries to process: insider forms, one per accession, not yet in the lake."""
    chosen = incremental.one_entry_per_accession(insider_entries(entries), order)
    return incremental.unknown_entries(chosen, known)


def first_good_copies(rows: DataFrame, filings: DataFrame) -> DataFrame:
    """`rows` of the first landed copy of each accession that could be parsed."""
    first = filings.groupBy("accession").agg(F.min("rawArchiveKey").alias("rawArchiveKey"))
    return rows.join(first, ["accession", "rawArchiveKey"], "left_semi")


def ingest(spark: SparkSession, documents: DataFrame, paths: RefreshPaths) -> DataFrame:
    """Parse documents (archive_key, raw), merge the new ones, return every unparsed copy.

    Known are accessions in the filings of the lake, which a merge publishes last.
    """
    parsed = submissions.parse_submissions(documents)
    known = lake.read_table(spark, "insider_filings", paths.lake).select("accession")
    new = incremental.unknown_entries(parsed.filings, known)
    filings = first_good_copies(new, new)
    transactions = first_good_copies(incremental.unknown_entries(parsed.transactions, known), new)
    pipelines.refresh_insider(spark, paths.lake, filings, transactions)
    return parsed.rejects


def _read_rejects(spark: SparkSession, path: str) -> DataFrame | None:
    fs, at = lake._file_system(spark, path)
    return spark.read.schema(_REJECTS).parquet(path) if fs.exists(at) else None


def _switch_rejects(spark: SparkSession, path: str) -> None:
    """Put a finished `.next` table in the place of the rejects; also after a run that stopped before."""
    fs, done = lake._file_system(spark, f"{path}.next/_SUCCESS")
    if fs.exists(done):
        spark.read.schema(_REJECTS).parquet(f"{path}.next").write.mode("overwrite").parquet(path)
        lake.remove(spark, [f"{path}.next"])


def _add_rejects(spark: SparkSession, rejects: DataFrame, path: str) -> None:
    """Append rejects that are not there yet, so that a batch that is done again adds none twice."""
    there = _read_rejects(spark, path)
    new = rejects.select(*_REJECTS.fieldNames())
    if there is not None:
        new = new.join(there.select("archive_key").distinct(), "archive_key", "left_anti").select(*_REJECTS.fieldNames())
    new.write.mode("append").parquet(path)


def run_refresh(spark: SparkSession, paths: RefreshPaths, max_files: int = 1000) -> None:
    """One pass over everything landed since the last run, after the earlier rejects."""
    _switch_rejects(spark, paths.rejects)
    earlier = _read_rejects(spark, paths.rejects)
    if earlier is not None:
        again = earlier.select("archive_key", "raw").distinct()
        # A whole new version is written before the old one is replaced.
        still = ingest(spark, again, paths).select(*_REJECTS.fieldNames())
        still.write.mode("overwrite").parquet(f"{paths.rejects}.next")
        _switch_rejects(spark, paths.rejects)

    def batch(documents: DataFrame, _: int) -> None:
        session = documents.sparkSession
        rejects = ingest(session, documents, paths)
        _add_rejects(session, rejects, paths.rejects)

    stream = (
        spark.readStream.format("text")
        .option("wholetext", "true")
        .option("maxFilesPerTrigger", max_files)
        .load(paths.landing)
        .select(F.col("_metadata.file_path").alias("archive_key"), F.col("value").alias("raw"))
    )
    query = (
        stream.writeStream.foreachBatch(batch)
        .option("checkpointLocation", paths.checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
