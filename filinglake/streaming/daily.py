"""Daily refresh driven by the index (T1, L1): two streams, and what waits between passes.

Index days and submission documents are landed as files, in any order. Two streams take in what is new
and write it by batch. A pass joins them with what an earlier pass left waiting: entries that are
listed but not landed, documents that nothing has listed yet, and documents that could not be parsed. Of the entries
that the lake doesn't hold it takes at most `limit`, parses their documents once, merges the good ones
in one version of the lake, and writes what still waits. A pass that stops is done again by the
next one: accessions already in the lake are known, batches not yet counted are read again.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filinglake.operators import incremental
from filinglake.operators.keyed import first_per_key
from filinglake.plans import file_merge
from filinglake.plans.pipelines import _landed
from filinglake.sinks import lake, versions
from filinglake.sources import daily_index, submissions
from filinglake.streaming.refresh import first_good_copies

ENTRIES = "archive_key STRING, ord LONG, formType STRING, companyName STRING, cik STRING, dateFiled STRING, fileName STRING, accession STRING"
DOCUMENTS = "accession STRING, archive_key STRING, raw STRING, tries INT"
DAYS = "archive_key STRING, day STRING, broken STRING"
# Listing order: days are in the names of their index files, and lines in the order of the file.
LISTED = ("archive_key", "ord")


@dataclass(frozen=True)
class DailyPaths:
    """Landed index files, landed submissions, the versioned lake, and a folder for state and checkpoints."""

    index: str
    submissions: str
    lake: str
    state: str


@dataclass(frozen=True)
class Pass:
    """What one pass did. `failures` are (accession, reason); an index file fails under its own name."""

    listed: int
    processed: int
    deferred: int
    failures: DataFrame
    unpublished: list[str]
    version: int


def planned(entries: DataFrame, known: DataFrame, copies: DataFrame, limit: int) -> tuple[DataFrame, DataFrame]:
    """The entries a pass takes, with `landed`, and a row of counts: listed, pending, deferred.

    `entries` are insider entries, `copies` landed documents (accession, tries). Of an accession the
    first listing stands. Entries with a document that was not tried before go first, those whose
    documents failed before come next, those without a document last, each in listing order: what
    can't be read holds up nothing.
    """
    once = incremental.one_entry_per_accession(entries, F.struct(*LISTED))
    pending = incremental.unknown_entries(once, known)
    state = copies.groupBy("accession").agg(F.min("tries").alias("_tries"))
    placed = pending.join(state, "accession", "left").select(
        "*",
        F.col("_tries").isNotNull().alias("landed"),
        F.when(F.col("_tries") == 0, 0).when(F.col("_tries").isNotNull(), 1).otherwise(2).alias("_turn"),
    )
    taken, waits = incremental.take_first(placed, limit, "_turn", *LISTED)
    counts = waits.join(once.agg(F.count(F.lit(1)).alias("listed")))  # one row each
    return taken.drop("_tries", "_turn"), counts


def failed(taken: DataFrame, rejects: DataFrame, good: DataFrame) -> DataFrame:
    """(accession, reason) of the taken entries that gave no filing."""
    reasons = first_per_key(rejects.select("accession", F.array_join("broken", ", ").alias("reason"), "archive_key"), ["accession"], "archive_key")
    return (
        taken.join(good.select("accession").distinct(), "accession", "left_anti")
        .join(reasons.drop("archive_key"), "accession", "left")
        .select("accession", F.when(~F.col("landed"), "not landed").otherwise(F.coalesce("reason", F.lit("another accession"))).alias("reason"))
    )


def _take_in(spark: SparkSession, landing: str, checkpoint: str, write, max_files: int) -> None:
    """Hand every newly landed file, whole, to `write(files, batch number)`."""
    files = (
        spark.readStream.format("text")
        .option("wholetext", "true")
        .option("maxFilesPerTrigger", max_files)
        .load(landing)
        .select(F.col("_metadata.file_path").alias("archive_key"), F.col("value").alias("raw"))
    )
    stream = files.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    stream.start().awaitTermination()


def index_lines(files: DataFrame) -> DataFrame:
    """(archive_key, ord, line) of whole index files."""
    lines = files.select("archive_key", F.posexplode(F.split("raw", "\n")).alias("ord", "line"))
    return lines.select("archive_key", F.col("ord").cast("long").alias("ord"), F.rtrim(F.regexp_replace("line", "\r$", "")).alias("line"))


def _index_batch(state: str):
    def write(files: DataFrame, number: int) -> None:
        spark = files.sparkSession
        scratch: list[str] = []
        try:
            files = _landed(spark, files, "index", scratch)
            read = daily_index.read_index(index_lines(files))
            broken = read.rejects.groupBy(F.col("sample")).agg(F.min(F.array_join("broken", ", ")).alias("broken"))
            headless = broken.where(F.col("broken") == "index separator").select(F.col("sample").alias("archive_key"), "broken")
            day = F.nullif(F.regexp_extract("archive_key", r"(\d{8})[^/]*$", 1), F.lit(""))
            days = files.select("archive_key", day.alias("day")).join(headless, "archive_key", "left")
            lines = broken.where(F.col("broken") != "index separator").select(F.col("sample").alias("archive_key"), F.lit(None).cast("string").alias("day"), "broken")
            entries = daily_index.insider_entries(read.rows).select(*[c.split()[0] for c in ENTRIES.split(", ")])
            entries.write.mode("overwrite").parquet(f"{state}/entries/batch={number}")
            days.unionByName(lines).write.mode("overwrite").parquet(f"{state}/days/batch={number}")
        finally:
            lake.remove(spark, scratch)

    return write


def _document_batch(state: str):
    def write(files: DataFrame, number: int) -> None:
        named = F.regexp_replace(F.substring_index("archive_key", "/", -1), r"\.txt$", "")
        files.select(
            F.coalesce(submissions.accession_of(F.col("raw")), named).alias("accession"), "archive_key", "raw", F.lit(0).alias("tries")
        ).write.mode("overwrite").parquet(f"{state}/documents/batch={number}")

    return write


def _batches(spark: SparkSession, path: str, schema: str, after: int) -> tuple[DataFrame, int]:
    """Rows of the batches after number `after`, and the newest number."""
    fs, at = lake._file_system(spark, path)
    names = [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []
    there = sorted(int(n.split("=")[1]) for n in names if n.startswith("batch="))
    new = [f"{path}/batch={n}" for n in there if n > after]
    rows = spark.read.schema(schema).parquet(*new) if new else spark.createDataFrame([], schema)
    return rows, max([after, *there])


def _waiting(spark: SparkSession, state: str) -> dict:
    """Where the last finished pass left its tables: the newest of the numbered notes."""
    fs, at = lake._file_system(spark, f"{state}/passes")
    names = sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []
    done = [n for n in names if n.endswith(".json")]
    if not done:
        return {"number": 0, "entries": None, "documents": None, "last_entries": -1, "last_documents": -1, "last_days": -1}
    return json.loads(spark.read.text(f"{state}/passes/{done[-1]}", wholetext=True).first()[0])


def _note(spark: SparkSession, state: str, told: dict) -> None:
    """Finish a pass: the note gets its name when it is whole."""
    fs, target = lake._file_system(spark, f"{state}/passes/{told['number']:012d}.json")
    _, draft = lake._file_system(spark, f"{state}/passes/{uuid.uuid4().hex}.draft")
    out = fs.create(draft, False)
    out.write(bytearray(json.dumps(told).encode()))
    out.close()
    fs.rename(draft, target)


def run_daily(spark: SparkSession, paths: DailyPaths, limit: int, days: Sequence[str] = (), max_files: int = 1000) -> Pass:
    """One pass over everything landed since the last one. `days` (yyyyMMdd) are those an index was expected for.

    One pass at a time runs on a state folder.
    """
    state, scratch = paths.state, []
    _take_in(spark, paths.index, f"{state}/checkpoint-index", _index_batch(state), max_files)
    _take_in(spark, paths.submissions, f"{state}/checkpoint-documents", _document_batch(state), max_files)
    before = _waiting(spark, state)
    told = {"number": before["number"] + 1}
    try:
        def since(name: str, schema: str) -> DataFrame:
            new, told[f"last_{name}"] = _batches(spark, f"{state}/{name}", schema, before[f"last_{name}"])
            return spark.read.schema(schema).parquet(before[name]).unionByName(new) if before.get(name) else new

        entries, documents = since("entries", ENTRIES), since("documents", DOCUMENTS)
        days_seen, _ = _batches(spark, f"{state}/days", DAYS, -1)
        new_days = since("days", DAYS)
        held = versions.snapshot(spark, paths.lake)
        known = held.rows("insider_filings").select("accession")
        picked, counts = planned(entries, known, documents.select("accession", "tries"), limit)
        taken = _landed(spark, picked, "taken", scratch)
        count = counts.first()
        offered = documents.join(taken.select("accession"), "accession", "left_semi").select("archive_key", "raw")
        read = submissions.parse_submissions(offered)
        # Parsed once, for the merge, the failures and what waits.
        filings = _landed(spark, read.filings.join(taken.select("accession"), "accession", "left_semi"), "filings", scratch)
        legs = _landed(spark, read.transactions, "legs", scratch)
        rejects = _landed(spark, read.rejects.select("accession", "archive_key", "broken"), "refused", scratch)
        filings = first_good_copies(filings, filings)
        merged = file_merge.merge_insider(spark, paths.lake, filings, first_good_copies(legs, filings)) if not filings.isEmpty() else held
        good = filings.select("accession").distinct()
        bad = failed(taken, rejects, good).unionByName(
            new_days.where("broken IS NOT NULL").select(F.concat(F.lit("index "), "archive_key").alias("accession"), F.col("broken").alias("reason"))
        )
        failures = _landed(spark, bad, "failures", [])
        done = known.unionByName(good).distinct()
        tried = taken.select("accession", F.lit(1).alias("_more"))
        still = documents.join(done, "accession", "left_anti").join(tried, "accession", "left")
        for name, rows in (
            ("entries", entries.join(done, "accession", "left_anti")),
            ("documents", still.select("accession", "archive_key", "raw", (F.col("tries") + F.coalesce("_more", F.lit(0))).cast("int").alias("tries"))),
        ):
            told[name] = f"{state}/waiting-{name}-{uuid.uuid4().hex}"
            rows.select(*[c.split()[0] for c in (ENTRIES if name == "entries" else DOCUMENTS).split(", ")]).write.parquet(told[name])
        _note(spark, state, told)
        lake.remove(spark, [before[name] for name in ("entries", "documents") if before.get(name)])
        seen = {r.day for r in days_seen.select("day").distinct().collect()}  # one row a day
        return Pass(count.listed, min(limit, count.pending), count.deferred, failures, sorted(set(days) - seen), merged.version)
    finally:
        lake.remove(spark, scratch)
