"""Chains from archives to small results: the lag report (A9, K3) and CUSIP pairs of a fund quarter."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filinglake import schemas
from filinglake.functions import dates, text
from filinglake.operators import crosswalk, integrity
from filinglake.operators.checks import Checked, split_broken, typed
from filinglake.operators.keyed import side_by_side
from filinglake.plans import pipelines
from filinglake.plans.audit import HOLDINGS
from filinglake.session import work_path
from filinglake.sinks import lake
from filinglake.sources import archives, tsv

_SUBMISSION = "SUBMISSION.tsv"
_LAG_COLUMNS = ["ACCESSION_NUMBER", "FILING_DATE", "SUBMISSIONTYPE", "PERIODOFREPORT"]
_LAGS = "struct<n: bigint, p50: int, p95: int, max: int>"
# A header stands in a member's first lines; these are looked at for it.
_LEADING = 10


def submission_dates(submissions: DataFrame) -> Checked:
    """submissionType, filingDate and periodOfReport of raw submission records; a date that is none is broken."""
    cells = {name: text.trimmed(F.col(name)) for name in ("FILING_DATE", "PERIODOFREPORT")}
    read = {"filingDate": "FILING_DATE", "periodOfReport": "PERIODOFREPORT"}
    return split_broken(
        "submission dates",
        submissions,
        {raw: dates.sec_date_broken(cells[raw], typed(name)) for name, raw in read.items()},
        {"submissionType": F.col("SUBMISSIONTYPE"), **{name: dates.sec_date(cells[raw]) for name, raw in read.items()}},
        F.col("ACCESSION_NUMBER"),
    )


def lag_totals(dated: DataFrame, windows: DataFrame) -> DataFrame:
    """One row: windows, filings with both dates, and n, p50, p95 and max days of originals and amendments.

    `windows` is a table of one row per window. A kind without a filing has n 0 and no days.
    """
    both = dated.where("filingDate IS NOT NULL AND periodOfReport IS NOT NULL")
    lags = integrity.filing_lags(both)
    of = lambda kind: F.coalesce(
        F.first(F.when(F.col("kind") == kind, F.struct("n", "p50", "p95", "max").cast(_LAGS)), ignorenulls=True),
        F.struct(F.lit(0), F.lit(None), F.lit(None), F.lit(None)).cast(_LAGS),
    ).alias(kind)
    report = lags.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("filings"), of("original"), of("amendment"))
    return side_by_side(windows.agg(F.count(F.lit(1)).alias("windows")), report).select("windows", "filings", "original", "amendment")


def lag_report(spark: SparkSession, landing: str, reports: str, round_id: str | None = None, run: bool = False) -> DataFrame:
    """Lags of all landed 13F archives, from their SUBMISSION members alone: one row, written as JSON if `run` (K3)."""
    if run and not round_id:
        raise ValueError("a report that is written needs a round id")
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").option("recursiveFileLookup", "true")
    objects = listed.load(f"{landing}/{HOLDINGS.prefix}").select("path")
    with _landed_members(spark, sorted(r.path for r in objects.collect()), [_SUBMISSION]) as lines:  # one row per archive
        read = pipelines.member_records(lines, {_SUBMISSION: {"required": _LAG_COLUMNS, "optional": []}})[_SUBMISSION]
        report = lag_totals(submission_dates(read).strict(), objects)
        kept = spark.createDataFrame(report.collect(), report.schema).coalesce(1)
    return lake.write_report(kept, reports, round_id or "", "filing-lags", run)


@contextmanager
def _landed_members(spark: SparkSession, paths: Sequence[str], members: Sequence[str]) -> Iterator[DataFrame]:
    """Lines of members, written once, and deleted when the block ends."""
    landed = work_path(spark, "report-lines")
    try:
        archives.scan_members(spark, paths, members, nested=True).write.partitionBy("member").parquet(landed)
        yield spark.read.schema(archives.LINES).parquet(landed)
    finally:
        lake.remove(spark, [landed])


def nport_crosswalk(spark: SparkSession, archive: str | Sequence[str], source: str, out: str) -> tuple[DataFrame, DataFrame]:
    """Pairs and counters of a fund quarter's archive, written below `out` and read back.

    A quarter in several archives must have unlike holding ids, as one quarter's filings have.
    """
    paths = [archive] if isinstance(archive, str) else list(archive)
    with _landed_members(spark, paths, list(schemas.MEMBERS_NPORT)) as lines:
        members = [
            tsv.strict_records(tsv.landed_lines(lines, name), columns, member=name, leading=F.col("ord") < _LEADING)
            for name, columns in schemas.MEMBERS_NPORT.items()
        ]
        crosswalk.build_pairs(*members, source=source).write.mode("overwrite").parquet(f"{out}/pairs")
        crosswalk.crosswalk_stats(*members).write.mode("overwrite").parquet(f"{out}/stats")
    return spark.read.parquet(f"{out}/pairs"), spark.read.parquet(f"{out}/stats")
