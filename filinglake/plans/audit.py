"""The audit as one job: landed archives, gate, windows, rollup, report.

What is known of a window is kept as state: its report row and its distinct accessions, both under the
key of the archive they came from. A key holds the digest of the content, so a run reads only archives
whose key the state does not have; the rollup is made of the state alone. Accessions are written before
the report row, which marks a window as audited: a run that stops in between audits the window again and
replaces its rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filinglake import schemas
from filinglake.operators import incremental, integrity
from filinglake.operators.keyed import side_by_side
from filinglake.plans import pipelines
from filinglake.session import work_path
from filinglake.sinks import lake
from filinglake.sources import archives
from filinglake.streaming.backfill import FILES, read_ledger


@dataclass(frozen=True)
class Kind:
    """What the audits of the two datasets differ in."""

    dataset: str
    prefix: str
    members: dict[str, dict]
    nested: bool
    total_rows: str
    counters: tuple[str, ...]
    inventories: tuple[str, ...]
    samples: str
    rest: str

    @property
    def schema(self) -> str:
        numbers = ", ".join(f"{name} BIGINT" for name in self.counters)
        maps = ", ".join(f"{name} MAP<STRING, BIGINT>" for name in self.inventories)
        return f"window STRING, key STRING, {numbers}, {maps}, {self.samples} ARRAY<STRING>, {self.rest}"


HOLDINGS = Kind(
    "form13f", "raw/sec13f/datasets", schemas.MEMBERS_13F, True, "holdings",
    (
        "filings", "holdings", "orphanHoldings", "noticeFilingsWithHoldings", "nullManagerFilings",
        "nullIssuerHoldings", "zeroPositionHoldings", "placeholderCusips", "figiCoverage", "distinctCusips",
    ),
    ("putCall", "submissionTypes"), "duplicateHoldingKeys",
    "lag_p50 INT, lag_p95 INT, lag_max INT",
)
INSIDER = Kind(
    "form345", "raw/sec345/datasets", schemas.MEMBERS_345, False, "transactions",
    (
        "filings", "transactions", "orphanTransactions", "futureDatedTransactions", "nullTickerTransactions",
        "nullSharesTransactions", "negativeAmounts", "amendmentsWithoutOriginalDate", "accessions",
    ),
    ("transactionCodes",), "duplicateFilingKeys",
    "minFilingDate DATE, maxFilingDate DATE",
)
KINDS = {kind.dataset: kind for kind in (HOLDINGS, INSIDER)}

# Counters of single windows: their sum over windows would mean nothing.
_OF_ONE_WINDOW = ("distinctCusips", "accessions")
# Files of a window's accessions at most.
_FILES = 8
_ACCESSIONS = "window STRING, key STRING, accession STRING"


class AuditState:
    """Audited windows of one dataset below a folder: report rows and accessions, by window."""

    def __init__(self, spark: SparkSession, root: str, dataset: str) -> None:
        self.spark = spark
        self.kind = KINDS[dataset]
        self._windows = f"{root}/{dataset}/windows"
        self._accessions = f"{root}/{dataset}/accessions"

    def _read(self, path: str, schema: str) -> DataFrame:
        fs, at = lake._file_system(self.spark, path)
        if not fs.exists(at):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path)

    def windows(self) -> DataFrame:
        return self._read(self._windows, self.kind.schema)

    def accessions(self) -> DataFrame:
        """Distinct (window, key, accession). Rows of an archive that another one replaced may be among them."""
        return self._read(self._accessions, _ACCESSIONS)

    def put(self, archives_read: DataFrame, filings: DataFrame, rows: DataFrame, order: str = "ord") -> None:
        """Audit `filings` and `rows` (with `window`) and keep the result under `archives_read` (window, key).

        Every window of `archives_read` gets a row, also one whose archive holds no rows; windows that
        are not named there are left alone.
        """
        audit = integrity.holdings_integrity if self.kind is HOLDINGS else integrity.insider_integrity
        names = archives_read.select("window", "key")
        found = integrity.window_accessions(filings).join(names, "window")
        self._replace(found.select("window", "key", "accession"), self._accessions)
        report = names.join(audit(filings, rows, order), "window", "left")
        filled = [
            *[F.coalesce(name, F.lit(0)).cast("long").alias(name) for name in self.kind.counters],
            *[F.coalesce(name, F.create_map().cast("map<string,bigint>")).alias(name) for name in self.kind.inventories],
            F.coalesce(self.kind.samples, F.array().cast("array<string>")).alias(self.kind.samples),
        ]
        shape = self.spark.createDataFrame([], f"{self.kind.rest}").columns
        self._replace(report.select("window", "key", *filled, *shape), self._windows)

    def _replace(self, rows: DataFrame, path: str) -> None:
        # A report row goes to its window's file; accessions of one window, however many, to _FILES of them.
        part = [F.pmod(F.xxhash64("accession"), F.lit(_FILES))] if "accession" in rows.columns else []
        spread = rows.repartition("window", *part)
        (
            spread.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic").partitionBy("window").parquet(path)
        )

    def rollup(self, current: DataFrame | None = None) -> DataFrame:
        """One row over all audited windows, or over those of `current` (window, key)."""
        windows, accessions = self.windows(), self.accessions()
        if current is not None:
            windows = windows.join(current.select("window", "key"), ["window", "key"], "left_semi")
        sums = [name for name in self.kind.counters if name not in _OF_ONE_WINDOW]
        parts = [integrity.rollup(windows, sums, list(self.kind.inventories), self.kind.samples)]
        if self.kind is INSIDER:
            parts.append(integrity.listed_overlaps(windows))
        else:
            live = accessions.join(windows.select("window", "key"), ["window", "key"], "left_semi")
            parts.append(integrity.accession_spread(live))
        return side_by_side(*parts)


def listed_archives(spark: SparkSession, kind: Kind, landing: str) -> DataFrame:
    """(window, key, path): the first landed archive of each window label; contents are not read."""
    objects = (
        spark.read.format("binaryFile")
        .schema(FILES)
        .option("pathGlobFilter", "*.zip")
        .option("recursiveFileLookup", "true")
        .load(landing)
        .select(F.concat(F.lit(f"{kind.prefix}/"), F.substring_index("path", f"/{kind.prefix}/", -1)).alias("key"), "path")
    )
    first = integrity.archives_by_label(objects, kind.prefix)
    paths = objects.groupBy("key").agg(F.min("path").alias("path"))
    return first.join(paths, "key").select(F.col("label").alias("window"), "key", "path")


def _audit_archives(spark: SparkSession, state: AuditState, batch: list) -> None:
    """Read some archives, refuse broken rows, and put their windows into the state."""
    kind, scratch = state.kind, []

    def landed(rows: DataFrame, name: str, *by: str) -> DataFrame:
        scratch.append(work_path(spark, f"audit-{name}"))
        rows.write.partitionBy(*by).parquet(scratch[-1])
        return spark.read.schema(rows.schema).parquet(scratch[-1])

    try:
        read = archives.scan_members(spark, [r.path for r in batch], list(kind.members), kind.nested)
        lines = landed(read, "lines", "member")
        parse = pipelines.institutional_rows if kind is HOLDINGS else pipelines.insider_rows
        names = spark.createDataFrame([(r.window, r.key, r.path) for r in batch], "window STRING, key STRING, path STRING")
        label = names.select("window", F.col("path").alias("rawArchiveKey"))  # one row per archive
        filings, rows = (
            landed(checked.strict().join(label, "rawArchiveKey"), checked.table)
            for checked in parse(lines, keep=["ord"])
        )
        state.put(names, filings, rows)
    finally:
        lake.remove(spark, scratch)


def audit_round(
    spark: SparkSession,
    dataset: str,
    landing: str,
    state_root: str,
    ledger: str,
    round_id: str,
    reports: str,
    run: bool = False,
    max_windows: int | None = None,
    max_archives: int = 25,
) -> DataFrame:
    """Audit the landed archives of a round: one row, written as JSON if `run` (K3).

    A ledger identity without its raw archive fails the audit before anything is read. With
    `max_windows` only the first labels are audited, and the gate is left out. Archives of windows whose
    key the state holds are not read again.
    """
    state = AuditState(spark, state_root, dataset)
    kind = state.kind
    finished = incremental.round_rows(read_ledger(spark, ledger), round_id)
    listed = listed_archives(spark, kind, landing)
    verdict = integrity.gate_verdict(integrity.coverage(listed, finished, dataset, kind.prefix), dataset)
    if max_windows is None:
        integrity.require_covered(verdict)
    else:
        listed = listed.orderBy("window").limit(max_windows)
    # One row per archive.
    known = {(r.window, r.key) for r in state.windows().select("window", "key").collect()}
    chosen = sorted(listed.collect(), key=lambda r: r.window)
    fresh = [r for r in chosen if (r.window, r.key) not in known]
    for start in range(0, len(fresh), max_archives):
        _audit_archives(spark, state, fresh[start : start + max_archives])
    current = spark.createDataFrame([(r.window, r.key) for r in chosen], "window STRING, key STRING")
    open_windows = integrity.gate_verdict(
        integrity.coverage(current, finished, dataset, kind.prefix), dataset
    ).select(F.col("unreceipted").alias("unreceiptedRaw"))
    total = side_by_side(state.rollup(current), open_windows)
    report = total.select(
        F.lit(dataset).alias("dataset"),
        F.lit(round_id).alias("roundId"),
        "windows",
        F.col("filings").alias("totalFilings"),
        F.col(kind.total_rows).alias("totalRows"),
        *[name for name in total.columns if name not in ("windows", "filings", kind.total_rows)],
    )
    return lake.write_report(report, reports, round_id, f"integrity-{dataset}", run)
