"""Chains from landed members to lake rows, and back into the lake."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filinglake import schemas
from filinglake.operators import merge, normalize, spans, units
from filinglake.operators.checks import Checked
from filinglake.operators.units import RULE, UnitRule
from filinglake.session import work_path
from filinglake.sinks import lake
from filinglake.sources import tsv


def member_records(lines: DataFrame, members: Mapping[str, dict], check: bool = True) -> dict[str, DataFrame]:
    """Every member's records from landed lines (archive_key, member, line_no, line)."""
    return {
        name: tsv.records(
            tsv.landed_lines(lines, name),
            columns["required"],
            columns["optional"],
            first=F.col("ord") == 0,
            check=check,
            member=name,
        )
        for name, columns in members.items()
    }


def institutional_rows(
    lines: DataFrame, check: bool = True, keep: Sequence[str] = ()
) -> tuple[Checked, Checked]:
    """13F filings and holdings of landed archives; `keep=["ord"]` adds the file order."""
    m = member_records(lines, schemas.MEMBERS_13F, check)
    return (
        normalize.filings_13f(m["SUBMISSION.tsv"], m["COVERPAGE.tsv"], keep),
        normalize.holdings_13f(m["INFOTABLE.tsv"], m["SUBMISSION.tsv"], keep),
    )


def insider_rows(
    lines: DataFrame, check: bool = True, keep: Sequence[str] = ()
) -> tuple[Checked, Checked]:
    """Insider filings and transactions of landed archives; `keep=["ord"]` adds the filings' file order."""
    m = member_records(lines, schemas.MEMBERS_345, check)
    return (
        normalize.filings_insider(m["SUBMISSION.tsv"], m["REPORTINGOWNER.tsv"], keep),
        normalize.transactions_insider(
            m["SUBMISSION.tsv"], m["NONDERIV_TRANS.tsv"], m["DERIV_TRANS.tsv"]
        ),
    )


def resolved_holdings(
    filings: DataFrame,
    holdings: DataFrame,
    ticker_spans: DataFrame,
    order: str = "availableAt",
    rule: UnitRule = RULE,
) -> DataFrame:
    """Holdings in whole dollars with the ticker of their own day: units first, once, then tickers."""
    dollars = units.to_dollars(filings, holdings, order, rule)
    return spans.resolve_tickers(dollars, ticker_spans)


def _landed(spark: SparkSession, rows: DataFrame, label: str, paths: list[str]) -> DataFrame:
    """Rows written to the shared folder and read back: parsed once, whatever reads them.

    The folder is added to `paths`, for removal when the job is done.
    """
    paths.append(work_path(spark, label))
    rows.write.parquet(paths[-1])
    return spark.read.schema(rows.schema).parquet(paths[-1])


_INSIDER = ("insider_filings", "insider_transactions")


def refresh_insider(
    spark: SparkSession, root: str, filings: DataFrame, transactions: DataFrame
) -> list[int]:
    """Merge new insider rows into the lake; returns the years rewritten.

    Both tables' rows are staged before either is published, so the second merge still sees the
    first table as it was. Filings are published last: an accession they hold is complete, so a run
    that stops in between is done again by the next one, and replaces its own rows.
    """
    scratch: list[str] = []
    try:
        incoming = tuple(_landed(spark, df, name, scratch) for name, df in zip(_INSIDER, (filings, transactions)))
        held = tuple(lake.read_table(spark, name, root) for name in _INSIDER)
        taken = _landed(spark, merge.taken_accessions(held, incoming), "taken", scratch)
        ranked = merge.merge_insider(tuple(old.drop(lake.SHARD) for old in held), incoming)
        ranked[0].strict()  # refuse the merge before anything is written
        staged = []
        for table, old, new in zip(_INSIDER, held, incoming):
            found = merge.affected_years(old, new, taken).collect()  # one row per year
            years = sorted(r.availableYear for r in found)
            kept = old.filter(F.col(lake.SHARD).isin(years)).drop(lake.SHARD).join(taken, "accession", "left_anti")
            fresh = new.join(taken, "accession", "left_semi")
            rows = kept.unionByName(fresh.select(*kept.columns))
            staged.append((table, lake.stage(spark, rows, table), years))
            scratch.append(staged[-1][1])
        for table, path, years in reversed(staged):
            lake.publish_stage(spark, path, table, root, years)
    finally:
        lake.remove(spark, scratch)
    return sorted({year for _, _, years in staged for year in years})


def refresh_institutional(
    spark: SparkSession, root: str, filings: DataFrame, holdings: DataFrame, order: str = "ord"
) -> list[int]:
    """Upsert re-read 13F windows into the lake; returns the years rewritten.

    `order` is the rows' position in their archive: of two rows with one key the last stands. Both
    tables are checked and staged before either is published, so a refused row leaves the lake as it was.
    """
    staged, scratch = [], []
    try:
        for table, rows in (("institutional_filings", filings), ("institutional_holdings", holdings)):
            new = _landed(spark, rows, table, scratch)
            old = lake.read_table(spark, table, root)
            found = merge.affected_years(old, new).collect()  # one row per year
            years = sorted(r.availableYear for r in found)
            held = old.filter(F.col(lake.SHARD).isin(years)).drop(lake.SHARD)
            placed = held.withColumn(order, F.lit(None).cast(new.schema[order].dataType))
            merged = merge.merge_institutional(table, placed, new, order).strict().drop(order)
            staged.append((table, lake.stage(spark, merged, table), years))
            scratch.append(staged[-1][1])
        for table, path, years in staged:
            lake.publish_stage(spark, path, table, root, years)
    finally:
        lake.remove(spark, scratch)
    return sorted({year for _, _, years in staged for year in years})
