"""Merges that rewrite only files holding a replaced key, and publish both tables in one version."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filinglake import schemas
from filinglake.operators import merge
from filinglake.operators.checks import Checked
from filinglake.operators.keyed import last_per_key
from filinglake.plans.pipelines import _INSIDER, _landed
from filinglake.sinks import lake, versions

_INSTITUTIONAL = {"institutional_filings": ["accession"], "institutional_holdings": ["accession", "infoTableSk"]}
ATTEMPTS = 5


def _rewritten(base: versions.Snapshot, table: str, replaced: DataFrame, keys: list[str], fresh: DataFrame, scratch: list[str]) -> tuple[DataFrame, DataFrame]:
    """(new files, paths they replace): rows of `replaced` keys leave their files, `fresh` rows come in."""
    spark = base.spark
    held = _landed(spark, base.holding(table, replaced.select("accession").distinct()), "holding", scratch)
    rows = base.rows(table, named=held).drop(lake.SHARD)
    kept = rows.join(replaced, keys, "left_anti")
    added = versions.add_rows(spark, kept.unionByName(fresh.select(*kept.columns)), table, base.root)
    return _landed(spark, added, "added", scratch), held


def _committed(spark: SparkSession, root: str, merged, note: str) -> versions.Snapshot:
    """Merge on the newest version; start again on the next one if another writer was first."""
    for left in range(ATTEMPTS - 1, -1, -1):
        base = versions.snapshot(spark, root)
        added, removed = merged(base)
        try:
            return versions.commit(base, added, removed, note)
        except versions.Conflict:
            if not left:
                raise
    raise AssertionError


def merge_insider(spark: SparkSession, root: str, filings: DataFrame, transactions: DataFrame) -> versions.Snapshot:
    """A new read of insider accessions in the versioned lake, by precedence.

    Of the lake only files that hold an incoming accession are looked at, and only those that hold
    a taken one are written again. Mixed or unknown sources of an incoming accession, on either side, refuse
    the merge before anything is written.
    """
    scratch: list[str] = []
    try:
        incoming = tuple(_landed(spark, df, name, scratch) for name, df in zip(_INSIDER, (filings, transactions), strict=True))
        # One row an accession, made once a side: what is offered, what is refused and what is taken follow from it.
        new = _landed(spark, merge.sources(*incoming), "offered", scratch)
        offered = new.select("accession")

        def merged(base: versions.Snapshot) -> tuple[list[DataFrame], list[DataFrame]]:
            held = tuple(
                base.rows(t, named=base.holding(t, offered)).drop(lake.SHARD).join(offered, "accession", "left_semi") for t in _INSIDER
            )
            old = _landed(spark, merge.sources(*held), "held", scratch)
            Checked("insider_filings", incoming[0], merge.source_rejects(old, new)).strict()
            taken = _landed(spark, merge.taken_of(old, new), "taken", scratch)
            parts = [
                _rewritten(base, table, taken, ["accession"], rows.join(taken, "accession", "left_semi"), scratch)
                for table, rows in zip(_INSIDER, incoming, strict=True)
            ]
            return [p[0] for p in parts], [p[1] for p in parts]

        return _committed(spark, root, merged, "insider")
    finally:
        lake.remove(spark, scratch)


def merge_institutional(spark: SparkSession, root: str, filings: DataFrame, holdings: DataFrame, order: str = "ord") -> versions.Snapshot:
    """A new read of 13F windows in the versioned lake: rows replace those of their key (G1).

    `order` is the position in the archive, of rows with one key the last stands. A row of another
    source refuses the merge before anything is written.
    """
    scratch: list[str] = []
    try:
        read = {}
        for (table, keys), rows in zip(_INSTITUTIONAL.items(), (filings, holdings), strict=True):
            # Rows are read and written once; only if a key has a row of another source, they are read again to name it.
            foreign = F.max(~F.col("availabilitySource").eqNullSafe(F.lit(schemas.SOURCE_13F_DATASET)))
            landed = _landed(spark, last_per_key(rows, keys, order, _foreign=foreign).drop(order), table, scratch)
            if landed.where("_foreign").take(1):
                merge.merge_institutional(table, rows.limit(0), rows, order).strict()
            read[table] = landed.drop("_foreign")

        def merged(base: versions.Snapshot) -> tuple[list[DataFrame], list[DataFrame]]:
            parts = [
                _rewritten(base, table, read[table].select(*keys), keys, read[table], scratch) for table, keys in _INSTITUTIONAL.items()
            ]
            return [p[0] for p in parts], [p[1] for p in parts]

        return _committed(spark, root, merged, "institutional")
    finally:
        lake.remove(spark, scratch)
