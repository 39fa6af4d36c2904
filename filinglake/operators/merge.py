"""Merging new reads into the lake: 13F by key (G1), insider tables by source precedence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filinglake import schemas
from filinglake.operators.checks import Checked
from filinglake.operators.keyed import as_column, last_per_key


def _upsert(existing: DataFrame, incoming: DataFrame, keys: list[str], order: Column | str) -> DataFrame:
    """The last row per key, an incoming one before any existing one."""
    by = as_column(order)
    sides = [
        df.withColumn("_ord", F.struct(F.lit(rank).alias("side"), by.alias("ord")))
        for rank, df in enumerate((existing, incoming))
    ]
    # A column that is the order travels in it.
    placed = [order] if isinstance(order, str) and order in existing.columns else []
    merged = last_per_key(sides[0].unionByName(sides[1]).drop(*placed), keys, "_ord")
    return merged.withColumns({name: F.col("_ord.ord") for name in placed}).select(*existing.columns)


def _foreign_sources(df: DataFrame, table: str) -> DataFrame:
    """Rows whose source is not the data set's; a missing source is foreign too."""
    return df.filter(~F.col("availabilitySource").eqNullSafe(F.lit(schemas.SOURCE_13F_DATASET))).select(
        F.array(F.concat(F.lit("unknown source "), F.coalesce("availabilitySource", F.lit("(none)")))).alias("broken"),
        F.concat_ws(" ", F.lit(table), F.col("accession")).alias("sample"),
    )


def merge_institutional(
    table: str, existing: DataFrame, incoming: DataFrame, order: Column | str
) -> Checked:
    """13F rows with those of a later read put in their place by key (G1).

    `order` is the position within a side; the last of a side wins. Rows of
    another source, or of none, are rejects: strict use refuses the merge.
    """
    keys = {
        "institutional_filings": ["accession"],
        "institutional_holdings": ["accession", "infoTableSk"],
    }[table]
    rejects = _foreign_sources(existing, table).unionByName(_foreign_sources(incoming, table))
    return Checked(table, _upsert(existing, incoming, keys, order), rejects)


def sources(filings: DataFrame, transactions: DataFrame) -> DataFrame:
    """One row per accession over both tables, with its lowest and highest source name."""
    both = filings.select("accession", "availabilitySource").unionByName(
        transactions.select("accession", "availabilitySource")
    )
    # Equal rows go first: names have an order, but no running least that a hash table could hold.
    return both.distinct().groupBy("accession").agg(
        F.min("availabilitySource").alias("source"),
        F.max("availabilitySource").alias("other"),
        F.bool_or(F.col("availabilitySource").isNull()).alias("missing"),
    )


def _rank(source: Column) -> Column:
    rank = F.lit(None).cast("int")
    for name, value in schemas.INSIDER_SOURCE_RANK.items():
        rank = F.when(source == name, F.lit(value)).otherwise(rank)
    return rank


def taken_accessions(
    existing: tuple[DataFrame, DataFrame], incoming: tuple[DataFrame, DataFrame]
) -> DataFrame:
    """Accessions the incoming read supplies: new ones, and those of equal or higher rank."""
    return taken_of(sources(*existing), sources(*incoming))


def taken_of(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """The same from the `sources` of both sides."""
    old = existing.select("accession", F.col("source").alias("current"))
    new = incoming.select("accession", "source")
    offered, held = _rank(F.col("source")), _rank(F.col("current"))
    return (
        new.join(old, "accession", "left")
        .filter(F.col("current").isNull() | (offered >= held))
        .select("accession")
    )


def source_rejects(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Accessions of either side, given as `sources`, with several sources or an unknown one."""
    mixed = F.col("source") != F.col("other")
    unknown = F.col("missing") | _rank(F.col("source")).isNull() | _rank(F.col("other")).isNull()
    sides = [
        found.filter(mixed | unknown).select(
            F.array(
                F.when(mixed, F.lit(f"{side}: mixed sources")).otherwise(F.lit(f"{side}: unknown source"))
            ).alias("broken"),
            F.concat_ws(" ", "accession", "source", "other").alias("sample"),
        )
        for side, found in (("existing", existing), ("incoming", incoming))
    ]
    return sides[0].unionByName(sides[1])


def merge_insider(
    existing: tuple[DataFrame, DataFrame], incoming: tuple[DataFrame, DataFrame]
) -> tuple[Checked, Checked]:
    """Insider filings and transactions after a new read.

    A taken accession replaces all rows of that accession in both tables, in whatever year they
    are; rows are not deduplicated. Unlike a lookup that only meets ranks of accessions already
    held, an unknown source is refused on new accessions too.
    """
    taken = taken_accessions(existing, incoming)
    rejects = source_rejects(sources(*existing), sources(*incoming))
    merged = []
    for table, old, new in zip(("insider_filings", "insider_transactions"), existing, incoming):
        kept = old.join(taken, "accession", "left_anti")
        fresh = new.join(taken, "accession", "left_semi")
        rows = kept.unionByName(fresh).select(*old.columns)
        merged.append(Checked(table, rows, rejects))
    return merged[0], merged[1]


def affected_years(existing: DataFrame, incoming: DataFrame, taken: DataFrame | None = None) -> DataFrame:
    """Year shards a merge has to rewrite: those of incoming rows and of rows they replace."""
    year = F.year("availableAt").alias("availableYear")
    keys = taken if taken is not None else incoming.select("accession").distinct()
    replaced = existing.join(keys, "accession", "left_semi").select(year)
    return incoming.select(year).unionByName(replaced).distinct()
