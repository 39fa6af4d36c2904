"""The lake on disk: year shards, typed reads, publishing."""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filinglake import schemas
from filinglake.functions import dates, securities
from filinglake.operators.checks import Checked, split_broken
from filinglake.session import work_path
from filinglake.sources import footers

SHARD = "availableYear"


def with_shard(df: DataFrame) -> DataFrame:
    """The UTC year of availableAt: a filing of December 31 belongs to the next year."""
    return df.withColumn(SHARD, dates.available_year(F.col("availableAt")))


def _conform(df: DataFrame, table: str) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.TABLES[table]])


def clustered(df: DataFrame, table: str) -> DataFrame:
    """Rows range-split and sorted by (shard, clustering keys, tiebreak).

    Ranges, not one task per year: a year, ticker or CUSIP of any size is cut into as many
    files as it needs, and each file still covers a narrow span of keys for min/max pruning.
    """
    keys = [SHARD, *schemas.CLUSTER_KEYS[table], *schemas.CLUSTER_TIEBREAK[table]]
    return with_shard(_conform(df, table)).repartitionByRange(*keys).sortWithinPartitions(*keys)


def write_lake(df: DataFrame, table: str, root: str, mode: str = "overwrite") -> str:
    """Write rows of one table; only the year shards present in `df` are replaced (K1)."""
    path = f"{root}/{table}"
    (
        clustered(df, table)
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(SHARD)
        .parquet(path)
    )
    return path


def _file_system(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def remove(spark: SparkSession, paths: Sequence[str]) -> None:
    """Delete folders a job wrote for itself."""
    for path in paths:
        fs, at = _file_system(spark, path)
        fs.delete(at, True)


def shard_years(spark: SparkSession, path: str) -> list[int]:
    """Years that have a folder: a listing, bounded by the years there are."""
    fs, at = _file_system(spark, path)
    if not fs.exists(at):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(at)]
    return sorted(int(n.split("=")[1]) for n in names if n.startswith(f"{SHARD}=") and n.split("=")[1].isdigit())


def stage(spark: SparkSession, rows: DataFrame, table: str) -> str:
    """Write rows to the shared folder, by shard, and return where."""
    staged = work_path(spark, f"stage-{table}")
    with_shard(_conform(rows, table)).write.partitionBy(SHARD).parquet(staged)
    return staged


def publish_stage(
    spark: SparkSession, staged: str, table: str, root: str, years: Sequence[int]
) -> None:
    """Make staged rows the content of the given year shards.

    A shard that ends up empty is removed: a dynamic overwrite alone would leave its old rows.
    """
    kept = set(shard_years(spark, staged))
    if kept:
        write_lake(spark.read.schema(schemas.TABLES[table]).parquet(staged), table, root)
    empty = [f"{root}/{table}/{SHARD}={year}" for year in years if year not in kept]
    remove(spark, [*empty, staged])


def replace_years(
    spark: SparkSession, merged: DataFrame, table: str, root: str, years: Sequence[int]
) -> None:
    """Make `merged` the content of the given year shards.

    The rows are written to the shared folder first, so the shards they were read from are not
    touched before the result is complete, and a lost executor cannot mix old and new.
    """
    publish_stage(spark, stage(spark, merged, table), table, root, years)


def read_table(spark: SparkSession, table: str, root: str, years: Sequence[int] | None = None) -> DataFrame:
    """A lake table with its declared columns and the shard (of `years`, or all); empty when it has no shard yet.

    A file written before `resolvedTicker` existed lacks the column; its rows derive it from the
    filer's text, whatever other files the year has. Where the column exists, its nulls are trusted. The
    footers of all files to be read tell; they also refuse a file that holds a column as another kind of type.
    """
    path = f"{root}/{table}"
    schema = schemas.TABLES[table]
    shards = [y for y in shard_years(spark, path) if years is None or y in years]
    if not shards:
        return with_shard(spark.createDataFrame([], schema))
    sharded = T.StructType([*schema.fields, T.StructField(SHARD, T.IntegerType())])
    reader = spark.read.schema(sharded).option("basePath", path)
    folders = [path] if years is None else [f"{path}/{SHARD}={y}" for y in shards]
    if not table.startswith("insider_"):
        return reader.parquet(*folders)
    found = footers.read_footers(spark, folders)
    wrong = footers.conflicts(found, schema).take(3)
    if wrong:
        raise ValueError("; ".join(f"{r.file}: {r.column} is {r.kind}, not {r.declared}" for r in wrong))
    groups = footers.schema_groups(found)
    legacy = [f for names, files in groups if "resolvedTicker" not in names for f in files]
    if not legacy:
        return reader.parquet(*folders)
    derived = securities.issuer_ticker(F.col("issuerTicker"))
    parts = [reader.parquet(*legacy).withColumn("resolvedTicker", derived)]
    rest = [f for names, files in groups if "resolvedTicker" in names for f in files]
    if rest:
        parts.append(reader.parquet(*rest))
    return reduce(DataFrame.unionByName, parts)


def check_table(df: DataFrame, table: str) -> Checked:
    """Typed read: required columns non-null, numbers finite, row kinds known."""
    rules = {name: F.col(name).isNull() for name in schemas.REQUIRED[table]}
    for field in schemas.TABLES[table]:
        if field.dataType.typeName() == "double":
            cell = F.col(field.name)
            rules[f"{field.name} not finite"] = F.isnan(cell) | (F.abs(cell) == float("inf"))
    if table == "insider_transactions":
        rules["rowKind unknown"] = ~F.col("rowKind").isin(*schemas.ROW_KINDS)
    return split_broken(table, df, rules, {name: F.col(name) for name in df.columns}, F.col("accession"))


def as_of(df: DataFrame, instant: datetime | str) -> DataFrame:
    """Rows that could be known at `instant` (P9), originals and amendments alike.

    The shard predicate is spelled out because partition pruning is not derived from
    availableAt.
    """
    limit = F.lit(instant).cast("timestamp")
    known = df.filter(F.col("availableAt") <= limit)
    return known.filter(F.col(SHARD) <= F.year(limit)) if SHARD in df.columns else known


_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


def publish_views(
    spark: SparkSession,
    root: str,
    provenance: tuple[str, str, int],
    table: str | None = None,
    year: int | None = None,
    prefix: str = "",
) -> list[str]:
    """Views for SQL over a slice of the lake, plus `dataset_snapshot` (K2).

    Only the asked-for slice is published; asking for a table or year that is not there is an
    error. A table without rows still gets its declared columns.
    """
    if prefix and not _NAME.fullmatch(prefix):
        raise ValueError(f"not a view prefix: {prefix!r}")
    if table is not None and table not in schemas.TABLES:
        raise ValueError(f"unknown table: {table}")
    names = []
    for name in [table] if table else schemas.TABLES:
        if year is not None and year not in shard_years(spark, f"{root}/{name}"):
            raise FileNotFoundError(f"{name} has no shard for {year}")
        rows = read_table(spark, name, root)
        if year is not None:
            rows = rows.filter(F.col(SHARD) == year)
        rows.createOrReplaceTempView(f"{prefix}{name}")
        names.append(f"{prefix}{name}")
    dataset, generated_at, version = provenance
    spark.range(1).select(
        F.lit(dataset).alias("dataset"),
        F.lit(generated_at).alias("generated_at"),
        F.lit(version).alias("schema_version"),
    ).createOrReplaceTempView(f"{prefix}dataset_snapshot")
    return [*names, f"{prefix}dataset_snapshot"]


def write_report(report: DataFrame, root: str, round_id: str, name: str, run: bool = False) -> DataFrame:
    """A report as JSON below `reports/`, away from the ledger (K3). A dry run only returns it."""
    if run:
        report.write.mode("overwrite").json(f"{root}/reports/{round_id}/{name}")
    return report
