"""Versions of a lake: a log of commits that names the files of every table (K1, K2).

A version is the whole list of files, over all tables. Writers add files under new names, write the
list of the next version, and take its number by a rename that fails if the number is taken. Readers
resolve one version and read only the files it names, so both tables of a pair change at once, a
writer that stops leaves nothing a reader sees, and of two writers from one version one has to
start again. Layout: `<table>/commit=<id>/availableYear=<year>/<file>`, lists and commits in `_log`.

The rename is exclusive on file systems whose rename is atomic and refuses an existing target.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filinglake import schemas
from filinglake.sinks import lake

LOG = "_log"
FILES = "table STRING, year INT, path STRING, rows LONG, low STRING, high STRING"
_DIGITS = 12


class Conflict(RuntimeError):
    """Another writer has taken the version number."""


@dataclass(frozen=True)
class Snapshot:
    """One version of a lake: 0 is the lake without files."""

    spark: SparkSession
    root: str
    version: int
    listed: str | None

    @property
    def files(self) -> DataFrame:
        """table, year, path below the root, rows, and the lowest and highest accession of every file."""
        if self.listed is None:
            return self.spark.createDataFrame([], FILES)
        return self.spark.read.schema(FILES).parquet(f"{self.root}/{LOG}/{self.listed}")

    def paths(self, table: str, years: Sequence[int] | None = None, named: DataFrame | None = None) -> list[str]:
        """Files of a table, of some years, or those in `named` (path): one string a file to the driver."""
        chosen = self.files.where(F.col("table") == table)
        if years is not None:
            chosen = chosen.where(F.col("year").isin(list(years)))
        if named is not None:
            chosen = chosen.join(named, "path", "left_semi")
        return sorted(r.path for r in chosen.select("path").collect())

    def rows(self, table: str, years: Sequence[int] | None = None, named: DataFrame | None = None) -> DataFrame:
        """Rows of those files with the shard; the declared columns where there are none."""
        return read_files(self.spark, self.root, table, self.paths(table, years, named))

    def holding(self, table: str, accessions: DataFrame) -> DataFrame:
        """(path) of the files that hold any of the accessions.

        Key ranges of files leave out what can't; of the others only the column `accession` is read.
        """
        span = accessions.agg(F.min("accession").alias("least"), F.max("accession").alias("most")).first()
        if span.least is None:
            return self.spark.createDataFrame([], "path STRING")
        may = self.files.where((F.col("table") == table) & (F.col("low") <= span.most) & (F.col("high") >= span.least))
        paths = sorted(r.path for r in may.select("path").collect())
        rows = read_files(self.spark, self.root, table, paths, ["accession"])
        return rows.join(accessions, "accession", "left_semi").select("path").distinct()


def read_files(
    spark: SparkSession, root: str, table: str, paths: Sequence[str], columns: Sequence[str] | None = None
) -> DataFrame:
    """Rows of named files with the shard, or some `columns` and each row's `path`. An absent file is an error."""
    schema = schemas.TABLES[table]
    if not paths:
        empty = spark.createDataFrame([], schema)
        return lake.with_shard(empty) if columns is None else empty.select(*columns, F.lit("").alias("path"))
    sharded = T.StructType([*schema.fields, T.StructField("commit", T.StringType()), T.StructField(lake.SHARD, T.IntegerType())])
    found = spark.read.schema(sharded).option("basePath", f"{root}/{table}").parquet(*[f"{root}/{p}" for p in paths])
    return found.drop("commit") if columns is None else found.select(*columns, relative(table).alias("path"))


def relative(table: str):
    return F.concat(F.lit(f"{table}/commit="), F.substring_index(F.col("_metadata.file_path"), f"/{table}/commit=", -1))


def _log_entries(spark: SparkSession, root: str) -> list[int]:
    """Version numbers there are: a listing of the log."""
    fs, at = lake._file_system(spark, f"{root}/{LOG}")
    if not fs.exists(at):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(at)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def _entry(root: str, version: int) -> str:
    return f"{root}/{LOG}/{version:0{_DIGITS}d}.json"


def exists(spark: SparkSession, root: str) -> bool:
    return bool(_log_entries(spark, root))


def snapshot(spark: SparkSession, root: str, version: int | None = None) -> Snapshot:
    """The newest version, or the one asked for."""
    there = _log_entries(spark, root)
    if version is None:
        version = there[-1] if there else 0
    if version == 0:
        return Snapshot(spark, root, 0, None)
    if version not in there:
        raise FileNotFoundError(f"{root} has no version {version}")
    told = json.loads(spark.read.text(_entry(root, version), wholetext=True).first()[0])
    return Snapshot(spark, root, version, told["files"])


def add_rows(spark: SparkSession, rows: DataFrame, table: str, root: str) -> DataFrame:
    """Write rows as new files, which no version names yet, and return their list."""
    folder = f"{table}/commit={uuid.uuid4().hex}"
    lake.clustered(rows, table).write.partitionBy(lake.SHARD).parquet(f"{root}/{folder}")
    fs, at = lake._file_system(spark, f"{root}/{folder}")
    years = [s for s in fs.listStatus(at) if s.isDirectory()]  # one folder a year
    if not years:
        return spark.createDataFrame([], FILES)
    sharded = T.StructType([T.StructField("accession", T.StringType()), T.StructField(lake.SHARD, T.IntegerType())])
    written = spark.read.schema(sharded).parquet(f"{root}/{folder}")
    return (
        written.groupBy(F.col(lake.SHARD).alias("year"), relative(table).alias("path"))
        .agg(F.count(F.lit(1)).alias("rows"), F.min("accession").alias("low"), F.max("accession").alias("high"))
        .select(F.lit(table).alias("table"), "year", "path", "rows", "low", "high")
    )


def commit(base: Snapshot, added: Sequence[DataFrame], removed: Sequence[DataFrame] = (), note: str = "") -> Snapshot:
    """The version after `base`, with file lists added and paths removed; Conflict if there is one already."""
    spark, root = base.spark, base.root
    files = base.files
    for paths in removed:
        files = files.join(paths, "path", "left_anti")
    for more in added:
        files = files.unionByName(more)
    listed = f"files-{uuid.uuid4().hex}"
    files.write.parquet(f"{root}/{LOG}/{listed}")
    told = json.dumps({"version": base.version + 1, "files": listed, "note": note})
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    draft, target = f"{root}/{LOG}/{listed}.draft", _entry(root, base.version + 1)
    fs, at = lake._file_system(spark, draft)
    out = fs.create(at, False)
    out.write(bytearray(told.encode()))
    out.close()
    # Without options the rename refuses an existing target.
    options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(at.toUri(), conf).rename(at, jvm.org.apache.hadoop.fs.Path(target), options)
    except Py4JJavaError as problem:
        lake.remove(spark, [draft, f"{root}/{LOG}/{listed}"])
        if "FileAlreadyExists" in problem.java_exception.getClass().getName():
            raise Conflict(f"{root}: version {base.version + 1} exists") from problem
        raise
    return Snapshot(spark, root, base.version + 1, listed)


def expire(spark: SparkSession, root: str, keep: int = 10, older_than_hours: float = 24.0) -> int:
    """Delete commits before the newest `keep`, and files that no kept version names; returns how many files.

    Files younger than `older_than_hours` stay: a writer may be about to name them.
    """
    there = _log_entries(spark, root)
    kept = [snapshot(spark, root, v) for v in there[-keep:]]
    lake.remove(spark, [_entry(root, v) for v in there[:-keep]])
    limit = F.current_timestamp() - F.make_dt_interval(secs=F.lit(older_than_hours * 3600))
    gone = 0
    for table in schemas.TABLES:
        fs, at = lake._file_system(spark, f"{root}/{table}")
        if not fs.exists(at):
            continue
        stored = (
            spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{root}/{table}")
            .where(F.col("modificationTime") < limit)
            .select(F.concat(F.lit(f"{table}/commit="), F.substring_index("path", f"/{table}/commit=", -1)).alias("path"))
        )
        for one in kept:
            stored = stored.join(one.files.select("path"), "path", "left_anti")
        unnamed = [f"{root}/{r.path}" for r in stored.collect()]
        lake.remove(spark, unnamed)
        gone += len(unnamed)
    lists = {one.listed for one in kept}
    fs, at = lake._file_system(spark, f"{root}/{LOG}")
    for status in fs.listStatus(at) if there else []:
        name = status.getPath().getName()
        if name.startswith("files-") and name not in lists and there[:-keep]:
            age = spark.range(1).select((F.unix_timestamp(limit) * 1000).alias("ms")).first().ms
            if status.getModificationTime() < age:
                lake.remove(spark, [f"{root}/{LOG}/{name}"])
    return gone


def publish(
    spark: SparkSession, root: str, dataset: str, table: str | None = None, years: Sequence[int] | None = None,
    version: int | None = None, prefix: str = "",
) -> list[str]:
    """Views over the files of one version, and `dataset_snapshot` with its number (K2).

    All views come from the same version, whatever is committed meanwhile. A table or year without
    files gets the declared columns without rows.
    """
    if prefix and not lake._NAME.fullmatch(prefix):
        raise ValueError(f"not a view prefix: {prefix!r}")
    if table is not None and table not in schemas.TABLES:
        raise ValueError(f"unknown table: {table}")
    one = snapshot(spark, root, version)
    names = []
    for name in [table] if table else schemas.TABLES:
        one.rows(name, years).createOrReplaceTempView(f"{prefix}{name}")
        names.append(f"{prefix}{name}")
    spark.range(1).select(
        F.lit(dataset).alias("dataset"), F.lit(one.version).cast("long").alias("version")
    ).createOrReplaceTempView(f"{prefix}dataset_snapshot")
    return [*names, f"{prefix}dataset_snapshot"]
