"""Snapshot manifests: what is published, and whether the bytes are there."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from filinglake import schemas
from filinglake.operators.checks import BrokenRows, Checked
from filinglake.sinks.lake import _file_system

# Fields of a manifest. Numbers are read as text first, so that a wrong type is
# reported instead of becoming null.
_FILE = "STRUCT<publicPath: STRING, size: STRING, sha256: STRING>"
SNAPSHOT = f"""STRUCT<
    schemaVersion: STRING, dataset: STRING, generatedAt: STRING, totals: MAP<STRING, STRING>,
    tables: MAP<STRING, STRUCT<
        rows: STRING, years: ARRAY<STRING>,
        manifests: ARRAY<STRUCT<year: STRING, files: ARRAY<{_FILE}>>>>>>"""
_COUNT = r"^[0-9]{1,16}(\.0*)?$"
_DIGEST = r"^[a-f0-9]{64}$"
FOLDER = "data/"


def _count_broken(cell: Column) -> Column:
    return F.coalesce(~cell.rlike(_COUNT), F.lit(True))


def _unsafe(path: Column) -> Column:
    """Not a normalised path below the data folder."""
    dotted = F.exists(F.split(path, "/"), lambda segment: segment.isin(".", ".."))
    return F.coalesce(
        ~path.startswith(FOLDER) | path.contains("\\") | path.contains("//") | dotted, F.lit(True)
    )


def read_manifest(documents: DataFrame) -> Checked:
    """One row per published file from manifest text (`snapshot_id`, `json`).

    Rejects name the rule a document or a file entry breaks.
    """
    c = F.col
    parsed = documents.select("snapshot_id", F.from_json("json", SNAPSHOT).alias("s"))
    known = list(schemas.TABLES)
    heads = parsed.select(
        "snapshot_id",
        F.array(
            F.when(c("s.tables").isNull(), "tables"),
            F.when(c("s.totals").isNull(), "totals"),
            F.when(_count_broken(c("s.schemaVersion")), "schemaVersion"),
            F.when(F.coalesce("s.dataset", F.lit("")) == "", "dataset"),
            F.when(F.coalesce("s.generatedAt", F.lit("")) == "", "generatedAt"),
            F.when(F.exists(F.map_values("s.totals"), _count_broken), "totals"),
            F.when(F.exists(F.map_keys("s.tables"), lambda t: ~t.isin(*known)), "unknown table"),
        ).alias("broken"),
    )
    tables = parsed.select("snapshot_id", F.explode("s.tables").alias("table", "entry"))
    bodies = tables.select(
        F.concat_ws(" ", "snapshot_id", "table").alias("snapshot_id"),
        F.array(
            F.when(_count_broken(c("entry.rows")), "rows"),
            F.when(c("entry.years").isNull() | c("entry.manifests").isNull(), "years or manifests"),
            F.when(F.exists("entry.years", _count_broken), "years"),
            F.when(F.exists("entry.manifests", lambda m: _count_broken(m["year"])), "year"),
            F.when(F.exists("entry.manifests", lambda m: m["files"].isNull()), "files"),
        ).alias("broken"),
    )
    files = (
        tables.select("snapshot_id", "table", F.explode("entry.manifests").alias("m"))
        .select("snapshot_id", "table", c("m.year").alias("year"), F.explode("m.files").alias("f"))
        .select("snapshot_id", "table", "year", "f.publicPath", "f.size", "f.sha256")
    )
    flaws = F.array(
        F.when(_unsafe(c("publicPath")), "publicPath"),
        F.when(_count_broken(c("size")), "size"),
        F.when(F.coalesce(~c("sha256").rlike(_DIGEST), F.lit(True)), "sha256"),
    )
    judged = files.withColumn("broken", F.filter(flaws, lambda f: f.isNotNull()))

    def flawed(df: DataFrame, sample: str) -> DataFrame:
        kept = df.withColumn("broken", F.filter("broken", lambda f: f.isNotNull()))
        return kept.filter(F.size("broken") > 0).select("broken", c(sample).alias("sample"))

    return Checked(
        "snapshot manifest",
        judged.filter(F.size("broken") == 0).select(
            "snapshot_id",
            "table",
            F.substring_index("year", ".", 1).cast("int").alias("year"),
            "publicPath",
            F.substring_index("size", ".", 1).cast("long").alias("size"),
            "sha256",
        ),
        flawed(judged, "publicPath")
        .unionByName(flawed(heads, "snapshot_id"))
        .unionByName(flawed(bodies, "snapshot_id")),
    )


def read_snapshot_file(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("snapshot_id"), F.col("value").alias("json")
    )


def select_files(files: DataFrame, table: str | None = None, year: int | None = None) -> DataFrame:
    """The files of a slice; `verify_slice` reads these and no others."""
    if table is not None:
        files = files.filter(F.col("table") == table)
    if year is not None:
        files = files.filter(F.col("year") == year)
    return files


def require_files(files: DataFrame, table: str | None = None, year: int | None = None) -> DataFrame:
    chosen = select_files(files, table, year)
    if chosen.isEmpty():
        raise BrokenRows(f"the snapshot has no files for {table or 'any table'}, {year or 'any year'}")
    return chosen


def digests(contents: DataFrame) -> DataFrame:
    """(path, sha256, bytes) of files given as (path, content); contents stay in their task."""
    return contents.select(
        "path",
        F.sha2(F.col("content").cast("binary"), 256).alias("found"),
        F.octet_length("content").cast("long").alias("bytes"),
    )


def verify_files(files: DataFrame, contents: DataFrame) -> DataFrame:
    """Every manifest file with `status` ok, missing or different."""
    joined = files.join(digests(contents).withColumnRenamed("path", "publicPath"), "publicPath", "left")
    status = (
        F.when(F.col("found").isNull(), "missing")
        .when(F.col("found") == F.col("sha256"), "ok")
        .otherwise("different")
    )
    return joined.select(*files.columns, status.alias("status"))


def verification_totals(verified: DataFrame) -> DataFrame:
    """Files and manifest bytes by status."""
    return verified.groupBy("status").agg(
        F.count(F.lit(1)).alias("files"), F.sum("size").alias("bytes")
    )


def scan_contents(spark: SparkSession, root: str) -> DataFrame:
    """(path relative to the data set root, content) of the files below `root`/data."""
    base = root.rstrip("/")
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{base}/{FOLDER}")
    )
    relative = F.concat(F.lit(FOLDER), F.substring_index("path", f"/{FOLDER}", -1))
    return files.select(relative.alias("path"), "content")


def slice_contents(spark: SparkSession, root: str, chosen: DataFrame) -> DataFrame:
    """(path, content) of those of the chosen files that are there; nothing else is opened.

    Their folders are listed, so that an absent file is a missing row and no error.
    """
    base = root.rstrip("/")
    wanted = sorted(r.publicPath for r in chosen.select("publicPath").distinct().collect())  # one row a file
    there = set()
    for folder in sorted({path.rpartition("/")[0] for path in wanted}):
        fs, at = _file_system(spark, f"{base}/{folder}")
        if fs.exists(at):
            there |= {f"{folder}/{status.getPath().getName()}" for status in fs.listStatus(at) if status.isFile()}
    paths = [f"{base}/{path}" for path in wanted if path in there]
    if not paths:
        return spark.createDataFrame([], "path STRING, content BINARY")
    files = spark.read.format("binaryFile").load(paths)
    relative = F.concat(F.lit(FOLDER), F.substring_index("path", f"/{FOLDER}", -1))
    return files.select(relative.alias("path"), "content")


def verify_slice(
    spark: SparkSession, files: DataFrame, root: str, table: str | None = None, year: int | None = None
) -> DataFrame:
    """Every manifest file of a table, a year or both with its status, by reading only these files."""
    chosen = require_files(files, table, year)
    return verify_files(chosen, slice_contents(spark, root, chosen))
