"""Tab-separated members: lenient (S2) and strict-width (S3) scans.

A member has no quoting: a line is a record and a tab a boundary. The header is found per file,
so files of different years, with other columns or another order, are read in one pass: the
header table has one row per file, and every line looks up the position of its cells there.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from filinglake.functions.text import trimmed
from filinglake.operators.checks import BrokenRows

# Headers of so many files are sent to all tasks (about 200 bytes each); those of more are shuffled.
BROADCAST_FILES = 20_000


def read_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Lines of text files as (archive_key, ord, line), `ord` ascending in file order.

    Only a line feed ends a line; a carriage return before it and a byte order mark at the
    start of a file are dropped.
    """
    c = F.col
    raw = spark.read.option("lineSep", "\n").text(paths)
    placed = raw.select(
        c("_metadata.file_path").alias("archive_key"),
        F.struct(
            c("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row")
        ).alias("ord"),
        c("value"),
    )
    line = F.regexp_replace("value", "\r$", "")
    return placed.select(
        "archive_key",
        "ord",
        F.when(c("ord.block") == 0, F.regexp_replace(line, "^\ufeff", "")).otherwise(line).alias("line"),
    )


def landed_lines(bronze: DataFrame, member: str) -> DataFrame:
    """Lines of one member of the bronze table written by `sources.archives`."""
    return bronze.filter(F.col("member") == member).select(
        "archive_key", F.col("line_no").alias("ord"), "line"
    )


def _headers(lines: DataFrame, first: Column | None) -> DataFrame:
    """One row per file with its header cells. `first` marks header lines when they are known."""
    if first is not None:
        header = lines.filter(first).select("archive_key", F.col("line").alias("_header"), F.col("ord").alias("_at"))
    else:
        header = lines.groupBy("archive_key").agg(
            F.min_by("line", "ord").alias("_header"), F.min("ord").alias("_at")
        )
    cells = F.transform(F.split("_header", "\t", -1), lambda cell: trimmed(cell))
    return header.select("archive_key", "_at", cells.alias("_header"))


def _count_headers(headers: DataFrame, required: Sequence[str], member: str) -> int:
    """How many files there are; raises when one lacks a required column. Reads one row per file."""
    missing = F.array_except(F.array(*[F.lit(name) for name in required]), F.col("_header"))
    bad = headers.filter(F.size(missing) > 0).select("archive_key", missing.alias("missing"))
    files, count = headers.agg(F.count(F.lit(1)), F.count_if(F.size(missing) > 0)).first()
    if count:
        sample = bad.orderBy("archive_key").limit(3).collect()
        detail = "; ".join(f"{r.archive_key} lacks {', '.join(r.missing)}" for r in sample)
        raise BrokenRows(f"{member}: {count} file(s) lack columns, e.g. {detail}")
    return files


def _headless(lines: DataFrame, leading: Column) -> DataFrame:
    """Files whose leading lines are all empty, with a header of no cells."""
    filled = lines.filter(leading).groupBy("archive_key").agg(F.bool_or(F.col("line") != "").alias("_filled"))
    return filled.filter(~F.col("_filled")).select("archive_key", F.array().cast("array<string>").alias("_header"))


def _with_header(lines: DataFrame, headers: DataFrame, files: int) -> DataFrame:
    # One row per file. Shuffled by file, all lines of one file would meet in one task.
    joined = lines.join(F.broadcast(headers) if files <= BROADCAST_FILES else headers, "archive_key")
    return joined.filter(F.col("ord") > F.col("_at"))


def records(
    lines: DataFrame,
    required: Sequence[str],
    optional: Sequence[str] = (),
    first: Column | None = None,
    check: bool = True,
    member: str = "member",
) -> DataFrame:
    """Rows of strings by column name, with archive_key and ord.

    Blank lines are dropped, missing trailing cells and absent optional columns read as blank,
    extra cells are ignored, and of two columns with one name the last counts. `first` tells
    header lines apart without a pass over the text, for instance `ord = 0` on landed lines.
    """
    headers = _headers(lines, first)
    files = _count_headers(headers, required if check else (), member)
    names = [*required, *optional]
    # Position of the last cell with the name, 0-based; -1 when there is none.
    width = F.size("_header")
    at = [
        F.when(
            F.array_contains("_header", name),
            width - F.array_position(F.reverse("_header"), name),
        ).otherwise(-1).cast("int").alias(f"_at_{name}")
        for name in names
    ]
    placed = _with_header(lines, headers.select("archive_key", "_at", *at), files)
    body = placed.filter(trimmed(F.col("line")) != "").withColumn("_cells", F.split("line", "\t", -1))
    return body.select(
        "archive_key",
        "ord",
        *[F.coalesce(F.get("_cells", F.col(f"_at_{name}")), F.lit("")).alias(name) for name in names],
    )


def strict_records(
    lines: DataFrame,
    columns: Sequence[str],
    check: bool = True,
    member: str = "member",
    leading: Column | None = None,
) -> DataFrame:
    """Rows by column name plus `malformed`: the line is not as wide as its header (S3).

    The header is a file's first line that is not empty. `leading` marks the lines among which it is
    in every file, for instance the first ten of landed members: then no pass over all lines looks for
    it, and a file without a filled line among these is refused or, unchecked, has no rows. A tab inside a cell shifts every later cell, so such a row is kept for counting but its
    cells are null. Empty lines are skipped; of two columns with one name the first counts.
    """
    filled = F.col("line") != ""
    headers = _headers(lines.filter(filled if leading is None else leading & filled), None)
    if check and leading is not None:
        _count_headers(_headless(lines, leading), columns, member)
    files = _count_headers(headers, columns if check else (), member)
    at = [(F.array_position("_header", name) - 1).cast("int").alias(f"_at_{name}") for name in columns]
    placed = _with_header(
        lines, headers.select("archive_key", "_at", F.size("_header").alias("_width"), *at), files
    )
    body = placed.filter(F.col("line") != "").withColumn("_cells", F.split("line", "\t", -1))
    malformed = F.size("_cells") != F.col("_width")
    return body.select(
        "archive_key",
        "ord",
        malformed.alias("malformed"),
        *[F.when(~malformed, F.get("_cells", F.col(f"_at_{name}"))).alias(name) for name in columns],
    )


def width_counts(rows: DataFrame) -> DataFrame:
    """One row: lines read and lines of the wrong width."""
    return rows.agg(F.count(F.lit(1)).alias("rows"), F.count_if("malformed").alias("malformed"))
