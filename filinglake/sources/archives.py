"""Landing scan of ZIP archives.

A member of a ZIP cannot be split, but members are apart: `scan_archives` reads the central directories
and makes every member of every archive a partition of its own, whose task seeks to the member and
streams its lines in batches. `read_archives` takes contents as rows, for file systems that only Spark can
open; there one task reads a whole archive. Write the result to the bronze table once (`land_archives`);
everything after reads that, where lines of one archive are spread freely.
"""

from __future__ import annotations

import io
import json
import sys
import zipfile
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

# The unzip step travels to the executors by value, so they need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

LINES = "archive_key STRING, member STRING, line_no LONG, line STRING"
# Lines handed to the JVM at a time.
_CHUNK = 20_000
# Central directories read side by side while a scan is planned.
_PLANNERS = 16


class ArchiveLayout(ValueError):
    """An archive without the members it should have."""


def member_prefix(names: Sequence[str], anchor: str) -> str:
    """Where members lie: the root, or the one directory that holds `anchor`."""
    if anchor in names:
        return ""
    nested = [name for name in names if name.endswith(f"/{anchor}")]
    if len(nested) != 1:
        raise ArchiveLayout(f"{len(nested)} candidates for {anchor}")
    return nested[0][: -len(anchor)]


def _member_lines(archive: zipfile.ZipFile, name: str) -> Iterator[str]:
    with archive.open(name) as raw:
        stream = io.TextIOWrapper(raw, encoding="utf-8", errors="replace", newline="\n")
        for number, line in enumerate(stream):
            line = line.removesuffix("\n").removesuffix("\r")
            yield line.removeprefix("\ufeff") if number == 0 else line


def read_archives(
    archives: DataFrame, members: Sequence[str], nested: bool = False
) -> DataFrame:
    """Lines of the wanted members of every archive in `archives` (path, content).

    With `nested`, members may lie below one directory, found by the first wanted member;
    otherwise they are expected at the root. A missing member is an error.
    """
    wanted = list(members)

    def unzip(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    names = [i.filename for i in archive.infolist() if not i.is_dir()]
                    try:
                        prefix = member_prefix(names, wanted[0]) if nested else ""
                    except ArchiveLayout as problem:
                        raise ArchiveLayout(f"{path}: {problem}") from None
                    for member in wanted:
                        if prefix + member not in names:
                            raise ArchiveLayout(f"{path} is missing {member}")
                        start, chunk = 0, []
                        for line in _member_lines(archive, prefix + member):
                            chunk.append(line)
                            if len(chunk) == _CHUNK:
                                yield _frame(path, member, start, chunk)
                                start, chunk = start + len(chunk), []
                        if chunk:
                            yield _frame(path, member, start, chunk)

    return archives.select("path", "content").mapInPandas(unzip, LINES)


def _frame(path: str, member: str, start: int, lines: list[str]) -> pd.DataFrame:
    return pd.DataFrame(
        {
            "archive_key": path,
            "member": member,
            "line_no": range(start, start + len(lines)),
            "line": lines,
        }
    )


def opened(path: str) -> pa.NativeFile:
    """A file for reading at any place, by the path or URI Spark lists it under."""
    system, at = fs.FileSystem.from_uri(path.replace("file:/", "file:///", 1) if path.startswith("file:/") and not path.startswith("file://") else path)
    return system.open_input_file(at)


@dataclass
class _Member(InputPartition):
    path: str
    member: str
    entry: str


class _MemberReader(DataSourceReader):
    def __init__(self, paths: list[str], members: list[str], nested: bool) -> None:
        self.paths, self.members, self.nested = paths, members, nested

    def _entries(self, path: str) -> list[_Member]:
        with opened(path) as file, zipfile.ZipFile(file) as archive:
            names = [i.filename for i in archive.infolist() if not i.is_dir()]
        try:
            prefix = member_prefix(names, self.members[0]) if self.nested else ""
        except ArchiveLayout as problem:
            raise ArchiveLayout(f"{path}: {problem}") from None
        for member in self.members:
            if prefix + member not in names:
                raise ArchiveLayout(f"{path} is missing {member}")
        return [_Member(path, member, prefix + member) for member in self.members]

    def partitions(self) -> list[_Member]:
        with ThreadPoolExecutor(_PLANNERS) as pool:
            return [entry for found in pool.map(self._entries, self.paths) for entry in found]

    def read(self, partition: _Member) -> Iterator[pa.RecordBatch]:
        with opened(partition.path) as file, zipfile.ZipFile(file) as archive:
            start, chunk = 0, []
            for line in _member_lines(archive, partition.entry):
                chunk.append(line)
                if len(chunk) == _CHUNK:
                    yield _batch(partition, start, chunk)
                    start, chunk = start + len(chunk), []
            if chunk:
                yield _batch(partition, start, chunk)


def _batch(at: _Member, start: int, lines: list[str]) -> pa.RecordBatch:
    n = len(lines)
    numbers = pa.array(range(start, start + n), pa.int64())
    return pa.RecordBatch.from_arrays(
        [pa.array([at.path] * n), pa.array([at.member] * n), numbers, pa.array(lines, pa.string())],
        names=["archive_key", "member", "line_no", "line"],
    )


class ArchiveMembers(DataSource):
    """Lines of members of archives; options `paths` and `members` are JSON lists, `nested` true or false."""

    @classmethod
    def name(cls) -> str:
        return "archive_members"

    def schema(self) -> str:
        return LINES

    def reader(self, schema) -> DataSourceReader:
        return _MemberReader(
            json.loads(self.options["paths"]), json.loads(self.options["members"]), self.options["nested"] == "true"
        )


def scan_members(
    spark: SparkSession, paths: Sequence[str], members: Sequence[str], nested: bool = False
) -> DataFrame:
    """Lines of the wanted members of the given archives, a task for every member of every archive.

    Layouts as in `read_archives`; a missing member is an error while the scan is planned.
    """
    if not paths:
        return spark.createDataFrame([], LINES)
    spark.dataSource.register(ArchiveMembers)
    return (
        spark.read.format("archive_members")
        .option("paths", json.dumps(list(paths)))
        .option("members", json.dumps(list(members)))
        .option("nested", "true" if nested else "false")
        .load()
    )


def scan_archives(
    spark: SparkSession, path: str, members: Sequence[str], nested: bool = False
) -> DataFrame:
    """`scan_members` over the archives of a folder; their contents are not read while they are listed."""
    found = archive_sizes(spark, path).select("rawKey").collect()  # one row per archive
    return scan_members(spark, sorted(r.rawKey for r in found), members, nested)


def land_archives(lines: DataFrame, path: str) -> None:
    """Append scanned lines to the bronze table, by member, in range-split files."""
    (
        lines.repartitionByRange("member", "archive_key", "line_no")
        .sortWithinPartitions("member", "archive_key", "line_no")
        .write.mode("append")
        .partitionBy("member")
        .parquet(path)
    )


def archive_sizes(spark: SparkSession, path: str) -> DataFrame:
    """(rawKey, bytes) without reading contents."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(path)
    return files.select(F.col("path").alias("rawKey"), F.col("length").alias("bytes"))
