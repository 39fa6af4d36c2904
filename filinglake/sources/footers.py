"""Parquet footers as a table: which columns, of which kind of type, every file below a path has.

A folder may hold files of several writers: a column added later is absent in older files, and Spark
gives nulls for it without telling which rows never had it. Footers are read by tasks, no data pages
with them; readers then plan one scan for every group of files with the same columns.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filinglake.sources.archives import opened

SCHEMA = "file STRING, n_rows LONG, columns ARRAY<STRUCT<name: STRING, kind: STRING>>"
# Kinds of types that one declared column may mix; a declared double takes whole numbers, too.
_KINDS: tuple[tuple[str, Callable[[pa.DataType], bool]], ...] = (
    ("text", lambda t: pa.types.is_string(t) or pa.types.is_large_string(t)),
    ("whole", pa.types.is_integer),
    ("double", pa.types.is_floating),
    ("instant", pa.types.is_timestamp),
    ("date", pa.types.is_date),
    ("flag", pa.types.is_boolean),
)
_DECLARED = {"string": "text", "long": "whole", "integer": "whole", "double": "double", "timestamp": "instant", "date": "date", "boolean": "flag"}


def _kind(found: pa.DataType) -> str:
    return next((name for name, is_one in _KINDS if is_one(found)), str(found))


def _footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for path in batch["path"].to_pylist():
            with opened(path) as file:
                footer = pq.ParquetFile(file)
                columns = [{"name": f.name, "kind": _kind(f.type)} for f in footer.schema_arrow]
                rows.append({"file": path, "n_rows": footer.metadata.num_rows, "columns": columns})
        shape = pa.list_(pa.struct([("name", pa.string()), ("kind", pa.string())]))
        yield pa.RecordBatch.from_pylist(rows, pa.schema([("file", pa.string()), ("n_rows", pa.int64()), ("columns", shape)]))


def read_footers(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """file, n_rows and columns (name, kind) of every Parquet file below `paths`.

    Only the listing is asked of Spark's file source, and tasks open the files by pyarrow's file systems.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    return listed.load(list(paths)).select("path").mapInArrow(_footers, SCHEMA)


def _names() -> Column:
    return F.array_sort(F.transform("columns", lambda c: c["name"]))


def schema_groups(footers: DataFrame) -> list[tuple[frozenset[str], list[str]]]:
    """Column names and the files that have just these; file names reach the driver, as for any scan Spark plans."""
    found = footers.groupBy(_names().alias("names")).agg(F.array_sort(F.collect_list("file")).alias("files"))
    return [(frozenset(r["names"]), r["files"]) for r in found.orderBy("names").collect()]


def conflicts(footers: DataFrame, schema: T.StructType) -> DataFrame:
    """file, column, kind and declared kind wherever a file holds a declared column as another kind of type."""
    declared = F.create_map(*[F.lit(x) for f in schema for x in (f.name, _DECLARED.get(f.dataType.typeName(), ""))])
    cells = footers.select("file", F.explode("columns").alias("c")).select("file", F.col("c.name").alias("column"), "c.kind")
    named = cells.withColumn("declared", F.try_element_at(declared, F.col("column"))).where("declared <> ''")
    return named.where((F.col("kind") != F.col("declared")) & ~((F.col("kind") == "whole") & (F.col("declared") == "double")))
