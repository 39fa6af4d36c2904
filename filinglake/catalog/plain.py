"""Result columns as plain values: days and instants as ISO text, maps and lists as text.

Applied to every registered query last, so results compare the same in any client and zone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _plain(field: T.StructField) -> Column:
    cell = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.TimestampType):
        cell = F.date_format(cell, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    elif isinstance(field.dataType, T.DateType):
        cell = cell.cast("string")
    elif isinstance(field.dataType, T.MapType):
        pairs = F.transform(
            F.array_sort(F.map_entries(cell)), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))
        )
        cell = F.array_join(pairs, ";")
    elif isinstance(field.dataType, T.ArrayType):
        cell = F.array_join(cell, ",")
    elif isinstance(field.dataType, (T.IntegerType, T.ShortType)):
        cell = cell.cast("bigint")
    elif isinstance(field.dataType, T.DecimalType):
        cell = cell.cast("double")
    return cell.alias(field.name)


def plain(df: DataFrame) -> DataFrame:
    return df.select(*[_plain(field) for field in df.schema.fields])
