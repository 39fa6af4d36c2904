"""One row per key: the first or the last in file order.

Both are aggregates, so copies of a key are reduced before the shuffle and a key that holds a
third of the input never gathers in one task, as it would in a ranking window.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_column(order: Column | str) -> Column:
    return F.col(order) if isinstance(order, str) else order


def _one_per_key(df: DataFrame, keys: Sequence[str], least: bool, order: Column | str, more: Mapping[str, Column]) -> DataFrame:
    rest = [name for name in df.columns if name not in keys]
    if not rest:
        return df.groupBy(*keys).agg(*[one.alias(name) for name, one in more.items()]) if more else df.distinct()
    # The order leads the row it places and is sent once; a row without order is never picked.
    by = as_column(order)
    placed = order if isinstance(order, str) else None  # a made order is none of the columns
    held = [name for name in rest if name != placed]
    entry = F.struct(by.alias("_by"), F.struct(*held).alias("_rest")) if held else F.struct(by.alias("_by"))
    if any("map<" in df.schema[name].dataType.simpleString() for name in held):  # maps have no order
        picked = (F.min_by if least else F.max_by)(entry, by)
    else:
        picked = (F.min if least else F.max)(F.when(by.isNotNull(), entry))
    cells = {name: F.col("_row._by") if name == placed else F.col("_row._rest")[name] for name in rest}
    return (
        df.groupBy(*keys)
        .agg(picked.alias("_row"), *[one.alias(name) for name, one in more.items()])
        .select(*[F.col(name) if name in keys else cells[name].alias(name) for name in df.columns], *more)
    )


def first_per_key(df: DataFrame, keys: Sequence[str], order: Column | str) -> DataFrame:
    return _one_per_key(df, keys, True, order, {})


def last_per_key(df: DataFrame, keys: Sequence[str], order: Column | str, **more: Column) -> DataFrame:
    """The last row of each key, and aggregates over all rows of the key."""
    return _one_per_key(df, keys, False, order, more)


def side_by_side(*parts: DataFrame) -> DataFrame:
    """The columns of several one-row tables in one row."""
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return rows.agg(*[F.first(name, ignorenulls=True).alias(name) for name in rows.columns])
