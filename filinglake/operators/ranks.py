"""L2: ranks and cuts of a globally sorted list, over any number of tasks."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from filinglake.session import work_path

# Rows of a part that one task numbers.
PART_ROWS = 200_000


def global_rank(df: DataFrame, order: list[str], name: str, part_rows: int = PART_ROWS) -> DataFrame:
    """`df` with its gapless rank from 0 in the ascending order of `order`, nulls first.

    Rows are split by range once and written with the number of their part, because a second
    sampling could draw other borders. A part is numbered by itself and shifted by the rows of the
    parts before it. Rows that tie in `order` get neighbouring ranks; which of them comes first is
    fixed only by the other columns being equal, so name a total order where that matters.
    """
    spark = df.sparkSession
    path = work_path(spark, "ranked")
    parts = max(1, math.ceil(df.count() / part_rows))
    split = df.repartitionByRange(parts, *order).withColumn("__part", F.spark_partition_id())
    split.write.parquet(path)
    split = spark.read.schema(split.schema).parquet(path)
    sizes = split.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    # One row per part.
    before = sizes.select(
        "__part", (F.sum("__n").over(Window.orderBy("__part")) - F.col("__n")).alias("__before")
    )
    own = F.row_number().over(Window.partitionBy("__part").orderBy(*order)) - 1
    return (
        split.withColumn("__own", own)
        .join(F.broadcast(before), "__part")
        .withColumn(name, (F.col("__own") + F.col("__before")).cast("long"))
        .drop("__part", "__own", "__before")
    )


def batches(values: DataFrame, column: str, size: int, part_rows: int = PART_ROWS) -> DataFrame:
    """(batch, list): the sorted distinct values cut into lists of `size`, the last one shorter."""
    ranked = global_rank(values.select(column).where(F.col(column).isNotNull()).distinct(), [column], "__rank", part_rows)
    return (
        ranked.groupBy(F.floor(F.col("__rank") / size).cast("long").alias("batch"))
        .agg(F.array_sort(F.collect_list(column)).alias(column))
    )
