"""Exact order statistics without sorting a group in one task.

`floor_quantiles` is for values with few distinct levels (days of lag): count per level, then
a running sum. `upper_median` is for continuous values: a logarithmic histogram finds the one
bin that holds the wanted rank, and only that bin's distinct values are ranked. Both are exact.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def floor_quantiles(
    df: DataFrame, keys: Sequence[str], value: str, quantiles: Mapping[str, float]
) -> DataFrame:
    """Per key: n and, for each q, the value at 0-based rank min(n-1, floor(q*n))."""
    levels = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_c"))
    upto = Window.partitionBy(*keys).orderBy(value)
    everything = Window.partitionBy(*keys)
    ranked = levels.select(
        *keys,
        value,
        "_c",
        F.sum("_c").over(upto.rowsBetween(Window.unboundedPreceding, 0)).alias("_cum"),
        F.sum("_c").over(everything).alias("_n"),
    )
    at = {
        name: F.least(F.col("_n") - 1, F.floor(F.lit(q) * F.col("_n"))) for name, q in quantiles.items()
    }
    return ranked.groupBy(*keys).agg(
        F.sum("_c").alias("n"),
        *[F.min(F.when(F.col("_cum") > rank, F.col(value))).alias(name) for name, rank in at.items()],
    )


def level_quantile(levels: Column, q: float) -> Column:
    """The value at 0-based rank min(n-1, floor(q*n)) of sorted (value, n) structs, or null."""
    total = F.aggregate(levels, F.lit(0).cast("long"), lambda n, level: n + level["n"])
    rank = F.least(total - 1, F.floor(F.lit(q) * total))
    # The first level is at rank 0; each further one begins where the counts before it end.
    start = F.struct(F.lit(0).cast("long").alias("before"), F.get(levels, F.lit(0))["value"].alias("value"))

    def step(state: Column, level: Column) -> Column:
        return F.struct(
            (state["before"] + level["n"]).alias("before"),
            F.when(state["before"] <= rank, level["value"]).otherwise(state["value"]).alias("value"),
        )

    return F.aggregate(levels, start, step, lambda state: state["value"])


# Bins per factor e. A bin spans 0.1 % of its value, so it holds a sliver of any real group.
_BINS = 1000


def upper_median(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """Per key: n and sorted[floor(n/2)] of a non-null double."""
    v = F.col(value)
    # log is monotone, so bins keep the order of the values: negatives, zero, positives.
    depth = F.floor(F.log(F.abs(v)) * _BINS) + F.lit(2_000_000)
    binned = df.select(
        key,
        value,
        F.when(v > 0, depth).when(v < 0, -depth).otherwise(F.lit(0)).cast("long").alias("_bin"),
    )
    counts = binned.groupBy(key, "_bin").agg(F.count(F.lit(1)).alias("_c"))
    upto = Window.partitionBy(key).orderBy("_bin").rowsBetween(Window.unboundedPreceding, 0)
    target = (
        counts.select(
            key,
            "_bin",
            F.sum("_c").over(upto).alias("_cum"),
            "_c",
            F.sum("_c").over(Window.partitionBy(key)).alias("_n"),
        )
        .withColumn("_rank", F.floor(F.col("_n") / 2))
        .filter((F.col("_cum") > F.col("_rank")) & (F.col("_cum") - F.col("_c") <= F.col("_rank")))
        .select(key, "_bin", "_n", (F.col("_rank") - F.col("_cum") + F.col("_c")).alias("_rest"))
    )
    inside = (
        binned.join(target, [key, "_bin"])
        .groupBy(key, value, "_n", "_rest")
        .agg(F.count(F.lit(1)).alias("_c"))
    )
    within = Window.partitionBy(key).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    return (
        inside.withColumn("_cum", F.sum("_c").over(within))
        .filter(F.col("_cum") > F.col("_rest"))
        .groupBy(key)
        .agg(F.max("_n").alias("n"), F.min(value).alias(name))
    )
