"""Rows and the rows that break a rule, kept apart so that a run can be strict or not."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class BrokenRows(ValueError):
    """Input that breaks a rule of its table."""


@dataclass(frozen=True)
class Checked:
    """Good rows and rejects of one table. Both are lazy."""

    table: str
    rows: DataFrame
    rejects: DataFrame
    # (broken, sample) of every row, where one pass is to see both sides.
    verdicts: DataFrame | None = None

    def strict(self) -> DataFrame:
        """The rows, or an error naming every broken field with its count and a sample."""
        found = (
            self.rejects.select(F.explode("broken").alias("field"), "sample")
            .groupBy("field")
            .agg(F.count(F.lit(1)).alias("n"), F.min("sample").alias("sample"))
            .orderBy("field")
            .collect()  # one row per rule
        )
        if found:
            detail = "; ".join(f"{r.field} x{r.n}, e.g. {r.sample}" for r in found)
            raise BrokenRows(f"{self.table}: {detail}")
        return self.rows


# Prefix of the typed columns while rules are judged.
TYPED = "_typed_"


def typed(name: str) -> Column:
    """A typed column, for use in a rule."""
    return F.col(f"{TYPED}{name}")


def split_broken(
    table: str,
    df: DataFrame,
    rules: Mapping[str, Column],
    columns: Mapping[str, Column],
    sample: Column,
) -> Checked:
    """Type `df` to `columns` and apply named rules (true means broken).

    Rules see the columns of `df` and, by `typed(name)`, the typed ones. The verdict leaves a
    generator, so that filters on it stay above the typing and every cell is read once.
    """
    tested = {name: F.coalesce(rule, F.lit(False)) for name, rule in rules.items()}
    any_broken = reduce(lambda a, b: a | b, tested.values(), F.lit(False))
    names = F.filter(
        F.array(*[F.when(rule, F.lit(name)) for name, rule in tested.items()]),
        lambda name: name.isNotNull(),
    )
    read = df.select("*", *[column.alias(f"{TYPED}{name}") for name, column in columns.items()])
    judged = read.select("*", F.explode(F.array(any_broken)).alias("_broken"))
    where = sample.cast("string").alias("sample")
    return Checked(
        table,
        judged.filter(~F.col("_broken")).select(*[typed(name).alias(name) for name in columns]),
        judged.filter("_broken").select(names.alias("broken"), where),
        judged.select(F.col("_broken").alias("broken"), where),
    )
