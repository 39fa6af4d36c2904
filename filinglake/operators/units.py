"""One unit for 13F values: whole dollars.

The unit is decided per filing. The deciding statistic is the filing's upper median of
value / shares, but only its side of one threshold matters, and `sorted[floor(n/2)] > t` holds
exactly when at most floor(n/2) prices are <= t. So the decision needs three counters per
filing instead of a sort: they combine before the shuffle, and a filing that holds a third of
all rows costs no more than any other.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filinglake.operators.keyed import as_column, first_per_key
from filinglake.operators.quantiles import upper_median


@dataclass(frozen=True)
class UnitRule:
    """Fixed values of the unit rule."""

    dollars_from: str = "2023-01-01"
    scale: float = 1000.0
    implausible_if_thousands: float = 5.0
    implausible_if_dollars: float = 0.5
    min_rows: int = 5


RULE = UnitRule()


def judged_price(price: str = "value") -> Column:
    """Implied price of an ordinary share row, null for any row that must not be judged by."""
    c = F.col
    ordinary = (
        (c("sharesType") == "SH")
        & F.coalesce(c("putCall") == "", F.lit(True))
        & (c(price) != 0)
        & ~F.isnan(price)
        & (c("sharesAmount") > 0)
        & ~F.isnan("sharesAmount")
    )
    return F.when(ordinary, c(price) / c("sharesAmount"))


def unit_decisions(
    filings: DataFrame, holdings: DataFrame, order: str | Column, rule: UnitRule = RULE
) -> DataFrame:
    """(accession, scaled, unitSource, overrodeDate) for every accession with a filing (A4)."""
    dated = first_per_key(
        filings.select("accession", "filingDate", as_column(order).alias("_ord")),
        ["accession"],
        "_ord",
    ).select("accession", "filingDate")
    price = F.col("price")
    counted = (
        holdings.select("accession", judged_price().alias("price"))
        .filter(price.isNotNull())
        .groupBy("accession")
        .agg(
            F.count(price).alias("n"),
            F.count_if(price <= rule.implausible_if_thousands).alias("n_low"),
            F.count_if(price < rule.implausible_if_dollars).alias("n_tiny"),
        )
    )
    middle = F.floor(F.col("n") / 2)
    by_date = F.coalesce(
        F.col("filingDate") < F.lit(rule.dollars_from).cast("date"), F.lit(False)
    )
    judged = F.coalesce(F.col("n") >= rule.min_rows, F.lit(False))
    contradicted = judged & F.when(by_date, F.col("n_low") <= middle).otherwise(
        F.col("n_tiny") > middle
    )
    return dated.join(counted, "accession", "left").select(
        "accession",
        (by_date != contradicted).alias("scaled"),
        F.when(judged, "median").otherwise("date").alias("unitSource"),
        contradicted.alias("overrodeDate"),
    )


def to_dollars(
    filings: DataFrame, holdings: DataFrame, order: str | Column, rule: UnitRule = RULE
) -> DataFrame:
    """Holdings with `value` in whole dollars and `valueUnitSource` saying who decided.

    Not idempotent by nature, so rows already decided are refused: their value is replaced by
    an error at run time rather than scaled twice.
    """
    decisions = unit_decisions(filings, holdings, order, rule)
    c = F.col
    undecided = F.when(
        c("valueUnitSource").isNull(), c("value")
    ).otherwise(
        F.raise_error(F.lit("values were already converted; start from a raw parse")).cast("double")
    )
    joined = holdings.withColumn("value", undecided).join(decisions, "accession", "left")
    return joined.select(
        *[
            F.when(c("scaled"), c("value") * rule.scale).otherwise(c("value")).alias(name)
            if name == "value"
            else F.when(c("value").isNotNull(), F.coalesce(c("unitSource"), F.lit("unknown"))).alias(name)
            if name == "valueUnitSource"
            else c(name)
            for name in holdings.columns
        ]
    )


def value_report(
    filings: DataFrame, holdings: DataFrame, order: str | Column, rule: UnitRule = RULE
) -> DataFrame:
    """One row: what the conversion did, by rows and by filings (A5)."""
    decisions = unit_decisions(filings, holdings, order, rule)
    valued = (
        holdings.filter(F.col("value").isNotNull())
        .groupBy("accession")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    per_filing = decisions.join(valued, "accession", "full")
    c = F.col
    n = F.coalesce(c("n"), F.lit(0))
    return per_filing.agg(
        F.coalesce(F.sum(F.when(c("scaled"), n)), F.lit(0)).alias("scaled"),
        F.coalesce(F.sum(F.when(~c("scaled"), n)), F.lit(0)).alias("untouched"),
        F.coalesce(F.sum(F.when(c("scaled").isNull(), n)), F.lit(0)).alias("unresolvedFilingDate"),
        F.count_if(c("overrodeDate")).alias("overrodeDate"),
        F.count_if(c("unitSource") == "date").alias("decidedByDateAlone"),
    )


def implied_price_by_month(filings: DataFrame, holdings: DataFrame, order: str | Column) -> DataFrame:
    """Median implied price of share rows by filing month: the cutover made visible."""
    months = first_per_key(
        filings.select(
            "accession",
            F.trunc("filingDate", "month").alias("month"),
            as_column(order).alias("_ord"),
        ),
        ["accession"],
        "_ord",
    ).select("accession", "month")
    priced = holdings.select("accession", judged_price().alias("price")).filter(
        F.col("price").isNotNull()
    )
    return upper_median(priced.join(months, "accession"), "month", "price", "medianImpliedPrice")
