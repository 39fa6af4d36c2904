"""When a filing could first be known, from an acceptance time that may be missing or odd."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filinglake.functions.dates import ACCEPTANCE_DELAY

# How far acceptance may lie before or after the filed date, and the source names.
BEFORE = "interval 96 hours"
AFTER = "interval 48 hours"
FALLBACK = "interval 24 hours"
FROM_ACCEPTANCE = "submissions"
FROM_FILED_DATE = "filed-date-fallback"


def filing_availability(filings: DataFrame, accepted: DataFrame) -> DataFrame:
    """`filings` (accession, filed, ...) with availableAt and availabilitySource.

    `accepted` holds one acceptance instant per accession. Both bounds are inclusive.
    """
    c = F.col
    usable = (
        c("accepted").isNotNull()
        & (c("accepted") >= c("filed") - F.expr(BEFORE))
        & (c("accepted") <= c("filed") + F.expr(AFTER))
    )
    joined = filings.join(accepted.select("accession", "accepted"), "accession", "left")
    return joined.select(
        *filings.columns,
        F.when(usable, c("accepted") + F.expr(ACCEPTANCE_DELAY))
        .otherwise(c("filed") + F.expr(FALLBACK))
        .alias("availableAt"),
        F.when(usable, FROM_ACCEPTANCE).otherwise(FROM_FILED_DATE).alias("availabilitySource"),
    )
