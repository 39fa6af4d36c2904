"""Tickers by CUSIP and date: the first span that covers the day wins.

Spans come in the order of trust (`ord`). Days are numbered and cut into buckets of 128 days, buckets into
blocks of 128. The ends of a span go to their buckets, the buckets it covers wholly to their blocks, so that a
bucket and a block hold at most 128 * 129 / 2 different ranges, however many spans a CUSIP has; one with more than
a few is resolved unit by unit. All of a CUSIP in one block (45 years) is one map, which a holding joins once and
in which it looks up its bucket and its day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filinglake.functions import dates, text

# Days are numbered from the first day of the calendar; an open end reaches past the year 45,000.
_FIRST_DAY = "0001-01-01"
_LAST = 2**24 - 1
# Days of a bucket and buckets of a block, as a power of two; what lists whole buckets in a map; ranges searched one by one.
_BITS = 7
_UNITS = 2**_BITS
_WHOLE = -1
_FEW = 16


def _clean_spans(spans: DataFrame) -> DataFrame:
    """Trimmed spans; those without a CUSIP or a ticker do not count."""
    c = F.col
    return spans.select(
        F.upper(text.trimmed(c("cusip"))).alias("cusip"),
        text.text(c("ticker")).alias("ticker"),
        c("fromDate").cast("date").alias("fromDate"),
        c("toDate").cast("date").alias("toDate"),
        "ord",
    ).filter((c("cusip") != "") & c("ticker").isNotNull())


def _day_number(day: Column) -> Column:
    return F.datediff(day, F.lit(_FIRST_DAY).cast("date"))


def _up(number: Column, levels: int = 1) -> Column:
    """The bucket of a day or the block of a bucket; with two levels the block of a day."""
    return F.shiftright(number, levels * _BITS)


def _unit(number: Column) -> Column:
    return number.bitwiseAND(_UNITS - 1)


def _ranges(spans: DataFrame, blocks: DataFrame) -> DataFrame:
    """(cusip, block, bucket, low, high, best): ranges of days in a bucket, and of whole buckets in one of `blocks`."""
    c = F.col
    sized = (
        _clean_spans(spans)
        .select(
            "cusip",
            F.struct("ord", "ticker").alias("best"),
            F.coalesce(_day_number(c("fromDate")), F.lit(0)).alias("_from"),
            F.coalesce(_day_number(c("toDate")), F.lit(_LAST)).alias("_to"),
        )
        .filter(c("_from") <= c("_to"))
        .select("*", _up(c("_from")).alias("_first"), _up(c("_to")).alias("_last"), _unit(c("_from")).alias("_low"), _unit(c("_to")).alias("_high"))
    )
    inside = c("_first") < c("_last")

    def part(bucket: str, low: Column, high: Column) -> Column:
        return F.struct(_up(c(bucket)).alias("block"), c(bucket).alias("bucket"), low.cast("int").alias("low"), high.cast("int").alias("high"))

    ends = F.array(
        F.when(~inside, part("_first", c("_low"), c("_high"))),
        F.when(inside & (c("_low") > 0), part("_first", c("_low"), F.lit(_UNITS - 1))),
        F.when(inside & (c("_high") < _UNITS - 1), part("_last", F.lit(0), c("_high"))),
    )
    days = sized.select("cusip", "best", F.inline(ends)).filter("bucket IS NOT NULL")
    whole = sized.filter(inside).select(
        "cusip",
        "best",
        (c("_first") + F.when(c("_low") > 0, 1).otherwise(0)).alias("_from"),
        (c("_last") - F.when(c("_high") < _UNITS - 1, 1).otherwise(0)).alias("_to"),
    )
    start = F.shiftleft(c("block"), _BITS)
    buckets = (
        whole.filter(c("_from") <= c("_to"))
        .join(F.broadcast(blocks), (_up(c("_from")) <= c("block")) & (c("block") <= _up(c("_to"))))
        .select(
            "cusip",
            "best",
            "block",
            F.lit(_WHOLE).alias("bucket"),
            (F.greatest(c("_from"), start) - start).alias("low"),
            (F.least(c("_to"), start + (_UNITS - 1)) - start).alias("high"),
        )
    )
    return days.unionByName(buckets)


def _first_over(ranges: Column, unit: Column) -> Column:
    return F.get(F.filter(ranges, lambda r: (r["low"] <= unit) & (unit <= r["high"])), F.lit(0))


def _nodes(spans: DataFrame, blocks: DataFrame) -> DataFrame:
    """(cusip, block, nodes): by bucket the ranges in order, or, of many, the first range over each unit."""
    c = F.col
    key = ["cusip", "block", "bucket"]
    found = _ranges(spans, blocks).groupBy(*key, "low", "high").agg(F.min("best").alias("best"))
    ordered = F.array_sort(F.collect_list(F.struct("best.ord", "best.ticker", "low", "high")))
    many = F.size("ranges") > _FEW
    units = F.transform(F.sequence(F.lit(0), F.lit(_UNITS - 1)), lambda unit: _first_over(c("ranges"), unit))
    node = F.struct(F.when(~many, c("ranges")).alias("few"), F.when(many, units).alias("units"))
    return (
        found.groupBy(*key)
        .agg(ordered.alias("ranges"))
        .select(*key, node.alias("node"))
        .groupBy("cusip", "block")
        .agg(F.map_from_entries(F.collect_list(F.struct("bucket", "node"))).alias("nodes"))
    )


def _matched(holdings: DataFrame, spans: DataFrame) -> DataFrame:
    """Holdings plus `_cusip` and `_ticker` (null when none)."""
    c = F.col
    day = _day_number(dates.utc_day(c("availableAt")))
    keyed = holdings.select("*", F.upper(text.trimmed(c("cusip"))).alias("_cusip"), day.alias("_day"), _up(day, 2).alias("_block"))
    blocks = holdings.select(_up(day, 2).alias("block")).filter("block IS NOT NULL").distinct()
    table = _nodes(spans, blocks)

    def best(bucket: Column, unit: Column) -> Column:
        node = table["nodes"][bucket]
        return F.coalesce(_first_over(node["few"], unit), F.get(node["units"], unit))

    bucket = _up(keyed["_day"])
    first = F.least(best(bucket, _unit(keyed["_day"])), best(F.lit(_WHOLE), _unit(bucket)))
    joined = keyed.join(table, (keyed["_cusip"] == table["cusip"]) & (keyed["_block"] == table["block"]), "left")
    return joined.select(*[keyed[name] for name in holdings.columns], keyed["_cusip"], first["ticker"].alias("_ticker"))


def resolve_tickers(holdings: DataFrame, spans: DataFrame) -> DataFrame:
    """Holdings with `resolvedTicker` as traded on each row's own UTC day.

    The day is the UTC day of `availableAt`, so a filing dated on a span's last day, which
    becomes available after midnight UTC, takes the span of the next day. Rows no span covers
    get null, also where an earlier pass had left a ticker.
    """
    matched = _matched(holdings, spans)
    return matched.select(
        *[
            F.col("_ticker").alias(name) if name == "resolvedTicker" else F.col(name)
            for name in holdings.columns
        ]
    )


def ticker_report(holdings: DataFrame, spans: DataFrame) -> DataFrame:
    """One row: resolved, unresolved, rows outside every span, distinct CUSIPs without spans."""
    c = F.col
    matched = _matched(holdings.select("cusip", "availableAt"), spans)
    # One row per CUSIP before the last step, so distinct CUSIPs need no further shuffle of rows.
    counted = matched.groupBy("_cusip").agg(
        F.count_if(c("_ticker").isNotNull()).alias("resolved"),
        F.count_if(c("_ticker").isNull()).alias("unresolved"),
    )
    listed = _clean_spans(spans).select(c("cusip").alias("_cusip")).distinct().withColumn("_known", F.lit(True))
    known = c("_known").isNotNull()
    per_cusip = counted.join(listed, "_cusip", "left").select(
        "resolved", "unresolved", F.when(known, c("unresolved")).otherwise(0).alias("outside"), known.alias("known")
    )
    return per_cusip.agg(
        F.coalesce(F.sum("resolved"), F.lit(0)).alias("resolved"),
        F.coalesce(F.sum("unresolved"), F.lit(0)).alias("unresolved"),
        F.count_if(~c("known")).alias("unresolvedCusips"),
        F.coalesce(F.sum("outside"), F.lit(0)).alias("outsideEverySpan"),
    )
