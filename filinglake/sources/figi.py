"""Responses of the CUSIP mapping service.

One response answers one request, item by item in the request's order. Everything about a CUSIP
lies in its item, so the whole mapping is array work inside the row: no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filinglake.functions import text
from filinglake.operators.checks import Checked

# Fields of a response item.
RESPONSE = """ARRAY<STRUCT<
    data: ARRAY<STRUCT<
        figi: STRING, exchCode: STRING, ticker: STRING, name: STRING, compositeFIGI: STRING,
        shareClassFIGI: STRING, securityType: STRING, securityType2: STRING, marketSector: STRING>>,
    warning: STRING, error: STRING>>"""


def ingest_figi(exchanges: DataFrame) -> Checked:
    """Mappings, one per requested CUSIP, from (request ARRAY<STRING>, response JSON text).

    A response whose length differs from its request's cannot be paired and is a reject.
    """
    c = F.col
    parsed = exchanges.select("request", F.from_json("response", RESPONSE).alias("items"))
    fits = F.coalesce(F.size("items") == F.size("request"), F.lit(False))
    items = (
        parsed.filter(fits)
        .select(F.explode(F.arrays_zip("request", "items")).alias("pair"))
        .select(
            c("pair.request").alias("cusip"),
            F.coalesce("pair.items.data", F.array()).alias("rows"),
        )
    )
    figis = F.filter(F.transform("rows", lambda r: r["shareClassFIGI"]), lambda f: f != "")
    # Most common first, ties by name: the smallest (minus count, figi).
    ranked = F.transform(
        F.array_distinct("figis"),
        lambda figi: F.struct(
            (-F.size(F.filter("figis", lambda other: other == figi))).alias("less"), figi.alias("figi")
        ),
    )
    us = F.get(F.filter("rows", lambda r: r["exchCode"] == "US"), F.lit(0))
    symbols = F.transform("rows", lambda r: F.upper(text.text(r["ticker"])))
    speaker = F.coalesce(c("us"), F.get("rows", F.lit(0)))
    read = items.select("cusip", "rows", figis.alias("figis"), us.alias("us"))
    return Checked(
        "figi mappings",
        read.select(
            "cusip",
            F.when(F.size("rows") > 0, "mapped").otherwise("not_found").alias("outcome"),
            F.array_min(ranked)["figi"].alias("shareClassFigi"),
            F.when(c("us.ticker").isNotNull(), F.upper(text.trimmed(c("us.ticker")))).alias("usTicker"),
            F.array_sort(F.array_distinct(F.filter(symbols, lambda s: s.isNotNull()))).alias("tickers"),
            F.coalesce(speaker["securityType"], speaker["securityType2"]).alias("securityType"),
            speaker["marketSector"].alias("marketSector"),
            speaker["name"].alias("name"),
            F.size("rows").alias("venueRows"),
        ),
        parsed.filter(~fits).select(
            F.array(F.lit("response length")).alias("broken"),
            F.array_join("request", ",").alias("sample"),
        ),
    )
