"""Archive links on landing pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Shapes of the links.
WINDOW_LINK = r'href="[^"]*/([A-Za-z0-9_-]+_form13f)\.zip"'
ANCHOR = r"""<a\s[^>]*?href\s*=\s*["']([^"']*_nport\.zip)["']"""
SITE = "https://www.sec.gov"


def discover_windows(pages: DataFrame, html: str = "html", pattern: str = WINDOW_LINK) -> DataFrame:
    """Distinct stems of the linked archives, sorted. Links of one page are reduced per task."""
    stems = pages.select(
        F.explode(F.array_distinct(F.regexp_extract_all(html, F.lit(pattern), 1))).alias("stem")
    )
    return stems.filter(F.instr("stem", "..") == 0).distinct().orderBy("stem")


def discover_fund_quarters(pages: DataFrame, order: str, html: str = "html") -> DataFrame:
    """(year, quarter, url) of the fund-holdings archives; the last link to a file counts."""
    c = F.col
    links = pages.select(
        c(order).alias("_page"), F.posexplode(F.regexp_extract_all(html, F.lit(ANCHOR), 1)).alias("_pos", "href")
    )
    named = links.withColumn("file", F.substring_index("href", "/", -1)).select(
        "file",
        "href",
        F.struct("_page", "_pos").alias("_ord"),
        F.substring("file", 1, 4).try_cast("int").alias("year"),
        F.substring("file", 6, 1).try_cast("int").alias("quarter"),
    )
    last = (
        named.filter(c("year").isNotNull() & c("quarter").between(1, 4))
        .groupBy("file", "year", "quarter")
        .agg(F.max_by("href", "_ord").alias("href"))
    )
    url = F.when(c("href").startswith("http"), c("href")).otherwise(F.concat(F.lit(SITE), c("href")))
    return last.select("year", "quarter", url.alias("url")).orderBy("year", "quarter", "url")
