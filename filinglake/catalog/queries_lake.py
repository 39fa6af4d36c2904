"""The versioned lake and the index-driven refresh: merges by file, versions, views, one pass."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filinglake.catalog.queries_jobs import _MERGE_345, _insider_sides
from filinglake.catalog import oracle_text as o
from filinglake.catalog.registry import register
from filinglake.catalog.views import Tables
from filinglake.operators.keyed import side_by_side
from filinglake.plans import file_merge
from filinglake.plans.pipelines import _landed
from filinglake.session import work_path
from filinglake.sinks import lake, versions
from filinglake.sources import daily_index, submissions
from filinglake.streaming import daily

# Submissions a pass takes; more are listed in every given table, so some are deferred.
LIMIT = 400


def _sides(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    """13F filings, holdings the lake has, and those of a later read, with their order."""
    rows = t.inst_holdings.drop("window")
    existing = rows.filter(F.col("side") == "F").drop("side")
    incoming = rows.filter(F.col("side") == "O").drop("side").withColumn("value", F.col("value") * 2)
    return t.inst_filings.drop("window").withColumn("ord", F.lit(0).cast("long")), existing, incoming


@register(
    "g1_file_merge",
    ["inst_holdings"],
    """WITH sides AS (SELECT accession, "infoTableSk", cusip, CASE side WHEN 'O' THEN value * 2 ELSE value END AS value, side, ord FROM inst_holdings)
       SELECT accession, "infoTableSk", cusip, value FROM sides
       QUALIFY row_number() OVER (PARTITION BY accession, "infoTableSk" ORDER BY side = 'O' DESC, ord DESC) = 1""",
)
def g1_files(t: Tables) -> DataFrame:
    root = work_path(t.spark, "g1-files")
    filings, existing, incoming = _sides(t)
    file_merge.merge_institutional(t.spark, root, filings, existing)
    merged = file_merge.merge_institutional(t.spark, root, filings, incoming)
    return merged.rows("institutional_holdings").select("accession", "infoTableSk", "cusip", "value")


# Every row is in one of the reads: what has no side comes with the later one.
_MERGE_ALL = _MERGE_345.replace("side = 'F' AS old", "side IS NOT DISTINCT FROM 'F' AS old")


@register(
    "g2_file_merge",
    ["insider_filings", "insider_transactions"],
    f"""WITH {_MERGE_ALL}
        SELECT tbl, accession, k, CASE rank WHEN 2 THEN 'sec_acceptance_datetime' ELSE 'sec_dataset_filing_date' END AS source, count(*) AS n
        FROM ranked WHERE old = (accession NOT IN (SELECT accession FROM taken)) GROUP BY ALL""",
)
def g2_files(t: Tables) -> DataFrame:
    root = work_path(t.spark, "g2-files")
    for side in _insider_sides(t, ~F.col("side").eqNullSafe("F")):
        merged = file_merge.merge_insider(t.spark, root, *side)
    rows = lambda name, kind, key: merged.rows(name).select(
        F.lit(kind).alias("tbl"), "accession", key.alias("k"), F.col("availabilitySource").alias("source")
    )
    both = rows("insider_filings", "filing", F.col("ownerCik")).unionByName(
        rows("insider_transactions", "leg", F.concat("rowKind", "rowSk"))
    )
    return both.groupBy("tbl", "accession", "k", "source").agg(F.count(F.lit(1)).alias("n"))


@register(
    "k1_versions",
    ["inst_holdings"],
    """WITH one AS (SELECT year("availableAt") AS y FROM inst_holdings WHERE side = 'F'
                    QUALIFY row_number() OVER (PARTITION BY accession, "infoTableSk" ORDER BY ord DESC) = 1),
            two AS (SELECT year("availableAt") AS y FROM inst_holdings WHERE side IN ('F', 'O')
                    QUALIFY row_number() OVER (PARTITION BY accession, "infoTableSk" ORDER BY side = 'O' DESC, ord DESC) = 1)
       SELECT CAST(1 AS BIGINT) AS version, CAST(y AS BIGINT) AS year, count(*) AS n FROM one GROUP BY 2
       UNION ALL SELECT 2, y, count(*) FROM two GROUP BY 2""",
)
def k1_versions(t: Tables) -> DataFrame:
    """Rows a year of the version a reader holds, and of the one committed after it began."""
    root = work_path(t.spark, "k1-versions")
    filings, existing, incoming = _sides(t)
    held = [file_merge.merge_institutional(t.spark, root, filings, rows) for rows in (existing, incoming)]
    parts = [
        one.rows("institutional_holdings")
        .groupBy(F.col("availableYear").alias("year"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.lit(one.version).cast("long").alias("version"), "year", "n")
        for one in held
    ]
    return parts[0].unionByName(parts[1])


@register(
    "k2_file_views",
    ["insider_filings"],
    """SELECT 'lake' AS dataset, CAST(1 AS BIGINT) AS version, "formType", count(*) AS n FROM insider_filings
       WHERE year("availableAt") = 1998 GROUP BY 3""",
)
def k2_files(t: Tables) -> DataFrame:
    """Views over the files that a version names, while the folder holds others, too."""
    root = work_path(t.spark, "k2-files")
    filings = t.insider_filings.drop("window", "ord", "side")
    stray = versions.add_rows(t.spark, filings, "insider_filings", root)
    named = versions.add_rows(t.spark, filings, "insider_filings", root)
    versions.commit(versions.snapshot(t.spark, root), [named])
    stray.count()  # files that no version names
    versions.publish(t.spark, root, "lake", "insider_filings", [1998], prefix="k2f_")
    return t.spark.sql(
        """SELECT s.dataset, s.version, f.formType, count(*) AS n
           FROM k2f_insider_filings f JOIN k2f_dataset_snapshot s GROUP BY ALL"""
    )


_PENDING = """listed AS (SELECT * FROM index_entries WHERE "formType" IN ('3/A', '4', '5')),
    pending AS (SELECT x.accession, x.day, x.event_id, o_orderkey IS NOT NULL AS landed, o_orderkey % 59 = 0 OR o_orderkey % 87 = 0 AS refused
                FROM listed x LEFT JOIN orders ON x.accession = lpad(CAST(o_orderkey AS VARCHAR), 10, '0')
                WHERE x.accession NOT IN (SELECT lpad(CAST(c_custkey AS VARCHAR), 10, '0') FROM customer))"""


@register(
    "t1_refresh_summary",
    ["index_entries"],
    f"""WITH {_PENDING},
        taken AS (SELECT * FROM pending ORDER BY landed DESC, day, event_id LIMIT {LIMIT})
        SELECT (SELECT count(*) FROM listed) AS listed, count(*) AS processed, (SELECT count(*) FROM pending) - count(*) AS deferred,
               count(CASE WHEN NOT landed THEN 1 END) AS not_landed, count(CASE WHEN landed AND refused THEN 1 END) AS refused,
               count(CASE WHEN landed AND NOT refused THEN 1 END) AS filed
        FROM taken""",
)
def t1_summary(t: Tables) -> DataFrame:
    """What one pass of the refresh does: index text, known accessions and documents to its report."""
    known = t.customer.select(F.lpad(F.col("c_custkey").cast("string"), 10, "0").alias("accession"))
    entries = daily_index.insider_entries(daily_index.read_index(t.index_lines).rows)
    documents = t.submissions.withColumn("accession", submissions.accession_of(F.col("raw")))
    # As a pass does, the index and the accessions of the documents are read once, and what is taken is written.
    entries = _landed(t.spark, entries.select("accession", *daily.LISTED), "entries", [])
    copies = _landed(t.spark, documents.select("accession", F.lit(0).alias("tries")), "copies", [])
    taken, counts = daily.planned(entries, known, copies, LIMIT)
    taken = _landed(t.spark, taken, "taken", [])
    offered = documents.join(taken.select("accession"), "accession", "left_semi").select("archive_key", "raw")
    read = submissions.parse_submissions(_landed(t.spark, offered, "offered", []))
    failures = daily.failed(taken, read.rejects, read.filings)
    return side_by_side(
        counts.select("listed", "deferred"),
        taken.agg(F.count(F.lit(1)).alias("processed")),
        failures.agg(
            F.count_if(F.col("reason") == "not landed").alias("not_landed"),
            F.count_if(F.col("reason") != "not landed").alias("refused"),
        ),
        read.filings.agg(F.count_distinct("accession").alias("filed")),
    )




@register(
    "s11_mixed_files",
    ["insider_filings"],
    f"""WITH r AS (SELECT CAST(year("availableAt") AS BIGINT) AS "availableYear", right(accession, 1) IN ('0', '1', '2', '3') AS legacy, "issuerTicker" AS filed FROM insider_filings)
        SELECT "availableYear", CASE WHEN legacy THEN {o.ticker('filed')} ELSE 'as written' END AS "resolvedTicker", count(*) AS n FROM r GROUP BY 1, 2""",
)
def s11_mixed(t: Tables) -> DataFrame:
    """Each year holds files from before the ticker column and files with it."""
    root = work_path(t.spark, "s11-mixed")
    rows = t.insider_filings
    old = F.right("accession", F.lit(1)).isin("0", "1", "2", "3")
    lake.write_lake(rows.where(~old).withColumn("resolvedTicker", F.lit("as written")), "insider_filings", root)
    before = lake.with_shard(rows.where(old)).drop("resolvedTicker")
    before.write.mode("append").partitionBy(lake.SHARD).parquet(f"{root}/insider_filings")
    read = lake.read_table(t.spark, "insider_filings", root)
    return read.groupBy(F.col(lake.SHARD).cast("long").alias(lake.SHARD), "resolvedTicker").agg(F.count(F.lit(1)).alias("n"))
