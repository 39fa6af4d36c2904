"""Scans and sinks: archives, members, indexes, submissions, links, responses, manifests, the lake."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filinglake import schemas
from filinglake.catalog import oracle_text as o
from filinglake.catalog.registry import register
from filinglake.catalog.views import Tables, pieces
from filinglake.operators import incremental
from filinglake.plans.pipelines import _landed
from filinglake.session import shared_folder
from filinglake.sinks import lake
from filinglake.sources import archives, daily_index, figi, links, manifest, submissions, tsv
from filinglake.streaming import refresh


def _packed(lines: DataFrame) -> DataFrame:
    """One archive per Arrow batch, with the batch's lines in a nested member."""

    def zipped(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for number, batch in enumerate(batches):
            target = io.BytesIO()
            with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as archive:
                body = "\r\n".join(["HEADER", *batch["line"]])
                archive.writestr("some-dir/INFOTABLE.tsv", "\ufeff" + body)
                archive.writestr("some-dir/readme.htm", "not a member")
            yield pd.DataFrame({"path": [f"raw/{number}.zip"], "content": [target.getvalue()]})

    return lines.mapInPandas(zipped, "path STRING, content BINARY")


@register(
    "s1_archive_scan",
    sql="""SELECT 'INFOTABLE.tsv' AS member, lpad(CAST(l_orderkey AS VARCHAR), 10, '0') || chr(9) || l_linenumber || chr(9) || l_partkey || chr(9) || l_suppkey AS line
           FROM lineitem""",
)
def s1(t: Tables) -> DataFrame:
    line = F.concat_ws(
        "\t", F.lpad(F.col("l_orderkey").cast("string"), 10, "0"), "l_linenumber", "l_partkey", "l_suppkey"
    )
    lines = archives.read_archives(_packed(t.lineitem.select(line.alias("line"))), ["INFOTABLE.tsv"], nested=True)
    # Line 0 is each archive's header.
    return lines.filter(F.col("line_no") > 0).select("member", "line")


@register(
    "s2_tsv_scan",
    ["info_lines"],
    """SELECT archive_key, lpad(CAST(l_orderkey AS VARCHAR), 10, '0') AS "ACCESSION_NUMBER", CAST(l_linenumber AS VARCHAR) AS "INFOTABLE_SK",
              lpad(CAST(l_partkey AS VARCHAR), 9, '0') AS "CUSIP",
              CASE WHEN l_linestatus = 'O' THEN 'last' WHEN l_suppkey % 3 = 0 THEN '' ELSE 'note' END AS "NOTE", '' AS "ABSENT"
       FROM (SELECT *, CASE l_linestatus WHEN 'F' THEN 'flat' ELSE 'wide' END AS archive_key FROM lineitem) WHERE l_partkey % 41 <> 0""",
)
def s2(t: Tables) -> DataFrame:
    rows = tsv.records(
        t.info_lines, ["ACCESSION_NUMBER", "INFOTABLE_SK", "CUSIP"], ["NOTE", "ABSENT"], first=F.col("ord.f0") == 0
    )
    return rows.drop("ord")


@register(
    "s3_strict_tsv",
    ["nport_identifier_lines"],
    """SELECT len(string_split(line, chr(9))) <> 4 AS malformed, count(*) AS n,
              count(CASE WHEN len(string_split(line, chr(9))) = 4 AND string_split(line, chr(9))[3] <> '' THEN 1 END) AS tickers
       FROM nport_identifier_lines WHERE line NOT LIKE 'HOLDING_ID%' GROUP BY 1""",
)
def s3(t: Tables) -> DataFrame:
    rows = tsv.strict_records(
        t.nport_identifier_lines, schemas.MEMBERS_NPORT["IDENTIFIERS.tsv"]
    )
    return rows.groupBy("malformed").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("IDENTIFIER_TICKER") != "").alias("tickers")
    )


_ENTRY = f""""formType", "companyName", cik, {o.day('day')} AS "dateFiled", "fileName", accession"""


@register("s4_daily_index", ["index_entries"], f"SELECT {_ENTRY} FROM index_entries")
def s4(t: Tables) -> DataFrame:
    return daily_index.read_index(t.index_lines).rows.drop("archive_key", "ord")


@register("s5_form_filter", ["index_entries"],
          f"""SELECT {_ENTRY} FROM index_entries WHERE "formType" IN ('3', '3/A', '4', '4/A', '5', '5/A')""")
def s5(t: Tables) -> DataFrame:
    return daily_index.insider_entries(daily_index.read_index(t.index_lines).rows).drop("archive_key", "ord")


_GOOD = "o_orderkey % 59 <> 0 AND o_orderkey % 87 <> 0"
# 17:mm:08 New York on the filing day, plus a minute.
_ACCEPTED = o.instant(
    "(((CAST(o_orderdate AS DATE))::TIMESTAMP + INTERVAL 17 HOUR + to_minutes(CAST(o_orderkey % 60 AS INT)) + INTERVAL 8 SECOND)"
    " AT TIME ZONE 'America/New_York') AT TIME ZONE 'UTC' + INTERVAL 1 MINUTE"
)
_SYMBOL = "'T' || chr(65 + CAST(o_orderkey % 97 % 23 AS INT)) || chr(65 + CAST(o_orderkey % 97 % 17 AS INT))"
_FORM = "CASE o_orderpriority WHEN '1-URGENT' THEN '4/A' WHEN '5-LOW' THEN '3' ELSE '4' END"
_FILING = f"""
    SELECT lpad(CAST(o_orderkey AS VARCHAR), 10, '0') AS accession, {_FORM} AS "formType", {o.day('CAST(o_orderdate AS DATE)')} AS "filingDate",
           {_ACCEPTED} AS "availableAt", 'sec_acceptance_datetime' AS "availabilitySource",
           CASE WHEN o_orderkey % 11 <> 0 THEN {o.day("CAST(date_trunc('quarter', o_orderdate) - INTERVAL 1 DAY AS DATE)")} END AS "periodOfReport",
           CAST(NULL AS VARCHAR) AS "dateOfOriginalSubmission", lpad(CAST(o_orderkey % 97 AS VARCHAR), 10, '0') AS "issuerCik",
           'A & B ' || (o_orderkey % 97) AS "issuerName", 'NYSE: ' || {_SYMBOL} AS "issuerTicker", {_SYMBOL} AS "resolvedTicker",
           lpad(CAST(o_custkey + joint AS VARCHAR), 10, '0') AS "ownerCik", CASE joint WHEN 0 THEN 'Owner' ELSE 'Joint' END AS "ownerName",
           joint = 0 AS "isDirector", false AS "isOfficer", false AS "isTenPercentOwner", joint = 0 AND o_orderkey % 2 = 0 AS "isOther",
           CAST(NULL AS VARCHAR) AS "officerTitle", CAST(NULL AS VARCHAR) AS "ownerRelationshipText", CAST(NULL AS BOOLEAN) AS aff10b5One,
           'raw/' || lpad(CAST(o_orderkey AS VARCHAR), 10, '0') || '.txt' AS "rawArchiveKey"
    FROM (SELECT *, 0 AS joint FROM orders UNION ALL SELECT *, 1 AS joint FROM orders WHERE o_orderkey % 5 = 0) WHERE {_GOOD}"""


@register("s6_submission_scan", sql=_FILING)
def s6(t: Tables) -> DataFrame:
    return submissions.parse_submissions(t.submissions).filings


@register(
    "s6_submission_legs",
    sql=f"""SELECT lpad(CAST(o_orderkey AS VARCHAR), 10, '0') AS accession, kind AS "rowKind", '1' AS "rowSk", {_FORM} AS "formType", {_ACCEPTED} AS "availableAt",
                   CASE kind WHEN 'deriv' THEN 'Option' ELSE 'Common' END AS "securityTitle",
                   CASE kind WHEN 'nonderiv' THEN {o.day('CAST(o_orderdate AS DATE)')} END AS "transactionDate",
                   CASE kind WHEN 'nonderiv' THEN 'P' END AS "transactionCode", CASE kind WHEN 'nonderiv' THEN false END AS "equitySwapInvolved",
                   CASE kind WHEN 'nonderiv' THEN CAST(o_custkey AS DOUBLE) END AS shares, CAST(NULL AS DOUBLE) AS "pricePerShare",
                   CASE kind WHEN 'deriv' THEN CAST(1.5 AS DOUBLE) END AS "exercisePrice"
            FROM (SELECT *, 'nonderiv' AS kind FROM orders UNION ALL SELECT *, 'deriv' FROM orders WHERE o_orderkey % 3 = 0) WHERE {_GOOD}""",
)
def s6_legs(t: Tables) -> DataFrame:
    return submissions.parse_submissions(t.submissions).transactions.select(
        "accession", "rowKind", "rowSk", "formType", "availableAt", "securityTitle", "transactionDate",
        "transactionCode", "equitySwapInvolved", "shares", "pricePerShare", "exercisePrice",
    )


@register(
    "s7_discover_windows",
    sql="SELECT DISTINCT (2013 + page_id % 12) || 'q' || (1 + page_id % 4) || '_form13f' AS stem FROM pages",
)
def s7(t: Tables) -> DataFrame:
    return links.discover_windows(t.landing)


@register(
    "s7_fund_quarters",
    sql="""SELECT CAST(2019 + page_id % 6 AS BIGINT) AS year, CAST(1 + page_id % 5 AS BIGINT) AS quarter,
                  CASE WHEN max(page_id) % 2 = 0 THEN 'https://example.org' ELSE 'https://www.sec.gov' END || '/files/' || (2019 + page_id % 6) || 'q' || (1 + page_id % 5) || '_nport.zip' AS url
           FROM pages WHERE page_id % 5 < 4 GROUP BY page_id % 6, page_id % 5""",
)
def s7_fund(t: Tables) -> DataFrame:
    return links.discover_fund_quarters(t.landing, "page_id")


@register(
    "s8_figi_ingest",
    ["exchanges"],
    """SELECT lpad(CAST(p_partkey AS VARCHAR), 9, '0') AS cusip, 'mapped' AS outcome,
              least('S' || p_size, 'S' || (p_size + p_partkey % 2)) AS "shareClassFigi",
              CASE WHEN p_partkey % 2 = 0 THEN upper(p_type) END AS "usTicker",
              least(upper(substr(p_name, 1, 3)) || 'EUR', upper(p_type)) || ',' || greatest(upper(substr(p_name, 1, 3)) || 'EUR', upper(p_type)) AS tickers,
              p_type AS "securityType", CASE WHEN p_partkey % 2 = 0 THEN 'Equity' END AS "marketSector",
              CASE WHEN p_partkey % 2 = 0 THEN p_brand ELSE p_name END AS name, 2 AS "venueRows" FROM part
       UNION ALL
       SELECT 'N' || lpad(CAST(p_partkey AS VARCHAR), 8, '0'), 'not_found', NULL, NULL, '', NULL, NULL, NULL, 0 FROM part""",
)
def s8(t: Tables) -> DataFrame:
    requested = t.exchanges.select(F.array("cusip_a", "cusip_b").alias("request"), "response")
    return figi.ingest_figi(requested).rows


@register(
    "s9_manifest",
    sql="""SELECT 'row' AS outcome, CASE WHEN o_orderstatus = 'F' THEN 'insider_filings' ELSE 'institutional_holdings' END AS detail,
                  CAST(year(o_orderdate) AS BIGINT) AS year, count(*) AS n, CAST(sum(o_custkey) AS BIGINT) AS size
           FROM orders WHERE o_orderkey % 13 <> 0 AND o_orderkey % 19 <> 0 AND o_orderkey % 23 <> 0 AND o_orderkey % 21 <> 0 GROUP BY ALL
           UNION ALL
           SELECT 'reject', concat_ws(',', CASE WHEN o_orderkey % 13 = 0 OR o_orderkey % 19 = 0 THEN 'publicPath' END, CASE WHEN o_orderkey % 23 = 0 THEN 'size' END,
                  CASE WHEN o_orderkey % 21 = 0 THEN 'sha256' END), NULL, count(*), NULL
           FROM orders WHERE o_orderkey % 13 = 0 OR o_orderkey % 19 = 0 OR o_orderkey % 23 = 0 OR o_orderkey % 21 = 0 GROUP BY ALL""",
)
def s9(t: Tables) -> DataFrame:
    read = manifest.read_manifest(t.manifests)
    rows = read.rows.groupBy(F.lit("row").alias("outcome"), F.col("table").alias("detail"), "year").agg(
        F.count(F.lit(1)).alias("n"), F.sum("size").alias("size")
    )
    rejects = read.rejects.groupBy(F.array_join("broken", ",").alias("detail")).agg(F.count(F.lit(1)).alias("n"))
    return rows.unionByName(
        rejects.select(
            F.lit("reject").alias("outcome"), "detail", F.lit(None).cast("int").alias("year"), "n",
            F.lit(None).cast("long").alias("size"),
        )
    )


@register(
    "s11_lake_read",
    ["insider_transactions"],
    """SELECT 'row' AS outcome, "rowKind" AS detail, count(*) AS n FROM insider_transactions WHERE "issuerTicker" IS NOT NULL AND "transactionCode" IS NOT NULL GROUP BY 2
       UNION ALL SELECT 'reject', concat_ws(',', CASE WHEN "issuerTicker" IS NULL THEN 'securityTitle' END, CASE WHEN "transactionCode" IS NULL THEN 'rowKind unknown' END), count(*)
       FROM insider_transactions WHERE "issuerTicker" IS NULL OR "transactionCode" IS NULL GROUP BY 2""",
)
def s11(t: Tables) -> DataFrame:
    # A drifted shard: a required column with nulls, and row kinds nobody declared.
    drifted = t.insider_transactions.withColumn(
        "securityTitle", F.when(F.col("issuerTicker").isNotNull(), F.col("securityTitle"))
    ).withColumn("rowKind", F.when(F.col("transactionCode").isNotNull(), F.col("rowKind")).otherwise("other"))
    checked = lake.check_table(drifted, "insider_transactions")
    rows = checked.rows.groupBy(F.lit("row").alias("outcome"), F.col("rowKind").alias("detail"))
    bad = checked.rejects.groupBy(F.lit("reject").alias("outcome"), F.array_join("broken", ",").alias("detail"))
    return rows.agg(F.count(F.lit(1)).alias("n")).unionByName(bad.agg(F.count(F.lit(1)).alias("n")))


def _lake_root(t: Tables, name: str) -> str:
    """One folder per query and application, so a repeated run replaces its own output."""
    application = t.spark.sparkContext.applicationId
    return f"{shared_folder(t.spark)}/filinglake/{application}/{name}"


@register(
    "k1_year_buckets",
    ["inst_holdings"],
    f"""SELECT CAST(year("availableAt") AS BIGINT) AS "availableYear", count(*) AS n, count(DISTINCT cusip) AS cusips,
               {o.instant('min("availableAt")')} AS first, {o.instant('max("availableAt")')} AS last FROM inst_holdings GROUP BY 1""",
)
def k1(t: Tables) -> DataFrame:
    root = _lake_root(t, "k1")
    lake.write_lake(t.inst_holdings, "institutional_holdings", root)
    rows = lake.read_table(t.spark, "institutional_holdings", root)
    per_cusip = rows.groupBy("availableYear", "cusip").agg(
        F.count(F.lit(1)).alias("n"), F.min("availableAt").alias("first"), F.max("availableAt").alias("last")
    )
    return per_cusip.groupBy("availableYear").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("cusips"), F.min("first").alias("first"), F.max("last").alias("last")
    )


@register(
    "k2_publish",
    ["insider_filings"],
    """SELECT 'lake' AS dataset, CAST(1 AS BIGINT) AS schema_version, "formType", count(*) AS n FROM insider_filings
       WHERE year("availableAt") = 1998 GROUP BY 3""",
)
def k2(t: Tables) -> DataFrame:
    root = _lake_root(t, "k2")
    lake.write_lake(t.insider_filings, "insider_filings", root)
    lake.publish_views(t.spark, root, ("lake", "2026-01-01T00:00:00Z", 1), "insider_filings", 1998, prefix="k2_")
    return t.spark.sql(
        """SELECT (SELECT dataset FROM k2_dataset_snapshot) AS dataset,
                  (SELECT schema_version FROM k2_dataset_snapshot) AS schema_version, formType, count(*) AS n
           FROM k2_insider_filings GROUP BY formType"""
    )


_LISTED = """listed AS (SELECT * FROM index_entries WHERE "formType" IN ('3/A', '4', '5'))"""


@register(
    "t1_daily_refresh",
    ["index_entries"],
    f"""WITH {_LISTED}
        SELECT x.accession, x."formType" AS listed, x.cik, f."ownerCik", f."availableAt", f."resolvedTicker" FROM listed x
        JOIN ({_FILING}) f ON x.accession = f.accession
        WHERE x.accession NOT IN (SELECT lpad(CAST(c_custkey AS VARCHAR), 10, '0') FROM customer)""",
)
def t1(t: Tables) -> DataFrame:
    """Index text to rows: insider forms, once per accession, not known yet, then their documents."""
    known = t.customer.select(F.lpad(F.col("c_custkey").cast("string"), 10, "0").alias("accession"))
    entries = daily_index.read_index(t.index_lines).rows.select("accession", "ord", "formType", "cik")
    taken = refresh.pending_entries(entries, known, "ord").select("accession", F.col("formType").alias("listed"), "cik")
    # The index is read once, and the text of a document made only where an entry asks for it: whole texts are not shuffled.
    pending = _landed(t.spark, taken, "pending", [])
    landed = t.orders.withColumn("accession", F.lpad(F.col("o_orderkey").cast("string"), 10, "0"))
    offered = landed.repartition(pieces(t.orders), "accession").join(pending.select("accession"), "accession", "left_semi")
    rows = submissions.parse_submissions(t.over("submissions", orders=offered)).filings
    return rows.join(pending, "accession").select("accession", "listed", "cik", "ownerCik", "availableAt", "resolvedTicker")
