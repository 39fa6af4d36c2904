"""Audits: window integrity, rollups, lags, boundaries, coverage, verification."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filinglake.catalog import oracle_text as o
from filinglake.catalog.registry import register
from filinglake.catalog.views import Tables
from filinglake.operators import integrity
from filinglake.plans import audit, reports
from filinglake.session import work_path
from filinglake.sources import manifest

_LAG = 'date_diff(\'day\', "periodOfReport", "filingDate")'


def _inventory(code: str) -> str:
    return f"string_agg({code} || '=' || n, ';' ORDER BY {code})"


_HOLDINGS_AUDIT = f"""
    kept AS (SELECT h.* FROM inst_holdings h SEMI JOIN inst_filings f ON h.accession = f.accession AND h."window" = f."window"),
    repeats AS (SELECT "window", accession || '/' || "infoTableSk" AS k, ord FROM kept
                QUALIFY row_number() OVER (PARTITION BY "window", accession, "infoTableSk" ORDER BY ord) > 1),
    sampled AS (SELECT * FROM repeats QUALIFY row_number() OVER (PARTITION BY "window" ORDER BY ord) <= 20),
    dup AS (SELECT "window", string_agg(k, ',' ORDER BY ord) AS keys FROM sampled GROUP BY 1),
    pc AS (SELECT "window", {_inventory('c')} AS inv FROM (SELECT "window", coalesce("putCall", 'NULL') AS c, count(*) AS n FROM kept GROUP BY 1, 2) GROUP BY 1),
    ty AS (SELECT "window", {_inventory('c')} AS inv FROM (SELECT "window", "submissionType" AS c, count(*) AS n FROM inst_filings GROUP BY 1, 2) GROUP BY 1),
    tot AS (SELECT "window", count(*) AS holdings FROM inst_holdings GROUP BY 1),
    cnt AS (SELECT "window", count(*) AS kept, count(DISTINCT cusip) AS cusips, count_if("issuerName" IS NULL) AS no_issuer,
                   count_if(coalesce(value, 0) = 0 AND coalesce("sharesAmount", 0) = 0) AS zero, count_if(cusip = '000000000') AS placeholder, count(figi) AS figi
            FROM kept GROUP BY 1),
    fil AS (SELECT "window", count(*) AS filings, count_if("managerName" IS NULL) AS no_manager,
                   {o.floor_quantile(_LAG, 0.5)} AS p50, {o.floor_quantile(_LAG, 0.95)} AS p95, max({_LAG}) AS most
            FROM inst_filings WHERE "periodOfReport" IS NOT NULL GROUP BY 1),
    fal AS (SELECT "window", count(*) AS filings, count_if("managerName" IS NULL) AS no_manager FROM inst_filings GROUP BY 1),
    nt AS (SELECT "window", count(*) AS n FROM inst_filings f WHERE "submissionType" LIKE '13F-NT%'
           AND EXISTS (SELECT 1 FROM inst_holdings h WHERE h.accession = f.accession AND h."window" = f."window") GROUP BY 1),
    report AS (
        SELECT fal."window", fal.filings, tot.holdings, cnt.cusips AS "distinctCusips", tot.holdings - cnt.kept AS "orphanHoldings",
               coalesce(nt.n, 0) AS "noticeFilingsWithHoldings", fal.no_manager AS "nullManagerFilings", cnt.no_issuer AS "nullIssuerHoldings",
               cnt.zero AS "zeroPositionHoldings", cnt.placeholder AS "placeholderCusips", cnt.figi AS "figiCoverage",
               coalesce(dup.keys, '') AS "duplicateHoldingKeys", ty.inv AS "submissionTypes", pc.inv AS "putCall",
               fil.p50 AS lag_p50, fil.p95 AS lag_p95, fil.most AS lag_max
        FROM fal JOIN tot ON fal."window" = tot."window" JOIN cnt ON fal."window" = cnt."window" JOIN fil ON fal."window" = fil."window"
        LEFT JOIN dup ON fal."window" = dup."window" LEFT JOIN ty ON fal."window" = ty."window"
        LEFT JOIN pc ON fal."window" = pc."window" LEFT JOIN nt ON fal."window" = nt."window")
"""


def _holdings_report(t: Tables) -> DataFrame:
    return integrity.holdings_integrity(t.inst_filings, t.inst_holdings, "ord")


@register("a7_holdings_integrity", ["inst_filings", "inst_holdings"], f"WITH {_HOLDINGS_AUDIT} SELECT * FROM report")
def a7(t: Tables) -> DataFrame:
    return _holdings_report(t)


_INSIDER_AUDIT = f"""
    firsts AS (SELECT "window", accession, "filingDate" AS day FROM insider_filings QUALIFY row_number() OVER (PARTITION BY "window", accession ORDER BY ord) = 1),
    keys AS (SELECT "window", accession, count(*) AS n, count(DISTINCT "ownerCik") AS owners, min(ord) AS ord FROM insider_filings GROUP BY 1, 2),
    sampled AS (SELECT "window", accession || ' x' || (n - owners + 1) AS k, ord FROM keys WHERE owners < n
                QUALIFY row_number() OVER (PARTITION BY "window" ORDER BY ord) <= 20),
    dup AS (SELECT "window", string_agg(k, ',' ORDER BY ord) AS keys FROM sampled GROUP BY 1),
    fil AS (SELECT "window", count(*) AS filings, count(DISTINCT accession) AS accessions,
                   count_if("formType" LIKE '%/A' AND "dateOfOriginalSubmission" IS NULL) AS undated, min("filingDate") AS lo, max("filingDate") AS hi
            FROM insider_filings GROUP BY 1),
    legs AS (SELECT t.*, f.day FROM insider_transactions t LEFT JOIN firsts f ON t.accession = f.accession AND t."window" = f."window"),
    cnt AS (SELECT "window", count(*) AS transactions, count_if(day IS NULL) AS orphan, count_if(day IS NOT NULL AND "transactionDate" > day) AS future,
                   count_if(day IS NOT NULL AND "issuerTicker" IS NULL) AS no_ticker, count_if(day IS NOT NULL AND shares IS NULL) AS no_shares,
                   count_if(day IS NOT NULL AND (coalesce(shares, 0) < 0 OR coalesce("pricePerShare", 0) < 0)) AS negative
            FROM legs GROUP BY 1),
    code AS (SELECT "window", {_inventory('c')} AS inv FROM (SELECT "window", coalesce("transactionCode", 'NULL') AS c, count(*) AS n FROM legs WHERE day IS NOT NULL GROUP BY 1, 2) GROUP BY 1),
    report AS (
        SELECT fil."window", filings, accessions, transactions, orphan AS "orphanTransactions", future AS "futureDatedTransactions", no_ticker AS "nullTickerTransactions",
               no_shares AS "nullSharesTransactions", negative AS "negativeAmounts", undated AS "amendmentsWithoutOriginalDate",
               coalesce(dup.keys, '') AS "duplicateFilingKeys", code.inv AS "transactionCodes", {o.day('lo')} AS "minFilingDate", {o.day('hi')} AS "maxFilingDate"
        FROM fil JOIN cnt ON fil."window" = cnt."window" JOIN code ON fil."window" = code."window" LEFT JOIN dup ON fil."window" = dup."window")
"""


def _insider_report(t: Tables) -> DataFrame:
    return integrity.insider_integrity(t.insider_filings, t.insider_transactions, "ord")


@register("a8_insider_integrity", ["insider_filings", "insider_transactions"], f"WITH {_INSIDER_AUDIT} SELECT * FROM report")
def a8(t: Tables) -> DataFrame:
    return _insider_report(t)


@register(
    "a9_filing_lags",
    ["inst_filings"],
    f"""SELECT CASE WHEN "submissionType" LIKE '%/A' THEN 'amendment' ELSE 'original' END AS kind, count(*) AS n,
               {o.floor_quantile(_LAG, 0.5)} AS p50, {o.floor_quantile(_LAG, 0.95)} AS p95, max({_LAG}) AS max
        FROM inst_filings WHERE "periodOfReport" IS NOT NULL GROUP BY 1""",
)
def a9(t: Tables) -> DataFrame:
    return integrity.filing_lags(t.inst_filings)


@register(
    "a9_lag_report",
    sql=f"""WITH f AS (SELECT CASE o_orderstatus WHEN 'O' THEN 'amendment' ELSE 'original' END AS kind,
                          date_diff('day', CAST(date_trunc('quarter', o_orderdate) - INTERVAL 1 DAY AS DATE), CAST(o_orderdate AS DATE)) AS lag
                   FROM orders WHERE o_orderkey % 11 <> 0)
        SELECT (SELECT count(DISTINCT ((o_orderkey % 12), (o_orderkey % 4))) FROM orders) AS windows, (SELECT count(*) FROM f) AS filings,
               kind, count(*) AS n, {o.floor_quantile('lag', 0.5)} AS p50, {o.floor_quantile('lag', 0.95)} AS p95, max(lag) AS max FROM f GROUP BY kind""",
)
def a9_report(t: Tables) -> DataFrame:
    """The report of raw submission records, a row per kind."""
    archives = t.raw_sub13f.select("archive_key").distinct()
    found = reports.lag_totals(reports.submission_dates(t.raw_sub13f).rows, archives)
    kinds = F.inline(F.array(*[F.struct(F.lit(kind).alias("kind"), *[F.col(f"{kind}.{x}").alias(x) for x in ("n", "p50", "p95", "max")]) for kind in ("original", "amendment")]))
    return found.select("windows", "filings", kinds)


_HOLDINGS_COUNTERS = [
    "filings", "holdings", "orphanHoldings", "noticeFilingsWithHoldings", "nullManagerFilings",
    "nullIssuerHoldings", "zeroPositionHoldings", "placeholderCusips", "figiCoverage",
]
_INSIDER_COUNTERS = [
    "filings", "transactions", "orphanTransactions", "futureDatedTransactions", "nullTickerTransactions",
    "nullSharesTransactions", "negativeAmounts", "amendmentsWithoutOriginalDate",
]


def _audited(t: Tables, dataset: str, filings: DataFrame, rows: DataFrame) -> DataFrame:
    """All windows put into a state of their own, and the rollup of that state."""
    state = audit.AuditState(t.spark, work_path(t.spark, "audit-state"), dataset)
    names = filings.select("window", F.col("window").alias("key")).distinct()
    state.put(names, filings, rows)
    return state.rollup()


@register(
    "a11_rollup",
    ["inst_filings", "inst_holdings"],
    f"""WITH {_HOLDINGS_AUDIT},
        spread AS (SELECT accession, count(DISTINCT "window") AS n FROM inst_filings GROUP BY 1),
        top AS (SELECT * FROM sampled ORDER BY "window", ord LIMIT 20)
        SELECT count(*) AS windows, {', '.join(f'CAST(sum("{c}") AS BIGINT) AS "{c}"' for c in _HOLDINGS_COUNTERS)},
               (SELECT {_inventory('c')} FROM (SELECT coalesce("putCall", 'NULL') AS c, count(*) AS n FROM kept GROUP BY 1)) AS "putCall",
               (SELECT {_inventory('c')} FROM (SELECT "submissionType" AS c, count(*) AS n FROM inst_filings GROUP BY 1)) AS "submissionTypes",
               (SELECT string_agg(k, ',' ORDER BY "window", ord) FROM top) AS "duplicateHoldingKeys",
               (SELECT count(*) FROM spread) AS "distinctAccessions", (SELECT count_if(n > 1) FROM spread) AS "multiWindowAccessions"
        FROM report""",
)
def a11(t: Tables) -> DataFrame:
    return _audited(t, "form13f", t.inst_filings, t.inst_holdings)


@register(
    "a11_insider_rollup",
    ["insider_filings", "insider_transactions"],
    f"""WITH {_INSIDER_AUDIT},
        top AS (SELECT * FROM sampled ORDER BY "window", ord LIMIT 20),
        lapping AS (SELECT "window", "minFilingDate" AS lo, lag("window") OVER w AS previous, lag("maxFilingDate") OVER w AS before
                    FROM report WINDOW w AS (ORDER BY "minFilingDate" NULLS FIRST, "window"))
        SELECT count(*) AS windows, {', '.join(f'CAST(sum("{c}") AS BIGINT) AS "{c}"' for c in _INSIDER_COUNTERS)},
               (SELECT {_inventory('c')} FROM (SELECT coalesce("transactionCode", 'NULL') AS c, count(*) AS n FROM legs WHERE day IS NOT NULL GROUP BY 1)) AS "transactionCodes",
               (SELECT coalesce(string_agg(k, ',' ORDER BY "window", ord), '') FROM top) AS "duplicateFilingKeys",
               (SELECT coalesce(string_agg(previous || '[' || before || '] x ' || "window" || '[' || lo || ']', ',' ORDER BY lo, "window"), '')
                FROM lapping WHERE lo <= before) AS "boundaryOverlaps"
        FROM report""",
)
def a11_insider(t: Tables) -> DataFrame:
    return _audited(t, "form345", t.insider_filings, t.insider_transactions)


@register(
    "w4_boundary_overlap",
    ["insider_filings"],
    f"""WITH w AS (SELECT "window", min("filingDate") AS lo, max("filingDate") AS hi FROM insider_filings GROUP BY 1),
             p AS (SELECT *, lag("window") OVER (ORDER BY lo NULLS FIRST, "window") AS previous, lag(hi) OVER (ORDER BY lo NULLS FIRST, "window") AS before FROM w)
        SELECT previous, {o.day('before')} AS "previousMax", "window", {o.day('lo')} AS "minFilingDate" FROM p WHERE lo <= before""",
)
def w4(t: Tables) -> DataFrame:
    ranges = t.insider_filings.groupBy("window").agg(
        F.min("filingDate").alias("minFilingDate"), F.max("filingDate").alias("maxFilingDate")
    )
    return integrity.boundary_overlaps(ranges)


@register(
    "j12_coverage",
    ["inst_filings", "labels_done"],
    """WITH raw AS (SELECT DISTINCT string_split("rawArchiveKey", '/')[4] AS label FROM inst_filings),
            done AS (SELECT DISTINCT substr(identity, 9) AS label FROM labels_done)
       SELECT label, 'missing_raw' AS status FROM done WHERE label NOT IN (SELECT label FROM raw)
       UNION ALL SELECT label, 'unreceipted' FROM raw WHERE label NOT IN (SELECT label FROM done)""",
)
def j12(t: Tables) -> DataFrame:
    objects = t.inst_filings.select(F.col("rawArchiveKey").alias("key"))
    return integrity.coverage(objects, t.labels_done, "form13f", "raw/sec13f/datasets")


@register(
    "j12_gate",
    ["inst_filings", "labels_done"],
    """WITH raw AS (SELECT DISTINCT string_split("rawArchiveKey", '/')[4] AS label FROM inst_filings),
            done AS (SELECT DISTINCT substr(identity, 9) AS label FROM labels_done),
            missing AS (SELECT label FROM done WHERE label NOT IN (SELECT label FROM raw)),
            unreceipted AS (SELECT label FROM raw WHERE label NOT IN (SELECT label FROM done))
       SELECT (SELECT count(*) FROM missing) = 0 AS passes, (SELECT count(*) FROM missing) AS missing,
              (SELECT coalesce(string_agg(label, ',' ORDER BY label), '') FROM (SELECT label FROM missing ORDER BY label LIMIT 3)) AS sample,
              (SELECT coalesce(string_agg('form13f:' || label, ',' ORDER BY label), '') FROM unreceipted) AS unreceipted""",
)
def j12_gate(t: Tables) -> DataFrame:
    objects = t.inst_filings.select(F.col("rawArchiveKey").alias("key"))
    found = integrity.coverage(objects, t.labels_done, "form13f", "raw/sec13f/datasets")
    return integrity.gate_verdict(found, "form13f")


@register(
    "j13_digest_check",
    sql="""SELECT CASE WHEN page_id % 11 = 0 THEN 'missing' WHEN page_id % 7 = 0 THEN 'different' ELSE 'ok' END AS status,
                  count(*) AS files, CAST(sum(strlen(html)) AS BIGINT) AS bytes FROM pages GROUP BY 1""",
)
def j13(t: Tables) -> DataFrame:
    path = F.concat(F.lit("data/"), F.col("page_id").cast("string"))
    listed = t.pages.select(
        path.alias("publicPath"),
        F.octet_length("html").cast("long").alias("size"),
        F.sha2(F.when(F.col("page_id") % 7 == 0, F.concat("html", F.lit(" "))).otherwise(F.col("html")), 256).alias("sha256"),
    )
    # What lies there: every page but those with a number in elevens, whose file never arrived.
    there = t.pages.select(
        F.when(F.col("page_id") % 11 == 0, F.concat(path, F.lit(".partial"))).otherwise(path).alias("path"),
        F.col("html").alias("content"),
    )
    return manifest.verification_totals(manifest.verify_files(listed, there))
