"""Normalisation, joins, units, spans, crosswalk, merges, incremental work, analyses."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filinglake import schemas
from filinglake.catalog import oracle_text as o
from filinglake.catalog.registry import register
from filinglake.catalog.views import Tables
from filinglake.operators import availability, crosswalk, figi, incremental, keyed, merge, normalize, spans, units
from filinglake.plans import analytics
from filinglake.sinks import lake
from filinglake.sources import tsv

# The given tables end in 2001, so the unit change is placed inside them.
UNIT_RULE = replace(units.RULE, dollars_from="1998-01-01")
AS_OF = "1999-06-30"

# ---- normalisation and its joins ---------------------------------------------------------


@register(
    "p1_13f_filings",
    sql=f"""
        SELECT lpad(CAST(o_orderkey AS VARCHAR), 10, '0') AS accession, {o.day('CAST(o_orderdate AS DATE)')} AS "filingDate",
               {o.eod('CAST(o_orderdate AS DATE)')} AS "availableAt", 'sec_13f_quarterly_dataset' AS "availabilitySource",
               CASE o_orderstatus WHEN 'F' THEN '13F-HR' WHEN 'O' THEN '13F-HR/A' ELSE '13F-NT' END AS "submissionType",
               lpad(CAST(o_custkey AS VARCHAR), 10, '0') AS cik,
               CASE WHEN o_orderkey % 17 <> 0 THEN 'Manager 0 of ' || o_custkey WHEN o_orderkey % 7 = 0 THEN 'Manager 1 of ' || o_custkey END AS "managerName",
               CASE WHEN o_orderkey % 11 <> 0 THEN {o.day("CAST(date_trunc('quarter', o_orderdate) - INTERVAL 1 DAY AS DATE)")} END AS "periodOfReport",
               CASE WHEN o_orderkey % 17 <> 0 OR o_orderkey % 7 = 0 THEN upper(strftime(o_orderdate, '%d-%b-%Y')) END AS "reportCalendarOrQuarter",
               CASE WHEN o_orderkey % 17 <> 0 OR o_orderkey % 7 = 0 THEN CASE o_orderkey % 3 WHEN 0 THEN true WHEN 1 THEN false END END AS "isAmendment",
               CASE WHEN (o_orderkey % 17 <> 0 OR o_orderkey % 7 = 0) AND o_orderstatus = 'O' THEN CAST(o_orderkey % 4 AS VARCHAR) END AS "amendmentNo",
               CAST(NULL AS VARCHAR) AS "amendmentType", CAST(NULL AS VARCHAR) AS "dateReported",
               'raw/sec13f/datasets/' || (2013 + o_orderkey % 12) || 'q' || (1 + o_orderkey % 4) || '/' || repeat('a', 64) || '.zip' AS "rawArchiveKey"
        FROM orders""",
)
def p1(t: Tables) -> DataFrame:
    return normalize.filings_13f(t.raw_sub13f, t.raw_cover).rows


@register(
    "p2_13f_holdings",
    sql=f"""
        SELECT lpad(CAST(l_orderkey AS VARCHAR), 10, '0') AS accession, CAST(l_linenumber AS VARCHAR) AS "infoTableSk",
               {o.eod('CAST(o_orderdate AS DATE)')} AS "availableAt", 'sec_13f_quarterly_dataset' AS "availabilitySource",
               'Issuer ' || l_partkey AS "issuerName", 'COM' AS "titleOfClass", lpad(CAST(l_partkey AS VARCHAR), 9, '0') || 'A' AS cusip,
               CAST(NULL AS VARCHAR) AS figi, floor(l_extendedprice) AS value, CAST(CAST(l_quantity AS INT) AS DOUBLE) AS "sharesAmount",
               'SH' AS "sharesType", CASE WHEN l_discount >= 0.1::DOUBLE THEN 'Put' END AS "putCall", 'SOLE' AS discretion,
               CAST(NULL AS VARCHAR) AS "otherManager", CAST(CAST(l_quantity AS INT) AS DOUBLE) AS "votingSole", CAST(0 AS DOUBLE) AS "votingShared",
               CAST(NULL AS DOUBLE) AS "votingNone", CAST(NULL AS VARCHAR) AS "resolvedTicker", CAST(NULL AS VARCHAR) AS "valueUnitSource",
               'raw/sec13f/datasets/' || (2013 + l_orderkey % 12) || 'q' || (1 + l_orderkey % 4) || '/' || repeat('a', 64) || '.zip' AS "rawArchiveKey"
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def p2(t: Tables) -> DataFrame:
    return normalize.holdings_13f(t.raw_info, t.raw_sub13f).rows


_FACTS_345 = """
    facts AS (SELECT * FROM raw_sub345 QUALIFY row_number() OVER (PARTITION BY "ACCESSION_NUMBER" ORDER BY ord DESC) = 1)
"""
_ISO = "CAST(strptime({0}, '%d-%b-%Y') AS DATE)"


@register(
    "p3_insider_filings",
    ["raw_sub345", "raw_owner"],
    f"""WITH {_FACTS_345}
        SELECT w."ACCESSION_NUMBER" AS accession, f."DOCUMENT_TYPE" AS "formType", {o.day(_ISO.format('f."FILING_DATE"'))} AS "filingDate",
               {o.eod(_ISO.format('f."FILING_DATE"'))} AS "availableAt", 'sec_dataset_filing_date' AS "availabilitySource",
               CASE WHEN f."PERIOD_OF_REPORT" <> '' THEN {o.day(_ISO.format('''nullif(f."PERIOD_OF_REPORT", '')'''))} END AS "periodOfReport",
               CAST(NULL AS VARCHAR) AS "dateOfOriginalSubmission", f."ISSUERCIK" AS "issuerCik", f."ISSUERNAME" AS "issuerName",
               trim(f."ISSUERTRADINGSYMBOL") AS "issuerTicker", {o.ticker('f."ISSUERTRADINGSYMBOL"')} AS "resolvedTicker",
               w."RPTOWNERCIK" AS "ownerCik", w."RPTOWNERNAME" AS "ownerName",
               w."RPTOWNER_RELATIONSHIP" LIKE '%Director%' AS "isDirector", w."RPTOWNER_RELATIONSHIP" ILIKE '%officer%' AS "isOfficer",
               w."RPTOWNER_RELATIONSHIP" LIKE '%Ten%' AS "isTenPercentOwner", w."RPTOWNER_RELATIONSHIP" LIKE '%other%' AS "isOther",
               nullif(trim(w."RPTOWNER_TITLE"), '') AS "officerTitle", CAST(NULL AS VARCHAR) AS "ownerRelationshipText",
               CASE lower(f."AFF10B5ONE") WHEN '1' THEN true WHEN 'false' THEN false END AS aff10b5One, w.archive_key AS "rawArchiveKey"
        FROM raw_owner w JOIN facts f ON w."ACCESSION_NUMBER" = f."ACCESSION_NUMBER" """,
)
def p3(t: Tables) -> DataFrame:
    return normalize.filings_insider(t.raw_sub345, t.raw_owner).rows


def _leg_members(t: Tables) -> tuple[DataFrame, DataFrame]:
    legs = t.raw_legs
    nonderiv = legs.filter(F.col("l_linestatus") == "F").withColumnRenamed("SK", "NONDERIV_TRANS_SK")
    deriv = legs.filter(F.col("l_linestatus") == "O").withColumnRenamed("SK", "DERIV_TRANS_SK")
    return nonderiv, deriv


@register(
    "p4_insider_transactions",
    ["raw_sub345", "raw_legs"],
    f"""WITH {_FACTS_345}
        SELECT g."ACCESSION_NUMBER" AS accession, CASE l_linestatus WHEN 'F' THEN 'nonderiv' ELSE 'deriv' END AS "rowKind", "SK" AS "rowSk",
               f."DOCUMENT_TYPE" AS "formType", f."ISSUERCIK" AS "issuerCik", trim(f."ISSUERTRADINGSYMBOL") AS "issuerTicker",
               {o.ticker('f."ISSUERTRADINGSYMBOL"')} AS "resolvedTicker", {o.eod(_ISO.format('f."FILING_DATE"'))} AS "availableAt",
               'sec_dataset_filing_date' AS "availabilitySource", "SECURITY_TITLE" AS "securityTitle", {o.day(_ISO.format('"TRANS_DATE"'))} AS "transactionDate",
               CAST(NULL AS VARCHAR) AS "deemedExecutionDate", "TRANS_FORM_TYPE" AS "transactionFormType", nullif("TRANS_CODE", '') AS "transactionCode",
               "EQUITY_SWAP_INVOLVED" = 'true' AS "equitySwapInvolved", "TRANS_ACQUIRED_DISP_CD" AS "acquiredDisposed",
               CAST("TRANS_SHARES" AS DOUBLE) AS shares, CAST("TRANS_PRICEPERSHARE" AS DOUBLE) AS "pricePerShare", CAST(NULL AS DOUBLE) AS "totalValue",
               CAST(NULL AS DOUBLE) AS "sharesOwnedFollowing", 'D' AS "directIndirect", CAST(NULL AS VARCHAR) AS "natureOfOwnership",
               CASE l_linestatus WHEN 'O' THEN CAST(1.5 AS DOUBLE) END AS "exercisePrice", CAST(NULL AS VARCHAR) AS "exerciseDate",
               CASE l_linestatus WHEN 'O' THEN {o.day(_ISO.format('"EXPIRATION_DATE"'))} END AS "expirationDate",
               CASE l_linestatus WHEN 'O' THEN 'Common Stock' END AS "underlyingTitle",
               CASE l_linestatus WHEN 'O' THEN CAST("UNDLYNG_SEC_SHARES" AS DOUBLE) END AS "underlyingShares", g.archive_key AS "rawArchiveKey"
        FROM raw_legs g JOIN facts f ON g."ACCESSION_NUMBER" = f."ACCESSION_NUMBER" """,
)
def p4(t: Tables) -> DataFrame:
    return normalize.transactions_insider(t.raw_sub345, *_leg_members(t)).rows


@register(
    "p5_issuer_ticker",
    ["dirty_symbols"],
    f"SELECT id, symbol, {o.ticker('symbol')} AS resolved FROM dirty_symbols",
)
def p5(t: Tables) -> DataFrame:
    return normalize.with_resolved_ticker(t.dirty_symbols, "symbol", "resolved")


@register(
    "p7_bucket",
    sql="""SELECT CAST(('0x' || substr(sha256('form13f:' || o_orderkey), 1, 8))::BIGINT % 32 AS BIGINT) AS bucket,
                  count(*) AS n, min(o_orderkey) AS least, max(o_orderkey) AS most FROM orders GROUP BY 1""",
)
def p7(t: Tables) -> DataFrame:
    identity = incremental.work_identity(F.lit("form13f"), F.col("o_orderkey").cast("string"))
    items = incremental.with_bucket(t.orders.withColumn("identity", identity), "identity", 32)
    return items.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("least"), F.max("o_orderkey").alias("most")
    )


@register(
    "p9_as_of",
    ["insider_filings"],
    f"""SELECT accession, "formType", "ownerCik", {o.day('"filingDate"')} AS "filingDate", {o.instant('"availableAt"')} AS "availableAt"
        FROM insider_filings WHERE "availableAt" <= TIMESTAMP '{AS_OF} 00:00:00'""",
)
def p9(t: Tables) -> DataFrame:
    known = lake.as_of(lake.with_shard(t.insider_filings), AS_OF)
    return known.select("accession", "formType", "ownerCik", "filingDate", "availableAt")


@register(
    "p10_raw_key",
    sql="""SELECT page_id, 'raw/pages/' || page_id || '/' || sha256(html) || '.html' AS "rawKey", false AS conflict FROM pages
           UNION ALL
           SELECT min(doc_id), lang || ':' || source, min(sha256(text)) <> max(sha256(text)) FROM documents GROUP BY lang, source""",
)
def p10(t: Tables) -> DataFrame:
    pages = incremental.with_raw_key(
        t.pages.withColumn("label", F.col("page_id").cast("string")), "raw/pages", "label", "html", ".html"
    )
    # Documents under one key per (lang, source): different bytes there are a conflict.
    shared = t.documents.withColumn("key", F.concat_ws(":", "lang", "source"))
    clashes = incremental.key_conflicts(shared, "key", "text").select("key", F.lit(True).alias("conflict"))
    offered = shared.groupBy("key").agg(F.min("doc_id").alias("page_id")).join(clashes, "key", "left")
    return pages.select("page_id", "rawKey", F.lit(False).alias("conflict")).unionByName(
        offered.select(
            "page_id", F.col("key").alias("rawKey"), F.coalesce("conflict", F.lit(False)).alias("conflict")
        )
    )


@register(
    "j1_cover_left",
    ["raw_sub13f", "raw_cover"],
    """WITH first_cover AS (SELECT * FROM raw_cover QUALIFY row_number() OVER (PARTITION BY "ACCESSION_NUMBER" ORDER BY ord) = 1)
       SELECT trim(s."ACCESSION_NUMBER") AS accession, "FILINGMANAGER_NAME" AS manager, "ISAMENDMENT" AS amendment
       FROM raw_sub13f s LEFT JOIN first_cover c ON trim(s."ACCESSION_NUMBER") = c."ACCESSION_NUMBER" """,
)
def j1(t: Tables) -> DataFrame:
    joined = normalize.cover_left(t.raw_sub13f, t.raw_cover)
    return joined.select(
        "accession", F.col("FILINGMANAGER_NAME").alias("manager"), F.col("ISAMENDMENT").alias("amendment")
    )


def _with_orphans(info: DataFrame) -> DataFrame:
    """INFOTABLE rows of which those with a CUSIP in 97s name an accession nobody filed."""
    part = F.regexp_extract("NAMEOFISSUER", r"(\d+)", 1).cast("long")
    broken = F.concat(F.lit("X"), F.col("ACCESSION_NUMBER"))
    return info.withColumn("ACCESSION_NUMBER", F.when(part % 97 == 0, broken).otherwise(F.col("ACCESSION_NUMBER")))


@register(
    "j2_holdings_filing",
    sql="""SELECT CASE WHEN l_partkey % 97 = 0 THEN 'reject' ELSE 'row' END AS outcome, count(*) AS n,
                  count(DISTINCT l_orderkey) AS accessions FROM lineitem GROUP BY 1""",
)
def j2(t: Tables) -> DataFrame:
    checked = normalize.holdings_13f(_with_orphans(t.raw_info), t.raw_sub13f)
    # Cells are parsed once for rows and rejects; reduced per accession before the distinct count.
    outcome = F.when(F.col("broken"), "reject").otherwise("row")
    per = checked.verdicts.groupBy(outcome.alias("outcome"), F.substring_index("sample", "/", 1).alias("a")).agg(F.count(F.lit(1)).alias("n"))
    return per.groupBy("outcome").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("accessions"))


@register(
    "j3_owner_submission",
    ["raw_sub345", "raw_owner"],
    f"""WITH {_FACTS_345}
        SELECT w."ACCESSION_NUMBER" AS accession, w."RPTOWNERCIK" AS "ownerCik", f."ISSUERNAME" AS "issuerName"
        FROM raw_owner w JOIN facts f ON w."ACCESSION_NUMBER" = f."ACCESSION_NUMBER" """,
)
def j3(t: Tables) -> DataFrame:
    return normalize.filings_insider(t.raw_sub345, t.raw_owner).rows.select("accession", "ownerCik", "issuerName")


@register(
    "j4_txn_submission",
    ["raw_sub345", "raw_legs"],
    f"""WITH {_FACTS_345}
        SELECT f."DOCUMENT_TYPE" AS "formType", f."ISSUERCIK" AS "issuerCik", count(*) AS legs, sum(CAST("TRANS_SHARES" AS DOUBLE)) AS shares
        FROM raw_legs g JOIN facts f ON g."ACCESSION_NUMBER" = f."ACCESSION_NUMBER" GROUP BY 1, 2""",
)
def j4(t: Tables) -> DataFrame:
    rows = normalize.transactions_insider(t.raw_sub345, *_leg_members(t)).rows
    return rows.groupBy("formType", "issuerCik").agg(
        F.count(F.lit(1)).alias("legs"), F.sum("shares").alias("shares")
    )


@register(
    "w1_first_last",
    sql="""SELECT l_orderkey, l_linenumber,
                  arg_min(l_partkey, (l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice)) AS first_part,
                  arg_max(l_partkey, (l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice)) AS last_part
           FROM lineitem GROUP BY ALL""",
)
def w1(t: Tables) -> DataFrame:
    order = F.struct("l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", order.alias("ord"))
    keys = ["l_orderkey", "l_linenumber"]
    first = keyed.first_per_key(lines, keys, "ord").select(*keys, F.col("l_partkey").alias("first_part"))
    last = keyed.last_per_key(lines, keys, "ord").select(*keys, F.col("l_partkey").alias("last_part"))
    return first.join(last, keys)


# ---- units -----------------------------------------------------------------------------

_DECISIONS = f"""
    implied AS (
        SELECT accession, value / "sharesAmount" AS price FROM inst_holdings
        WHERE "sharesType" = 'SH' AND coalesce("putCall", '') = '' AND value <> 0 AND "sharesAmount" > 0),
    judged AS (SELECT accession, count(*) AS n, {o.upper_median('price')} AS middle FROM implied GROUP BY 1),
    decided AS (
        SELECT f.accession, "filingDate" < DATE '1998-01-01' AS by_date, coalesce(n, 0) >= 5 AS has_median,
               coalesce(n, 0) >= 5 AND CASE WHEN "filingDate" < DATE '1998-01-01' THEN middle > 5 ELSE middle < 0.5 END AS contradicted
        FROM inst_filings f LEFT JOIN judged j ON f.accession = j.accession),
    scaled AS (SELECT accession, by_date <> contradicted AS scale, CASE WHEN has_median THEN 'median' ELSE 'date' END AS source, contradicted FROM decided)
"""


@register(
    "a4_value_units",
    ["inst_filings", "inst_holdings"],
    f"""WITH {_DECISIONS}
        SELECT h.accession, "infoTableSk", cusip, "sharesAmount",
               CASE WHEN scale THEN value * 1000 ELSE value END AS value,
               CASE WHEN value IS NOT NULL THEN coalesce(source, 'unknown') END AS "valueUnitSource"
        FROM inst_holdings h LEFT JOIN scaled s ON h.accession = s.accession""",
)
def a4(t: Tables) -> DataFrame:
    holdings = t.inst_holdings.drop("ord", "window", "side")
    dollars = units.to_dollars(t.inst_filings, holdings, "filingDate", UNIT_RULE)
    return dollars.select("accession", "infoTableSk", "cusip", "sharesAmount", "value", "valueUnitSource")


@register(
    "a5_value_report",
    ["inst_filings", "inst_holdings"],
    f"""WITH {_DECISIONS}
        SELECT count_if(value IS NOT NULL AND scale) AS scaled, count_if(value IS NOT NULL AND NOT scale) AS untouched,
               count_if(value IS NOT NULL AND scale IS NULL) AS "unresolvedFilingDate",
               (SELECT count_if(contradicted) FROM scaled) AS "overrodeDate",
               (SELECT count_if(source = 'date') FROM scaled) AS "decidedByDateAlone"
        FROM inst_holdings h LEFT JOIN scaled s ON h.accession = s.accession""",
)
def a5(t: Tables) -> DataFrame:
    return units.value_report(t.inst_filings, t.inst_holdings, "filingDate", UNIT_RULE)


@register(
    "a17_cutover",
    ["inst_filings", "inst_holdings"],
    f"""SELECT {o.day("CAST(date_trunc('month', \"filingDate\") AS DATE)")} AS month, count(*) AS n,
               {o.upper_median('value / "sharesAmount"')} AS "medianImpliedPrice"
        FROM inst_holdings h JOIN inst_filings f ON h.accession = f.accession
        WHERE "sharesType" = 'SH' AND coalesce("putCall", '') = '' AND value <> 0 AND "sharesAmount" > 0
        GROUP BY 1""",
)
def a17(t: Tables) -> DataFrame:
    return units.implied_price_by_month(t.inst_filings, t.inst_holdings, "filingDate")


# ---- tickers by span ---------------------------------------------------------------------

_SPANS = """
    clean AS (SELECT upper(trim(cusip)) AS cusip, trim(ticker) AS ticker, "fromDate", "toDate", ord FROM spans WHERE trim(ticker) <> ''),
    days AS (SELECT DISTINCT cusip, CAST("availableAt" AS DATE) AS day FROM inst_holdings),
    best AS (SELECT d.cusip, d.day, arg_min(ticker, ord) AS ticker FROM days d JOIN clean c ON d.cusip = c.cusip
             AND ("fromDate" IS NULL OR "fromDate" <= day) AND ("toDate" IS NULL OR "toDate" >= day) GROUP BY 1, 2)
"""


@register(
    "j6_ticker_span_join",
    ["spans", "inst_holdings"],
    f"""WITH {_SPANS}
        SELECT h.accession, "infoTableSk", h.cusip, {o.instant('"availableAt"')} AS "availableAt", "sharesAmount", b.ticker AS "resolvedTicker"
        FROM inst_holdings h LEFT JOIN best b ON h.cusip = b.cusip AND CAST(h."availableAt" AS DATE) = b.day""",
)
def j6(t: Tables) -> DataFrame:
    resolved = spans.resolve_tickers(t.inst_holdings, t.spans)
    return resolved.select("accession", "infoTableSk", "cusip", "availableAt", "sharesAmount", "resolvedTicker")


@register(
    "a6_ticker_report",
    ["spans", "inst_holdings"],
    f"""WITH {_SPANS}
        SELECT count_if(b.ticker IS NOT NULL) AS resolved, count_if(b.ticker IS NULL) AS unresolved,
               count(DISTINCT CASE WHEN h.cusip NOT IN (SELECT cusip FROM clean) THEN h.cusip END) AS "unresolvedCusips",
               count_if(b.ticker IS NULL AND h.cusip IN (SELECT cusip FROM clean)) AS "outsideEverySpan"
        FROM inst_holdings h LEFT JOIN best b ON h.cusip = b.cusip AND CAST(h."availableAt" AS DATE) = b.day""",
)
def a6(t: Tables) -> DataFrame:
    return spans.ticker_report(t.inst_holdings, t.spans)


# ---- crosswalk -----------------------------------------------------------------------------

_NPORT = """
    hold AS (SELECT string_split(line, chr(9)) AS c, ord FROM nport_holding_lines WHERE ord >= 0),
    mark AS (SELECT string_split(line, chr(9)) AS c, ord FROM nport_identifier_lines WHERE line NOT LIKE 'HOLDING_ID%'),
    folded AS (SELECT c[1] AS id, arg_max(upper(nullif(trim(c[3]), '')), ord) FILTER (WHERE trim(c[3]) <> '') AS ticker,
                      arg_max(upper(nullif(trim(c[2]), '')), ord) FILTER (WHERE trim(c[2]) <> '') AS isin
               FROM mark WHERE len(c) = 4 AND (trim(c[2]) <> '' OR trim(c[3]) <> '') GROUP BY 1),
    joined AS (SELECT upper(trim(c[4])) AS cusip, trim(c[3]) AS name, ord, ticker, isin FROM hold JOIN folded ON c[2] = id
               WHERE len(c) = 4 AND ticker IS NOT NULL),
    judged AS (SELECT *, CASE WHEN length(cusip) <> 9 OR regexp_full_match(cusip, '0+|9+') THEN 'placeholder'
                              WHEN length(isin) = 12 AND isin LIKE 'US%' AND substr(isin, 3, 9) <> cusip THEN 'mismatch' ELSE 'pair' END AS verdict FROM joined)
"""


def _nport(t: Tables, check: bool = False) -> tuple[DataFrame, DataFrame]:
    holdings = tsv.strict_records(
        t.nport_holding_lines, schemas.MEMBERS_NPORT["FUND_REPORTED_HOLDING.tsv"], check=check, leading=F.col("ord") < 0
    )
    identifiers = tsv.strict_records(
        t.nport_identifier_lines, schemas.MEMBERS_NPORT["IDENTIFIERS.tsv"], check=check, leading=F.col("ord.f0") == 0
    )
    return holdings, identifiers


@register("a1_identifier_fold", ["nport_holding_lines", "nport_identifier_lines"],
          f'WITH {_NPORT} SELECT id AS "holdingId", ticker, isin FROM folded')
def a1(t: Tables) -> DataFrame:
    return crosswalk.fold_identifiers(_nport(t)[1])


@register("j5_nport_join", ["nport_holding_lines", "nport_identifier_lines"],
          f'WITH {_NPORT} SELECT cusip, name AS "issuerName", ticker, isin, verdict FROM judged')
def j5(t: Tables) -> DataFrame:
    holdings, identifiers = _nport(t)
    joined = crosswalk.holdings_with_ticker(holdings, crosswalk.fold_identifiers(identifiers))
    return joined.select("cusip", "issuerName", "ticker", "isin", crosswalk.verdict().alias("verdict"))


@register("a2_crosswalk", ["nport_holding_lines", "nport_identifier_lines"],
          f"""WITH {_NPORT}
              SELECT cusip, ticker, list_extract(list(name ORDER BY ord), 1) AS "issuerName",
                     list_extract(list(isin ORDER BY ord), 1) AS isin, 'nport:2026q2' AS source
              FROM judged WHERE verdict = 'pair' GROUP BY 1, 2""")
def a2(t: Tables) -> DataFrame:
    return crosswalk.build_pairs(*_nport(t), source="nport:2026q2")


@register("a3_crosswalk_stats", ["nport_holding_lines", "nport_identifier_lines"],
          f"""WITH {_NPORT}
              SELECT (SELECT count(*) FROM hold) AS "holdingRows", (SELECT count(*) FROM mark) AS "identifierRows",
                     (SELECT count(ticker) FROM folded) AS "holdingsWithTicker",
                     (SELECT count(*) FROM (SELECT DISTINCT cusip, ticker FROM judged WHERE verdict = 'pair')) AS pairs,
                     count(DISTINCT CASE WHEN verdict = 'pair' THEN cusip END) AS "distinctCusips",
                     count_if(verdict = 'mismatch') AS "isinMismatches", count_if(verdict = 'placeholder') AS "placeholderCusips",
                     (SELECT count_if(len(c) <> 4) FROM hold) + (SELECT count_if(len(c) <> 4) FROM mark) AS "fieldCountMismatches"
              FROM judged""")
def a3(t: Tables) -> DataFrame:
    return crosswalk.crosswalk_stats(*_nport(t))


@register(
    "a10_figi_mode",
    ["venues"],
    """WITH counted AS (SELECT cusip, "shareClassFIGI" AS f, count(*) AS n FROM venues WHERE "shareClassFIGI" IS NOT NULL GROUP BY 1, 2),
            mode AS (SELECT cusip, list_extract(list(f ORDER BY n DESC, f), 1) AS f FROM counted GROUP BY 1),
            spoken AS (SELECT * FROM venues QUALIFY row_number() OVER (PARTITION BY cusip ORDER BY "exchCode" <> 'US', ord) = 1),
            us AS (SELECT * FROM venues WHERE "exchCode" = 'US' QUALIFY row_number() OVER (PARTITION BY cusip ORDER BY ord) = 1),
            listed AS (SELECT cusip, string_agg(t, ',' ORDER BY t) AS tickers FROM (SELECT DISTINCT cusip, upper(trim(ticker)) AS t FROM venues WHERE ticker IS NOT NULL) GROUP BY 1),
            sizes AS (SELECT cusip, count(*) AS n FROM venues GROUP BY 1)
       SELECT z.cusip, m.f AS "shareClassFigi", upper(trim(u.ticker)) AS "usTicker", coalesce(l.tickers, '') AS tickers,
              coalesce(s."securityType", s."securityType2") AS "securityType", s."marketSector", s.name, z.n AS "venueRows"
       FROM sizes z LEFT JOIN mode m ON z.cusip = m.cusip LEFT JOIN us u ON z.cusip = u.cusip
       LEFT JOIN listed l ON z.cusip = l.cusip LEFT JOIN spoken s ON z.cusip = s.cusip""",
)
def a10(t: Tables) -> DataFrame:
    return figi.share_class(t.venues)


@register(
    "l2_batches",
    sql="""WITH d AS (SELECT DISTINCT lpad(CAST(l_partkey AS VARCHAR), 9, '0') AS cusip FROM lineitem),
                b AS (SELECT cusip, ('0x' || substr(sha256(cusip), 1, 8))::BIGINT % 8 AS bucket FROM d),
                r AS (SELECT *, row_number() OVER (PARTITION BY bucket ORDER BY cusip) AS k FROM b)
           SELECT CAST(bucket AS BIGINT) AS bucket, CAST((k - 1) // 10 AS BIGINT) AS batch, string_agg(cusip, ',' ORDER BY cusip) AS cusips FROM r GROUP BY 1, 2""",
)
def l2(t: Tables) -> DataFrame:
    return figi.lookup_batches(t.inst_holdings, figi.BATCH, buckets=8)


@register(
    "l2_global_batches",
    sql="""WITH d AS (SELECT DISTINCT lpad(CAST(l_partkey AS VARCHAR), 9, '0') AS cusip FROM lineitem),
                r AS (SELECT *, row_number() OVER (ORDER BY cusip) AS k FROM d)
           SELECT CAST((k - 1) // 100 AS BIGINT) AS batch, string_agg(cusip, ',' ORDER BY cusip) AS cusips FROM r GROUP BY 1""",
)
def l2_global(t: Tables) -> DataFrame:
    return figi.lookup_batches(t.inst_holdings, figi.BATCH_WITH_KEY)


# ---- merges ----------------------------------------------------------------------------------


@register(
    "g1_merge_holdings",
    ["inst_holdings"],
    """WITH sides AS (SELECT accession, "infoTableSk", cusip, CASE side WHEN 'O' THEN value * 2 ELSE value END AS value, side, ord FROM inst_holdings)
       SELECT accession, "infoTableSk", cusip, value FROM sides
       QUALIFY row_number() OVER (PARTITION BY accession, "infoTableSk" ORDER BY side = 'O' DESC, ord DESC) = 1""",
)
def g1(t: Tables) -> DataFrame:
    rows = t.inst_holdings.drop("window")
    existing = rows.filter(F.col("side") == "F").drop("side")
    incoming = rows.filter(F.col("side") == "O").drop("side").withColumn("value", F.col("value") * 2)
    merged = merge.merge_institutional("institutional_holdings", existing, incoming, "ord")
    return merged.rows.select("accession", "infoTableSk", "cusip", "value")


def _insider_sides(t: Tables, later: Column) -> tuple[tuple[DataFrame, DataFrame], tuple[DataFrame, DataFrame]]:
    """The tables in two reads: as the lake has them (side F), and the rows of a `later` read.

    What the lake holds came from submissions where the accession is a multiple of 3; the later
    read takes multiples of 7 from submissions.
    """
    number = F.regexp_replace("accession", "X", "").cast("long")

    def source(every: int):
        return F.when(number % every == 0, schemas.SOURCE_ACCEPTANCE).otherwise(schemas.SOURCE_345_DATASET)

    filings, legs = t.insider_filings.drop("window", "ord"), t.insider_transactions.drop("window", "ord")
    existing = tuple(
        df.filter(F.col("side") == "F").drop("side").withColumn("availabilitySource", source(3)) for df in (filings, legs)
    )
    incoming = tuple(
        df.filter(later).drop("side").withColumn("availabilitySource", source(7)) for df in (filings, legs)
    )
    return existing, incoming


_MERGE_345 = """
    both_rows AS (
        SELECT 'filing' AS tbl, accession, "ownerCik" AS k, side, CAST(replace(accession, 'X', '') AS BIGINT) AS num FROM insider_filings
        UNION ALL SELECT 'leg', accession, "rowKind" || "rowSk", side, CAST(replace(accession, 'X', '') AS BIGINT) FROM insider_transactions),
    ranked AS (SELECT *, side = 'F' AS old, CASE WHEN num % (CASE WHEN side = 'F' THEN 3 ELSE 7 END) = 0 THEN 2 ELSE 1 END AS rank FROM both_rows),
    taken AS (SELECT n.accession FROM (SELECT DISTINCT accession, rank FROM ranked WHERE NOT old) n
              LEFT JOIN (SELECT DISTINCT accession, rank FROM ranked WHERE old) e ON n.accession = e.accession
              WHERE e.rank IS NULL OR n.rank >= e.rank)
"""


@register(
    "g2_merge_insider",
    ["insider_filings", "insider_transactions"],
    f"""WITH {_MERGE_345}
        SELECT tbl, accession, k, CASE rank WHEN 2 THEN 'sec_acceptance_datetime' ELSE 'sec_dataset_filing_date' END AS source, count(*) AS n
        FROM ranked WHERE old = (accession NOT IN (SELECT accession FROM taken)) GROUP BY ALL""",
)
def g2(t: Tables) -> DataFrame:
    filings, legs = merge.merge_insider(*_insider_sides(t, F.col("side") != "F"))
    both = filings.rows.select(
        F.lit("filing").alias("tbl"), "accession", F.col("ownerCik").alias("k"), F.col("availabilitySource").alias("source")
    ).unionByName(
        legs.rows.select(
            F.lit("leg").alias("tbl"), "accession", F.concat("rowKind", "rowSk").alias("k"), F.col("availabilitySource").alias("source")
        )
    )
    return both.groupBy("tbl", "accession", "k", "source").agg(F.count(F.lit(1)).alias("n"))


# ---- availability and incremental work -------------------------------------------------------------


@register(
    "j8_filing_availability",
    ["index_entries"],
    f"""WITH filed AS (SELECT *, accepted + to_hours(CAST(event_id % 260 - 110 AS INT)) AS filed FROM index_entries)
        SELECT accession, {o.instant('filed')} AS filed,
               CASE WHEN event_id % 9 <> 0 AND accepted >= filed - INTERVAL 96 HOUR AND accepted <= filed + INTERVAL 48 HOUR
                    THEN {o.instant('accepted + INTERVAL 60 SECOND')} ELSE {o.instant('filed + INTERVAL 24 HOUR')} END AS "availableAt",
               CASE WHEN event_id % 9 <> 0 AND accepted >= filed - INTERVAL 96 HOUR AND accepted <= filed + INTERVAL 48 HOUR
                    THEN 'submissions' ELSE 'filed-date-fallback' END AS "availabilitySource"
        FROM filed""",
)
def j8(t: Tables) -> DataFrame:
    shift = F.make_dt_interval(hours=(F.col("event_id") % 260 - 110).cast("int"))
    filings = t.index_entries.select("accession", (F.col("accepted") + shift).alias("filed"))
    # Every ninth acceptance time is unknown.
    accepted = t.index_entries.select(
        "accession", F.when(F.col("event_id") % 9 != 0, F.col("accepted")).alias("accepted")
    )
    return availability.filing_availability(filings, accepted)


@register(
    "g4_index_dedupe",
    sql="""SELECT lpad(CAST(l_orderkey AS VARCHAR), 10, '0') AS accession, lpad(CAST(min(l_suppkey * 1000000 + l_partkey) AS VARCHAR), 12, '0') AS cik
           FROM lineitem GROUP BY 1""",
)
def g4(t: Tables) -> DataFrame:
    listed = F.col("l_suppkey") * 1_000_000 + F.col("l_partkey")
    entries = t.lineitem.select(
        F.lpad(F.col("l_orderkey").cast("string"), 10, "0").alias("accession"),
        F.lpad(listed.cast("string"), 12, "0").alias("cik"),
        listed.alias("ord"),
    )
    return incremental.one_entry_per_accession(entries, "ord").drop("ord")


@register(
    "j7_known_anti",
    ["inst_holdings", "inst_filings"],
    """SELECT accession, count(*) AS n FROM inst_holdings WHERE accession NOT IN (SELECT accession FROM inst_filings) GROUP BY 1""",
)
def j7(t: Tables) -> DataFrame:
    unknown = incremental.unknown_entries(t.inst_holdings.select("accession"), t.inst_filings)
    return unknown.groupBy("accession").agg(F.count(F.lit(1)).alias("n"))


def _work(t: Tables) -> DataFrame:
    identity = incremental.work_identity(F.lit("form345"), F.col("o_orderkey").cast("string"))
    return t.orders.select(identity.alias("identity"), "o_orderkey", "o_orderstatus")


def _ledger(t: Tables, *more: str) -> DataFrame:
    """Finished identities: every order that is no longer open."""
    done = F.when(F.col("o_orderstatus") == "F", "done").otherwise("failed")
    body = F.to_json(F.struct(done.alias("status")))
    return t.orders.filter(F.col("o_orderstatus") != "O").select(
        F.lit("round-1").alias("roundId"),
        incremental.work_identity(F.lit("form345"), F.col("o_orderkey").cast("string")).alias("identity"),
        body.alias("body"),
        *more,
    )


_BUCKET = "('0x' || substr(sha256('form345:' || o_orderkey), 1, 8))::BIGINT % 16"


@register(
    "j11_pending",
    sql=f"""SELECT CAST({_BUCKET} AS BIGINT) AS bucket, 'form345:' || o_orderkey AS identity FROM orders
            WHERE o_orderstatus = 'O'""",
)
def j11(t: Tables) -> DataFrame:
    ledger = incremental.round_rows(_ledger(t), "round-1")
    pending = incremental.pending_work(_work(t), ledger)
    return incremental.with_bucket(pending, "identity", 16).select("bucket", "identity")


@register(
    "k4_ledger",
    sql="""SELECT 'round-1' AS "roundId", 'form345:' || o_orderkey AS identity,
                  CASE WHEN o_orderstatus = 'O' OR o_orderkey % 10 = 0 THEN 'again' WHEN o_orderstatus = 'F' THEN '{"status":"done"}' ELSE '{"status":"failed"}' END AS body
           FROM orders""",
)
def k4(t: Tables) -> DataFrame:
    finished = _work(t).filter((F.col("o_orderstatus") == "O") | (F.col("o_orderkey") % 10 == 0))
    return incremental.append_to_ledger(
        _ledger(t), finished.select("identity", F.lit("again").alias("body")), "round-1"
    )


@register(
    "g5_reprocess",
    sql="""SELECT 'kept' AS part, count(*) AS n FROM orders WHERE o_orderstatus = 'F'
           UNION ALL SELECT 'inspected', count(*) FROM orders WHERE o_orderstatus <> 'O'
           UNION ALL SELECT 'dropped', count(*) FROM orders WHERE o_orderstatus = 'P'""",
)
def g5(t: Tables) -> DataFrame:
    keep = F.get_json_object("body", "$.status") == "done"
    ledger = _ledger(t)
    report = incremental.reprocess_report(ledger, "round-1", keep)
    kept = incremental.drop_from_ledger(ledger, "round-1", keep).agg(F.count(F.lit(1)).alias("n"))
    return kept.select(F.lit("kept").alias("part"), "n").unionByName(
        report.select(F.explode(F.create_map(F.lit("inspected"), "inspected", F.lit("dropped"), "dropped")).alias("part", "n"))
    )


@register(
    "l1_defer",
    sql="""WITH pending AS (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O'),
                taken AS (SELECT * FROM pending ORDER BY o_orderkey LIMIT 250)
           SELECT 'taken' AS part, o_orderkey AS n FROM taken
           UNION ALL SELECT 'pending', count(*) FROM pending
           UNION ALL SELECT 'deferred', greatest(count(*) - 250, 0) FROM pending""",
)
def l1(t: Tables) -> DataFrame:
    pending = incremental.pending_work(_work(t), _ledger(t))
    taken, counts = incremental.take_first(pending, 250, "o_orderkey")
    return taken.select(F.lit("taken").alias("part"), F.col("o_orderkey").alias("n")).unionByName(
        counts.select(F.explode(F.create_map(F.lit("pending"), "pending", F.lit("deferred"), "deferred")).alias("part", "n"))
    )


@register(
    "a19_receipt_counts",
    ["inst_filings", "inst_holdings"],
    """WITH f AS (SELECT "rawArchiveKey" AS k, count(*) AS n FROM inst_filings GROUP BY 1),
            h AS (SELECT "rawArchiveKey" AS k, count(*) AS n FROM inst_holdings GROUP BY 1),
            a AS (SELECT "rawArchiveKey" AS k, sum(length(accession)) AS bytes FROM inst_filings GROUP BY 1)
       SELECT a.k AS "rawKey", coalesce(f.n, 0) AS filings, coalesce(h.n, 0) AS rows, CAST(bytes AS BIGINT) AS bytes
       FROM a LEFT JOIN f ON a.k = f.k LEFT JOIN h ON a.k = h.k""",
)
def a19(t: Tables) -> DataFrame:
    archives = t.inst_filings.groupBy(F.col("rawArchiveKey").alias("rawKey")).agg(
        F.sum(F.length("accession")).alias("bytes")
    )
    return incremental.receipt_counts(t.inst_filings, t.inst_holdings, archives)


# ---- analyses ------------------------------------------------------------------------------------


@register("a14_code_inventory", ["insider_transactions"],
          'SELECT "transactionCode", count(*) AS n FROM insider_transactions GROUP BY 1')
def a14(t: Tables) -> DataFrame:
    return analytics.code_inventory(t.insider_transactions)


@register(
    "a15_top_buyers",
    ["insider_transactions"],
    f"""SELECT "resolvedTicker", count(*) AS purchases FROM insider_transactions
        WHERE "transactionCode" = 'P' AND "availableAt" <= TIMESTAMP '{AS_OF} 00:00:00'
        GROUP BY 1 ORDER BY 2 DESC, 1 NULLS LAST LIMIT 10""",
)
def a15(t: Tables) -> DataFrame:
    return analytics.top_buyers(t.insider_transactions, AS_OF)


@register(
    "a16_figi_fill",
    ["inst_holdings"],
    """SELECT year("availableAt") AS year, count(*) AS rows, count(figi) AS filled,
              count(DISTINCT CASE WHEN figi IS NOT NULL THEN cusip END) AS "cusipsWithFigi", count(figi) / count(*) AS "fillRate"
       FROM inst_holdings GROUP BY 1""",
)
def a16(t: Tables) -> DataFrame:
    return analytics.figi_fill(t.inst_holdings)


@register(
    "a18_cluster",
    ["insider_filings", "insider_transactions"],
    f"""WITH bought AS (SELECT accession, "issuerCik", CAST(date_trunc('month', CAST("availableAt" AS DATE)) AS DATE) AS month, count(*) AS legs
                        FROM insider_transactions WHERE "transactionCode" = 'P' GROUP BY 1, 2, 3),
             owners AS (SELECT DISTINCT accession, "ownerCik" FROM insider_filings),
             per_owner AS (SELECT "issuerCik", month, "ownerCik", sum(legs) AS legs FROM bought b JOIN owners w ON b.accession = w.accession GROUP BY 1, 2, 3)
        SELECT "issuerCik", {o.day('month')} AS month, count(*) AS buyers, CAST(max(legs) AS BIGINT) AS "mostLegsOfOneBuyer"
        FROM per_owner GROUP BY 1, 2 HAVING count(*) >= 2""",
)
def a18_cluster(t: Tables) -> DataFrame:
    return analytics.cluster_buying(t.insider_filings, t.insider_transactions)


@register(
    "a18_concentration",
    ["inst_filings", "inst_holdings"],
    f"""WITH pos AS (SELECT f.cik, f."periodOfReport" AS period, h.cusip, sum(CAST(h.value AS DECIMAL(28,6))) AS v
                     FROM inst_holdings h JOIN inst_filings f ON h.accession = f.accession
                     WHERE h.value IS NOT NULL AND f."periodOfReport" IS NOT NULL GROUP BY 1, 2, 3),
             per AS (SELECT cik, period, count(*) AS positions, CAST(max(v) AS DOUBLE) / nullif(CAST(sum(v) AS DOUBLE), 0) AS share FROM pos GROUP BY 1, 2)
        SELECT cik, {o.day('period')} AS "periodOfReport", positions, round(share, 9) AS "topShare",
               round(share - lag(share) OVER (PARTITION BY cik ORDER BY period), 9) AS change FROM per""",
)
def a18_concentration(t: Tables) -> DataFrame:
    result = analytics.manager_concentration(t.inst_filings, t.inst_holdings)
    return result.select(
        "cik", "periodOfReport", "positions", F.round("topShare", 9).alias("topShare"), F.round("change", 9).alias("change")
    )


@register(
    "j14_owner_txn",
    ["insider_filings", "insider_transactions"],
    """WITH owners AS (SELECT DISTINCT accession, "ownerCik" FROM insider_filings)
       SELECT "ownerCik", count(DISTINCT t.accession) AS filings, count(*) AS legs,
              coalesce(sum(CASE WHEN "acquiredDisposed" = 'A' THEN shares END), 0) AS acquired,
              coalesce(sum(CASE WHEN "acquiredDisposed" = 'D' THEN shares END), 0) AS disposed
       FROM owners w JOIN insider_transactions t ON w.accession = t.accession GROUP BY 1""",
)
def j14(t: Tables) -> DataFrame:
    return analytics.owner_activity(t.insider_filings, t.insider_transactions)
