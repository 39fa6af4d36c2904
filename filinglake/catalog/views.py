"""Disclosure-shaped views of the given tables, as one SQL text for Spark and for the SQL oracle.

A view is a template: `{name}` is another view or a given table, and `d` supplies the handful of
functions the two engines spell differently. Every view covers its whole tables; the modulo terms
only decide which rows get a null, a second owner or a broken key.
"""

from __future__ import annotations

from collections.abc import Callable
from string import Formatter

from pyspark.sql import DataFrame, SparkSession


class SparkText:
    name = "spark"

    def eod(self, day: str) -> str:
        return f"(to_utc_timestamp(CAST(date_add({day}, 1) AS TIMESTAMP), 'America/New_York') - INTERVAL '0.001' SECOND)"

    def instant(self, ts: str) -> str:
        return f"CAST({ts} AS TIMESTAMP)"

    def div(self, a: str, b: int) -> str:
        return f"({a} DIV {b})"

    def sec(self, day: str) -> str:
        return f"upper(date_format({day}, 'dd-MMM-yyyy'))"

    def compact(self, ts: str, clock: bool = False) -> str:
        return f"date_format({ts}, '{'yyyyMMddHHmmss' if clock else 'yyyyMMdd'}')"

    def row(self, *columns: str) -> str:
        return f"named_struct({', '.join(f"'f{n}', {c}" for n, c in enumerate(columns))})"

    def sha(self, value: str) -> str:
        return f"sha2({value}, 256)"

    def shift(self, ts: str, hours: str) -> str:
        return f"({ts} + make_dt_interval(0, {hours}))"


class DuckText:
    name = "duck"

    def eod(self, day: str) -> str:
        return f"(((({day}) + 1)::TIMESTAMP AT TIME ZONE 'America/New_York') AT TIME ZONE 'UTC' - INTERVAL 1 MILLISECOND)"

    def instant(self, ts: str) -> str:
        return ts

    def div(self, a: str, b: int) -> str:
        return f"({a} // {b})"

    def sec(self, day: str) -> str:
        return f"upper(strftime({day}, '%d-%b-%Y'))"

    def compact(self, ts: str, clock: bool = False) -> str:
        return f"strftime({ts}, '{'%Y%m%d%H%M%S' if clock else '%Y%m%d'}')"

    def row(self, *columns: str) -> str:
        return f"struct_pack({', '.join(f'f{n} := {c}' for n, c in enumerate(columns))})"

    def sha(self, value: str) -> str:
        return f"sha256({value})"

    def shift(self, ts: str, hours: str) -> str:
        return f"({ts} + to_hours({hours}))"


LINE_ORDER = (
    "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus",
)


def key(column: str, width: int = 10) -> str:
    return f"lpad(CAST({column} AS STRING), {width}, '0')"


def window(column: str) -> str:
    """Twelve windows, named as quarters."""
    return f"concat(CAST(2013 + {column} % 12 AS STRING), 'q', CAST(1 + {column} % 4 AS STRING))"


def archive(dataset: str, label: str) -> str:
    return f"concat('raw/{dataset}/datasets/', {label}, '/', lpad('', 64, 'a'), '.zip')"


_DAY = "CAST(o_orderdate AS DATE)"
_SHIP = "CAST(l_shipdate AS DATE)"
_QUARTER_END = f"CAST(date_trunc('quarter', {_DAY}) - INTERVAL 1 DAY AS DATE)"
_PERIOD = f"CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE {_QUARTER_END} END"
_TYPE = "CASE o_orderstatus WHEN 'F' THEN '13F-HR' WHEN 'O' THEN '13F-HR/A' ELSE '13F-NT' END"
_FORM = "CASE o_orderpriority WHEN '1-URGENT' THEN '4/A' WHEN '5-LOW' THEN '3' ELSE '4' END"
_CODE = "CASE l_returnflag WHEN 'A' THEN 'P' WHEN 'R' THEN 'S' ELSE NULL END"
_KIND = "CASE l_linestatus WHEN 'F' THEN 'nonderiv' ELSE 'deriv' END"
_TICKER = "concat('T', chr(65 + CAST({0} % 23 AS INT)), chr(65 + CAST({0} % 17 AS INT)))"
# Lines whose part is a multiple of 97 point at an accession nobody filed.
_LINE_ACCESSION = f"CASE WHEN l_partkey % 97 = 0 THEN concat('X', {key('l_orderkey', 9)}) ELSE {key('l_orderkey')} END"


def _ticker(column: str) -> str:
    return _TICKER.format(column)


# Free-text symbols around a plain ticker t, as filers type them.
def _dirty(t: str, n: str) -> str:
    return f"""CASE {n} % 12
        WHEN 0 THEN concat('NYSE: ', {t}) WHEN 1 THEN concat('(', {t}, ')')
        WHEN 2 THEN concat({t}, ', ', {t}, '.B') WHEN 3 THEN 'none'
        WHEN 4 THEN concat({t}, 'p') WHEN 5 THEN lower({t})
        WHEN 6 THEN concat(substr({t}, 1, 1), ' ', substr({t}, 2, 1), ' ', substr({t}, 3, 1))
        WHEN 7 THEN concat({t}, 'A/', {t}, 'B') WHEN 8 THEN concat('  ', {t}, '  ')
        WHEN 9 THEN concat({t}, ' AND ZG') WHEN 10 THEN concat({t}, chr(39), 'B')
        ELSE concat('"', {t}, '"') END"""


_MONEY = "CAST(floor(l_extendedprice) AS BIGINT)"


def _commas(d) -> str:
    return f"""CASE WHEN {_MONEY} >= 1000
        THEN concat(CAST({d.div(_MONEY, 1000)} AS STRING), ',', lpad(CAST({_MONEY} % 1000 AS STRING), 3, '0'))
        ELSE CAST({_MONEY} AS STRING) END"""


def _preamble(d, number: int, text: str) -> str:
    """One line at the head of each day's index."""
    return f"""SELECT concat('form.', {d.compact('day')}, '.idx') AS archive_key, CAST({number} AS BIGINT) AS ord, {text} AS line
        FROM (SELECT DISTINCT CAST(ts AS DATE) AS day FROM {{events}}) days"""


VIEWS: dict[str, Callable] = {
    # ---- typed lake tables -------------------------------------------------------------
    "inst_filings": lambda d: f"""
        SELECT {key('o_orderkey')} AS accession, {_DAY} AS filingDate, {d.eod(_DAY)} AS availableAt,
               'sec_13f_quarterly_dataset' AS availabilitySource, {_TYPE} AS submissionType,
               {key('o_custkey')} AS cik,
               CASE WHEN o_custkey % 13 = 0 THEN NULL ELSE c_name END AS managerName,
               {_PERIOD} AS periodOfReport, CAST({_PERIOD} AS STRING) AS reportCalendarOrQuarter,
               o_orderstatus = 'O' AS isAmendment, CAST(NULL AS STRING) AS amendmentNo,
               CAST(NULL AS STRING) AS amendmentType, CAST(NULL AS DATE) AS dateReported,
               {archive('sec13f', window('o_orderkey'))} AS rawArchiveKey,
               {window('o_orderkey')} AS {{window}}
        FROM {{orders}} LEFT JOIN {{customer}} ON o_custkey = c_custkey""",
    "inst_holdings": lambda d: f"""
        SELECT {_LINE_ACCESSION} AS accession, CAST(l_linenumber AS STRING) AS infoTableSk,
               {d.eod(_SHIP)} AS availableAt, 'sec_13f_quarterly_dataset' AS availabilitySource,
               CASE WHEN l_partkey % 61 = 0 THEN NULL ELSE concat('Issuer ', CAST(l_partkey AS STRING)) END AS issuerName,
               'COM' AS titleOfClass, {key('l_partkey', 9)} AS cusip,
               CASE WHEN l_suppkey % 4 = 0 AND l_shipdate >= TIMESTAMP '1999-01-01 00:00:00'
                    THEN concat('BBG', {key('l_suppkey', 6)}) END AS figi,
               CASE WHEN l_suppkey % 50 = 49 THEN NULL WHEN l_partkey % 83 = 0 THEN CAST(0 AS DOUBLE)
                    WHEN l_orderkey % 2 = 0 THEN l_extendedprice * CAST(0.001 AS DOUBLE)
                    ELSE l_extendedprice END AS value,
               CASE WHEN l_partkey % 83 = 0 THEN CAST(0 AS DOUBLE) ELSE l_quantity END AS sharesAmount,
               CASE WHEN l_tax >= CAST(0.08 AS DOUBLE) THEN 'PRN' ELSE 'SH' END AS sharesType,
               CASE WHEN l_discount >= CAST(0.1 AS DOUBLE) THEN 'Put'
                    WHEN l_discount >= CAST(0.09 AS DOUBLE) THEN 'Call' END AS putCall,
               'SOLE' AS discretion, CAST(NULL AS STRING) AS otherManager, l_quantity AS votingSole,
               CAST(0 AS DOUBLE) AS votingShared, CAST(0 AS DOUBLE) AS votingNone,
               CAST(NULL AS STRING) AS resolvedTicker, CAST(NULL AS STRING) AS valueUnitSource,
               {archive('sec13f', window('l_orderkey'))} AS rawArchiveKey,
               {window('l_orderkey')} AS {{window}}, l_linestatus AS side,
               {d.row(*LINE_ORDER)} AS ord
        FROM {{lineitem}}""",
    "insider_filings": lambda d: f"""
        SELECT {key('o_orderkey')} AS accession, {_FORM} AS formType, {_DAY} AS filingDate,
               {d.eod(_DAY)} AS availableAt, 'sec_dataset_filing_date' AS availabilitySource,
               {_PERIOD} AS periodOfReport,
               CASE WHEN o_orderpriority = '1-URGENT' AND o_orderkey % 3 <> 0
                    THEN CAST({_DAY} - INTERVAL 10 DAY AS DATE) END AS dateOfOriginalSubmission,
               {key('o_orderkey % 97')} AS issuerCik,
               concat('Issuer ', CAST(o_orderkey % 97 AS STRING)) AS issuerName,
               CASE WHEN o_orderkey % 97 % 19 = 0 THEN NULL ELSE {_ticker('(o_orderkey % 97)')} END AS issuerTicker,
               CASE WHEN o_orderkey % 97 % 19 = 0 THEN NULL ELSE {_ticker('(o_orderkey % 97)')} END AS resolvedTicker,
               {key('o_custkey + owner_no * (1 + o_orderkey % 3)')} AS ownerCik, c_name AS ownerName,
               o_orderkey % 4 = 0 AS isDirector, o_orderkey % 4 = 1 AS isOfficer,
               o_orderkey % 4 = 2 AS isTenPercentOwner, o_orderkey % 4 = 3 AS isOther,
               CASE WHEN o_orderkey % 4 = 1 THEN 'CFO' END AS officerTitle,
               CAST(NULL AS STRING) AS ownerRelationshipText, CAST(NULL AS BOOLEAN) AS aff10b5One,
               {archive('sec345', window('o_orderkey'))} AS rawArchiveKey,
               {window('o_orderkey')} AS {{window}}, o_orderstatus AS side,
               {d.row('o_orderkey', 'owner_no')} AS ord
        FROM (SELECT *, 0 AS owner_no FROM {{orders}}
              UNION ALL SELECT *, 1 AS owner_no FROM {{orders}} WHERE o_orderkey % 5 = 0
              UNION ALL SELECT *, 0 AS owner_no FROM {{orders}} WHERE o_orderkey % 53 = 0) o
        LEFT JOIN {{customer}} ON o_custkey = c_custkey""",
    "insider_transactions": lambda d: f"""
        SELECT {_LINE_ACCESSION} AS accession, {_KIND} AS rowKind, CAST(l_linenumber AS STRING) AS rowSk,
               '4' AS formType, {key('l_orderkey % 97')} AS issuerCik,
               CASE WHEN l_orderkey % 97 % 19 = 0 THEN NULL ELSE {_ticker('(l_orderkey % 97)')} END AS issuerTicker,
               CASE WHEN l_orderkey % 97 % 19 = 0 THEN NULL ELSE {_ticker('(l_orderkey % 97)')} END AS resolvedTicker,
               {d.eod(_SHIP)} AS availableAt, 'sec_dataset_filing_date' AS availabilitySource,
               'Common Stock' AS securityTitle, {_SHIP} AS transactionDate,
               CAST(NULL AS DATE) AS deemedExecutionDate, '4' AS transactionFormType, {_CODE} AS transactionCode,
               CAST(NULL AS BOOLEAN) AS equitySwapInvolved,
               CASE WHEN l_returnflag = 'A' THEN 'A' ELSE 'D' END AS acquiredDisposed,
               CASE WHEN l_suppkey % 50 = 9 THEN NULL WHEN l_suppkey % 50 = 7 THEN -l_quantity ELSE l_quantity END AS shares,
               CASE WHEN l_suppkey % 50 = 11 THEN -l_extendedprice ELSE l_extendedprice END AS pricePerShare,
               CAST(NULL AS DOUBLE) AS totalValue, l_quantity AS sharesOwnedFollowing, 'D' AS directIndirect,
               CAST(NULL AS STRING) AS natureOfOwnership, CAST(NULL AS DOUBLE) AS exercisePrice,
               CAST(NULL AS DATE) AS exerciseDate, CAST(NULL AS DATE) AS expirationDate,
               CAST(NULL AS STRING) AS underlyingTitle, CAST(NULL AS DOUBLE) AS underlyingShares,
               {archive('sec345', window('l_orderkey'))} AS rawArchiveKey,
               {window('l_orderkey')} AS {{window}}, l_linestatus AS side,
               {d.row(*LINE_ORDER)} AS ord
        FROM {{lineitem}}""",
    # ---- reference data ---------------------------------------------------------------
    "spans": lambda d: f"""
        SELECT {key('p_partkey', 9)} AS cusip, {_ticker('p_partkey')} AS ticker,
               CAST(NULL AS DATE) AS fromDate, CAST(NULL AS DATE) AS toDate, p_partkey * 100 + 90 AS ord
        FROM {{part}} WHERE p_partkey % 7 <> 0 AND p_partkey % 3 = 0
        UNION ALL
        SELECT concat(' ', {key('p_partkey', 9)}), concat({_ticker('p_partkey')}, 'x'), DATE '1995-06-01', DATE '1998-06-30', p_partkey * 100 + 10
        FROM {{part}} WHERE p_partkey % 7 <> 0 AND p_partkey % 3 <> 0
        UNION ALL
        SELECT {key('p_partkey', 9)}, concat(' ', {_ticker('p_partkey')}, 'p'), DATE '1998-07-01', CASE WHEN p_partkey % 2 = 0 THEN DATE '2000-12-31' END, p_partkey * 100 + 20
        FROM {{part}} WHERE p_partkey % 7 <> 0 AND p_partkey % 3 <> 0
        UNION ALL
        SELECT {key('p_partkey', 9)}, '  ', DATE '1995-01-01', DATE '1996-01-01', p_partkey * 100 + 5
        FROM {{part}}
        UNION ALL
        SELECT {key('l_partkey', 9)}, concat('W', CAST(l_linenumber AS STRING)), {_SHIP}, CAST({_SHIP} + INTERVAL 20 DAY AS DATE), l_partkey * 100 + l_linenumber
        FROM {{lineitem}} WHERE l_partkey % 5 = 1""",
    "dirty_symbols": lambda d: f"""
        SELECT p_partkey AS id, {_dirty(_ticker('p_partkey'), 'p_partkey')} AS symbol FROM {{part}}""",
    "index_entries": lambda d: f"""
        SELECT CASE event_type WHEN 'view' THEN '10-K' WHEN 'click' THEN '4' WHEN 'error' THEN '1-A POS'
                    WHEN 'signup' THEN '3/A' ELSE '5' END AS formType,
               concat('Company  ', CAST(user_id AS STRING), ' Inc') AS companyName, CAST(user_id AS STRING) AS cik,
               CAST(ts AS DATE) AS day, concat('edgar/data/', CAST(user_id AS STRING), '/', {key('event_id')}, '.txt') AS fileName,
               {key('event_id')} AS accession, event_id, {d.instant('ts')} AS accepted
        FROM {{events}}""",
    "index_lines": lambda d: f"""
        SELECT concat('form.', {d.compact('day')}, '.idx') AS archive_key, CAST(event_id + 10 AS BIGINT) AS ord,
               concat(rpad(formType, 17, ' '), companyName, '   ', cik, '   ', {d.compact('day')}, '   ', fileName,
                      CASE WHEN event_id % 2 = 0 THEN '   ' ELSE '' END) AS line
        FROM {{index_entries}}
        UNION ALL
        {_preamble(d, 0, "'Form Type   Company Name   CIK   Date Filed   File Name'")}
        UNION ALL {_preamble(d, 1, "''")} UNION ALL {_preamble(d, 2, "concat(lpad('', 60, '-'), '  ')")}""",
    "landing": lambda d: f"""
        SELECT page_id, concat(html, '<a href="/files/dera/', CAST(2013 + page_id % 12 AS STRING), 'q', CAST(1 + page_id % 4 AS STRING),
               '_form13f.zip">x</a> <a href="../up_form13f.zip.exe">y</a> <a class="z" href="',
               CASE WHEN page_id % 2 = 0 THEN 'https://example.org' ELSE '' END,
               '/files/', CAST(2019 + page_id % 6 AS STRING), 'q', CAST(1 + page_id % 5 AS STRING), '_nport.zip">n</a>') AS html
        FROM {{pages}}""",
    "labels_done": lambda d: f"""
        SELECT DISTINCT concat('form13f:', {window('o_orderkey')}) AS identity FROM {{orders}} WHERE o_orderpriority <> '5-LOW' OR o_orderkey % 12 < 9
        UNION ALL SELECT DISTINCT concat('form13f:', CAST(1990 + o_orderkey % 3 AS STRING), 'q1') FROM {{orders}}""",
    # ---- raw members ------------------------------------------------------------------
    "raw_sub13f": lambda d: f"""
        SELECT {archive('sec13f', window('o_orderkey'))} AS archive_key, {d.row('o_orderkey', '0')} AS ord,
               concat(' ', {key('o_orderkey')}) AS ACCESSION_NUMBER, {d.sec(_DAY)} AS FILING_DATE, {_TYPE} AS SUBMISSIONTYPE,
               {key('o_custkey')} AS CIK, coalesce({d.sec(_PERIOD)}, '') AS PERIODOFREPORT
        FROM {{orders}}""",
    "raw_cover": lambda d: f"""
        SELECT {archive('sec13f', window('o_orderkey'))} AS archive_key, {d.row('o_orderkey', 'page')} AS ord,
               {key('o_orderkey')} AS ACCESSION_NUMBER, {d.sec(_DAY)} AS REPORTCALENDARORQUARTER,
               CASE WHEN o_orderkey % 3 = 0 THEN 'y' WHEN o_orderkey % 3 = 1 THEN 'N ' ELSE '?' END AS ISAMENDMENT,
               CASE WHEN o_orderstatus = 'O' THEN CAST(o_orderkey % 4 AS STRING) ELSE '' END AS AMENDMENTNO,
               '' AS AMENDMENTTYPE, concat('Manager ', CAST(page AS STRING), ' of ', CAST(o_custkey AS STRING)) AS FILINGMANAGER_NAME,
               '' AS DATEREPORTED
        FROM (SELECT *, 0 AS page FROM {{orders}} WHERE o_orderkey % 17 <> 0
              UNION ALL SELECT *, 1 AS page FROM {{orders}} WHERE o_orderkey % 7 = 0) o""",
    "raw_info": lambda d: f"""
        SELECT {archive('sec13f', window('l_orderkey'))} AS archive_key, {d.row(*LINE_ORDER)} AS ord,
               {key('l_orderkey')} AS ACCESSION_NUMBER, CAST(l_linenumber AS STRING) AS INFOTABLE_SK,
               concat('Issuer ', CAST(l_partkey AS STRING), ' ') AS NAMEOFISSUER, 'COM' AS TITLEOFCLASS,
               concat(' ', substr({key('l_partkey', 9)}, 1, 4), ' ', substr({key('l_partkey', 9)}, 5), 'a ') AS CUSIP,
               '' AS FIGI, {_commas(d)} AS VALUE, CAST(CAST(l_quantity AS INT) AS STRING) AS SSHPRNAMT,
               'SH' AS SSHPRNAMTTYPE, CASE WHEN l_discount >= CAST(0.1 AS DOUBLE) THEN 'Put' ELSE ' ' END AS PUTCALL,
               'SOLE' AS INVESTMENTDISCRETION, '' AS OTHERMANAGER, concat(CAST(CAST(l_quantity AS INT) AS STRING), 'e0') AS VOTING_AUTH_SOLE,
               '0' AS VOTING_AUTH_SHARED, '' AS VOTING_AUTH_NONE
        FROM {{lineitem}}""",
    "raw_sub345": lambda d: f"""
        SELECT {archive('sec345', window('o_orderkey'))} AS archive_key, {d.row('o_orderkey', 'version')} AS ord,
               {key('o_orderkey')} AS ACCESSION_NUMBER, {d.sec(_DAY)} AS FILING_DATE, coalesce({d.sec(_PERIOD)}, '') AS PERIOD_OF_REPORT,
               '' AS DATE_OF_ORIG_SUB, {_FORM} AS DOCUMENT_TYPE, {key('o_orderkey % 97')} AS ISSUERCIK,
               concat('Issuer ', CAST(o_orderkey % 97 AS STRING), ' v', CAST(version AS STRING)) AS ISSUERNAME,
               {_dirty(_ticker('(o_orderkey % 97)'), '(o_orderkey + version)')} AS ISSUERTRADINGSYMBOL,
               CASE o_orderkey % 3 WHEN 0 THEN '1' WHEN 1 THEN 'False' ELSE '' END AS AFF10B5ONE
        FROM (SELECT *, 0 AS version FROM {{orders}}
              UNION ALL SELECT *, 1 AS version FROM {{orders}} WHERE o_orderkey % 6 = 0) o""",
    "raw_owner": lambda d: f"""
        SELECT {archive('sec345', window('o_orderkey'))} AS archive_key, {d.row('o_orderkey', 'owner_no')} AS ord,
               {key('o_orderkey')} AS ACCESSION_NUMBER, {key('o_custkey + owner_no')} AS RPTOWNERCIK,
               concat('Owner ', CAST(o_custkey AS STRING)) AS RPTOWNERNAME,
               CASE o_orderkey % 4 WHEN 0 THEN 'Director,Officer' WHEN 1 THEN 'Ten Percent Owner' WHEN 2 THEN ' officer , other' ELSE '' END AS RPTOWNER_RELATIONSHIP,
               CASE WHEN o_orderkey % 4 = 2 THEN 'CFO ' ELSE '' END AS RPTOWNER_TITLE, '' AS RPTOWNER_TXT
        FROM (SELECT *, 0 AS owner_no FROM {{orders}}
              UNION ALL SELECT *, 1 AS owner_no FROM {{orders}} WHERE o_orderkey % 5 = 0) o""",
    "raw_legs": lambda d: f"""
        SELECT {archive('sec345', window('l_orderkey'))} AS archive_key, {d.row(*LINE_ORDER)} AS ord,
               {key('l_orderkey')} AS ACCESSION_NUMBER, CAST(l_linenumber AS STRING) AS SK,
               'Common Stock' AS SECURITY_TITLE, {d.sec(_SHIP)} AS TRANS_DATE, '' AS DEEMED_EXECUTION_DATE, '4' AS TRANS_FORM_TYPE,
               coalesce({_CODE}, '') AS TRANS_CODE, CASE WHEN l_suppkey % 2 = 0 THEN 'true' ELSE '0' END AS EQUITY_SWAP_INVOLVED,
               CAST(CAST(l_quantity AS INT) AS STRING) AS TRANS_SHARES, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS STRING) AS TRANS_PRICEPERSHARE,
               CASE WHEN l_returnflag = 'A' THEN 'A' ELSE 'D' END AS TRANS_ACQUIRED_DISP_CD, '' AS SHRS_OWND_FOLWNG_TRANS,
               'D' AS DIRECT_INDIRECT_OWNERSHIP, '' AS NATURE_OF_OWNERSHIP, '1.5' AS CONV_EXERCISE_PRICE, '' AS TRANS_TOTAL_VALUE,
               '' AS EXCERCISE_DATE, {d.sec(f"CAST({_SHIP} + INTERVAL 365 DAY AS DATE)")} AS EXPIRATION_DATE,
               'Common Stock' AS UNDLYNG_SEC_TITLE, CAST(l_linenumber AS STRING) AS UNDLYNG_SEC_SHARES, l_linestatus
        FROM {{lineitem}}""",
    # Text lines of one member: two header layouts, a dropped tail, an extra cell, a blank line.
    "info_lines": lambda d: f"""
        SELECT CASE l_linestatus WHEN 'F' THEN 'flat' ELSE 'wide' END AS archive_key,
               {d.row('1', *LINE_ORDER, 'l_orderkey', 'l_linenumber')} AS ord,
               CASE WHEN l_partkey % 41 = 0 THEN '   '
                    WHEN l_linestatus = 'F' THEN concat_ws(chr(9), {key('l_orderkey')}, CAST(l_linenumber AS STRING), {key('l_partkey', 9)}, CASE WHEN l_suppkey % 3 = 0 THEN NULL ELSE 'note' END)
                    ELSE concat_ws(chr(9), {key('l_partkey', 9)}, 'skip', {key('l_orderkey')}, CAST(l_linenumber AS STRING), 'note', 'last', 'extra') END AS line
        FROM {{lineitem}}
        UNION ALL
        SELECT CASE l_linestatus WHEN 'F' THEN 'flat' ELSE 'wide' END,
               {d.row("0", *[f"CAST(NULL AS {t})" for t in ("TIMESTAMP_NTZ" if d.name == "spark" else "TIMESTAMP", "BIGINT", "BIGINT", "DOUBLE", "DOUBLE", "DOUBLE", "DOUBLE", "STRING", "STRING", "BIGINT", "INT")])},
               CASE l_linestatus WHEN 'F' THEN concat_ws(chr(9), ' ACCESSION_NUMBER', 'INFOTABLE_SK', 'CUSIP ', 'NOTE')
                    ELSE concat_ws(chr(9), 'CUSIP', 'OTHER', 'ACCESSION_NUMBER', 'INFOTABLE_SK', 'NOTE', 'NOTE') END
        FROM (SELECT DISTINCT l_linestatus FROM {{lineitem}}) files""",
    # Fund holdings and identifiers: several identifier rows a holding, some lines too wide.
    "nport_holding_lines": lambda d: f"""
        SELECT 'h' AS archive_key, CAST(l_orderkey * 100 + l_linenumber AS BIGINT) AS ord,
               concat_ws(chr(9), {key('l_orderkey')}, concat({key('l_orderkey')}, '-', CAST(l_linenumber AS STRING)),
                   CASE WHEN l_orderkey % 29 = 0 THEN concat('Issuer', chr(9), 'Inc') ELSE concat('Issuer ', CAST(l_orderkey AS STRING)) END,
                   CASE WHEN l_orderkey % 31 = 0 THEN '000000000' WHEN l_orderkey % 37 = 0 THEN 'n/a' ELSE lower(concat('C', {key('least_part % 500', 8)})) END) AS line
        FROM (SELECT l_orderkey, l_linenumber, min(l_partkey) AS least_part FROM {{lineitem}} GROUP BY l_orderkey, l_linenumber) h
        UNION ALL SELECT 'h', CAST(-1 AS BIGINT), concat_ws(chr(9), 'ACCESSION_NUMBER', 'HOLDING_ID', 'ISSUER_NAME', 'ISSUER_CUSIP')""",
    "nport_identifier_lines": lambda d: f"""
        SELECT 'i' AS archive_key, {d.row('1', *LINE_ORDER)} AS ord,
               concat_ws(chr(9), concat({key('l_orderkey')}, '-', CAST(l_linenumber AS STRING)),
                   CASE WHEN l_returnflag = 'N' THEN concat('US', 'C', {key('l_partkey % 500', 8)}, '9') WHEN l_suppkey % 10 = 0 THEN 'GB0002374006' ELSE '' END,
                   CASE WHEN l_returnflag = 'A' THEN lower(substr({_ticker('l_partkey')}, 1, 2)) ELSE '' END,
                   CASE WHEN l_partkey % 43 = 0 THEN concat('a', chr(9), 'b') ELSE 'x' END) AS line
        FROM {{lineitem}}
        UNION ALL SELECT 'i', {d.row("0", *[f"CAST(NULL AS {t})" for t in ("TIMESTAMP_NTZ" if d.name == "spark" else "TIMESTAMP", "BIGINT", "BIGINT", "DOUBLE", "DOUBLE", "DOUBLE", "DOUBLE", "STRING", "STRING")])},
               concat_ws(chr(9), 'HOLDING_ID', 'IDENTIFIER_ISIN', 'IDENTIFIER_TICKER', 'OTHER')""",
    # Venue rows and service responses.
    "venues": lambda d: f"""
        SELECT {key('l_partkey', 9)} AS cusip, CASE WHEN l_suppkey % 5 = 0 THEN 'US' ELSE 'GR' END AS exchCode,
               CASE WHEN l_suppkey % 11 = 0 THEN NULL ELSE concat(' t', CAST(l_linenumber AS STRING)) END AS ticker,
               CASE WHEN l_suppkey % 9 = 0 THEN NULL ELSE concat('BBG', CAST(l_suppkey % 4 AS STRING)) END AS shareClassFIGI,
               CASE WHEN l_linenumber % 2 = 0 THEN NULL ELSE 'Common Stock' END AS securityType, 'Equity Family' AS securityType2,
               'Equity' AS marketSector, concat('Part ', CAST(l_orderkey AS STRING)) AS name,
               {d.row('l_orderkey', 'l_linenumber', *LINE_ORDER)} AS ord
        FROM {{lineitem}}""",
    "exchanges": lambda d: f"""
        SELECT p_partkey, {key('p_partkey', 9)} AS cusip_a, concat('N', {key('p_partkey', 8)}) AS cusip_b,
               concat('[{{{{"data":[',
                   '{{{{"exchCode":"GR","ticker":"', lower(substr(p_name, 1, 3)), 'eur","name":"', p_name, '","shareClassFIGI":"S', CAST(p_size AS STRING), '","securityType2":"', p_type, '"}}}},',
                   '{{{{"exchCode":"', CASE WHEN p_partkey % 2 = 0 THEN 'US' ELSE 'LN' END, '","ticker":" ', lower(p_type), ' ","name":"', p_brand, '","shareClassFIGI":"S', CAST(p_size + p_partkey % 2 AS STRING), '","securityType":"', p_type, '","marketSector":"Equity"}}}}',
                   ']}}}},{{{{"warning":"No identifier found."}}}}]') AS response
        FROM {{part}}""",
    "manifests": lambda d: f"""
        SELECT {key('o_orderkey')} AS snapshot_id,
               concat('{{{{"schemaVersion":1,"dataset":"d","generatedAt":"2026-01-01","totals":{{{{"rows":', CAST(o_custkey AS STRING), '}}}},"tables":{{{{"',
                   CASE WHEN o_orderstatus = 'F' THEN 'insider_filings' ELSE 'institutional_holdings' END, '":{{{{"rows":1,"years":[', CAST(year({_DAY}) AS STRING), '],"manifests":[{{{{"year":',
                   CAST(year({_DAY}) AS STRING), ',"files":[{{{{"publicPath":"', CASE WHEN o_orderkey % 13 = 0 THEN 'data/../x' WHEN o_orderkey % 19 = 0 THEN 'other/x' ELSE 'data/x' END, '/', CAST(o_orderkey AS STRING),
                   '.parquet","size":', CASE WHEN o_orderkey % 23 = 0 THEN '-1' ELSE CAST(o_custkey AS STRING) END, ',"sha256":"', {d.sha(key('o_orderkey'))}, CASE WHEN o_orderkey % 21 = 0 THEN 'F' ELSE '' END, '"}}}}]}}}}]}}}}}}}}}}}}') AS json
        FROM {{orders}}""",
    # Submission text of one order: header, owners, one leg of each table.
    "submissions": lambda d: f"""
        SELECT concat('raw/', {key('o_orderkey')}, '.txt') AS archive_key,
               concat('<SEC-HEADER>', chr(10), '<ACCEPTANCE-DATETIME>', {d.compact(_DAY)}, '17', lpad(CAST(o_orderkey % 60 AS STRING), 2, '0'), '08', chr(10),
                   'ACCESSION NUMBER:', chr(9), chr(9), {key('o_orderkey')}, chr(10), 'FILED AS OF DATE:', chr(9), {d.compact(_DAY)}, chr(10), '</SEC-HEADER>', chr(10),
                   '<ownershipDocument><documentType>', {_FORM}, '</documentType>',
                   CASE WHEN o_orderkey % 11 = 0 THEN '' ELSE concat('<periodOfReport>', CAST({_QUARTER_END} AS STRING), '-05:00</periodOfReport>') END,
                   '<issuer><issuerCik>', {key('o_orderkey % 97')}, '</issuerCik><issuerName>A &amp; B ', CAST(o_orderkey % 97 AS STRING), '</issuerName><issuerTradingSymbol>NYSE: ', {_ticker('(o_orderkey % 97)')}, '</issuerTradingSymbol></issuer>',
                   '<reportingOwner><reportingOwnerId><rptOwnerCik>', {key('o_custkey')}, '</rptOwnerCik><rptOwnerName>', CASE WHEN o_orderkey % 59 = 0 THEN '' ELSE 'Owner' END, '</rptOwnerName></reportingOwnerId>',
                   '<reportingOwnerRelationship><isDirector>1</isDirector><isOther>', CASE WHEN o_orderkey % 2 = 0 THEN 'true' ELSE '0' END, '</isOther></reportingOwnerRelationship></reportingOwner>',
                   CASE WHEN o_orderkey % 5 = 0 THEN concat('<reportingOwner><reportingOwnerId><rptOwnerCik>', {key('o_custkey + 1')}, '</rptOwnerCik><rptOwnerName>Joint</rptOwnerName></reportingOwnerId></reportingOwner>') ELSE '' END,
                   '<nonDerivativeTable><nonDerivativeTransaction><securityTitle><value>Common</value></securityTitle><transactionDate><value>', CAST({_DAY} AS STRING), '</value></transactionDate>',
                   '<transactionCoding><transactionCode>P</transactionCode><equitySwapInvolved>0</equitySwapInvolved></transactionCoding>',
                   '<transactionAmounts><transactionShares><value>', CAST(o_custkey AS STRING), '</value><footnoteId id="F1"/></transactionShares><transactionPricePerShare><footnoteId id="F2"/></transactionPricePerShare></transactionAmounts>',
                   '</nonDerivativeTransaction></nonDerivativeTable>',
                   CASE WHEN o_orderkey % 3 = 0 THEN concat('<derivativeTable><derivativeTransaction><securityTitle><value>Option</value></securityTitle><conversionOrExercisePrice><value>',
                       CASE WHEN o_orderkey % 87 = 0 THEN 'n/a' ELSE '1.5' END, '</value></conversionOrExercisePrice></derivativeTransaction></derivativeTable>') ELSE '' END,
                   '</ownershipDocument>') AS raw
        FROM {{orders}}""",
}

# What a column named as a reserved word is called in each engine.
_QUOTED = {"spark": "`window`", "duck": '"window"'}
_TEXT = {"spark": SparkText(), "duck": DuckText()}


def _template(name: str, engine: str) -> str:
    return VIEWS[name](_TEXT[engine]).replace("{window}", _QUOTED[engine])


def _needs(template: str) -> list[str]:
    fields = (field for _, field, _, _ in Formatter().parse(template) if field)
    return list(dict.fromkeys(fields))


# Views whose text is parsed again. A real landing has many files; the given tables have one
# split each, so their rows are first spread over the cores.
_PARSED = {
    "raw_sub13f", "raw_cover", "raw_info", "raw_sub345", "raw_owner", "raw_legs", "info_lines",
    "index_entries", "nport_holding_lines", "nport_identifier_lines", "manifests", "submissions", "exchanges",
}


# Bytes of a table, as it is stored, whose text one task parses.
PIECE = 4 * 2**20


def pieces(df: DataFrame) -> int:
    """Partitions the text made of a table is parsed in."""
    stored = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return max(df.sparkSession.sparkContext.defaultParallelism, stored // PIECE)


def spread(df: DataFrame) -> DataFrame:
    """The same rows over at least as many partitions as cores, and over several waves of tasks on large inputs.

    Splits follow stored bytes and row groups; parsing the text made of them takes far longer than reading them, so
    a task for each core alone would grow with the input and wait for the slowest.
    """
    cores, wanted = df.sparkSession.sparkContext.defaultParallelism, pieces(df)
    return df if df.rdd.getNumPartitions() >= min(wanted, 4 * cores) else df.repartition(wanted, *df.columns[:4])


class Tables:
    """The given tables of one folder and the views over them, as DataFrames."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder
        self._made: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._made:
            if name in VIEWS:
                template = _template(name, "spark")
                needs = {needed: getattr(self, needed) for needed in _needs(template)}
                if name in _PARSED:
                    needs = {needed: spread(df) for needed, df in needs.items()}
                self._made[name] = self.spark.sql(template, **needs)
            else:
                self._made[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._made[name]

    def over(self, name: str, **given: DataFrame) -> DataFrame:
        """The view `name` over the given rows of tables it needs, as they are dealt out."""
        template = _template(name, "spark")
        return self.spark.sql(template, **{needed: given[needed] if needed in given else getattr(self, needed) for needed in _needs(template)})


def sql_with(names: list[str], body: str) -> str:
    """Oracle SQL: the views `names` (and what they need) as common table expressions, then `body`."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in VIEWS and name not in ordered:
            for needed in _needs(_template(name, "duck")):
                visit(needed)
            ordered.append(name)

    for name in names:
        visit(name)
    parts = []
    for name in ordered:
        template = _template(name, "duck")
        parts.append(f"{name} AS ({template.format(**{n: n for n in _needs(template)})})")
    body = body.strip()
    if not parts:
        return body
    joined = ",\n".join(parts)
    return f"WITH {joined},\n{body[5:]}" if body.startswith("WITH ") else f"WITH {joined}\n{body}"
