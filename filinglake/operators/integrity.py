"""Window audits over parsed rows (A7, A8), their rollup (A11), lags (A9), boundaries.

A window is one archive's label, carried as the column `window`, so every window is audited in
one job. Counters combine before the shuffle. The sample lists keep the first twenty entries in
file order; ranking filters of that form drop the rest on the map side. Inventories are maps.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filinglake.operators.keyed import as_column, side_by_side
from filinglake.operators.quantiles import floor_quantiles, level_quantile

# Entries in a sample list, the placeholder CUSIP, the notice form prefix.
SAMPLE = 20
# The share of keys in which the end of a sample list is looked for.
PILOT = 64
PLACEHOLDER = "000000000"
NOTICE = "13F-NT"
LAG_QUANTILES = {"p50": 0.5, "p95": 0.95, "max": 1.0}


def _inventory(df: DataFrame, keys: list[str], code: Column, name: str) -> DataFrame:
    """Counts per code as one map per key; codes are few, whatever the row count."""
    counts = df.groupBy(*keys, code.alias("_code")).agg(F.sum("_n").alias("_n"))
    entries = F.array_sort(F.collect_list(F.struct("_code", "_n")))
    return counts.groupBy(*keys).agg(F.map_from_entries(entries).alias(name))


def _first(df: DataFrame, keys: list[str], entry: str, order: str, name: str) -> DataFrame:
    """The first SAMPLE entries per key in `order`, as a list."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(order))
    top = df.withColumn("_rank", rank).filter(F.col("_rank") <= SAMPLE)
    listed = F.transform(
        F.array_sort(F.collect_list(F.struct(F.col("_rank"), F.col(entry).alias("entry")))),
        lambda e: e["entry"],
    )
    return top.groupBy(*keys).agg(listed.alias(name))


def _join_windows(parts: list[DataFrame]) -> DataFrame:
    """One row per window from tables that hold one row per window each."""
    return reduce(lambda a, b: a.join(b, "window", "left"), parts)


def lag_days(filed: str = "filingDate", period: str = "periodOfReport") -> Column:
    return F.datediff(F.col(filed), F.col(period))


def _repeats(rows: DataFrame) -> DataFrame:
    """Rows (window, accession, infoTableSk, _ord, _hash) whose key was seen before: up to SAMPLE per key.

    Hashes of keys are counted first, combined before a shuffle of eight bytes a key; only rows whose
    hash came twice are ranked, by the key itself, so two keys with one hash stay apart. More than
    SAMPLE repeats of one key cannot enter a list of SAMPLE, so the ranking filter is exact, and it
    lets each task forget the rest of a hot key.
    """
    again = rows.groupBy("_hash").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("_hash")
    by_key = Window.partitionBy("window", "accession", "infoTableSk").orderBy("_ord")
    return (
        rows.join(again, "_hash", "left_semi")
        .withColumn("_nth", F.row_number().over(by_key))
        .filter(F.col("_nth") <= SAMPLE + 1)
        .filter(F.col("_nth") > 1)
    )


def repeated_keys(df: DataFrame, order: Column | str, filed: DataFrame | None = None) -> DataFrame:
    """The first rows per window, SAMPLE of them at least if there are so many, whose key was seen before.

    A key is (window, accession, infoTableSk); if `filed` is given, only its (window, accession) count. The repeats
    among every PILOT-th hash are found first. Where they fill a list, the whole list cannot reach beyond its last
    entry, and neither do the rows that its entries repeat: later rows are left out before orders are shuffled.
    """

    def counting(repeats: DataFrame) -> DataFrame:
        return repeats if filed is None else repeats.join(filed, ["window", "accession"], "left_semi")

    key = ["window", "accession", "infoTableSk"]
    rows = df.select(*key, as_column(order).alias("_ord"), F.xxhash64(*key).alias("_hash"))
    pilot = counting(_repeats(rows.filter(F.pmod("_hash", F.lit(PILOT)) == 0)))
    in_order = F.row_number().over(Window.partitionBy("window").orderBy("_ord"))
    # One row per window.
    ends = pilot.withColumn("_at", in_order).filter(F.col("_at") <= SAMPLE).filter(F.col("_at") == SAMPLE).select("window", F.col("_ord").alias("_end"))
    within = F.col("_end").isNull() | F.col("_ord").isNull() | (F.col("_ord") <= F.col("_end"))
    near = rows.join(F.broadcast(ends), "window", "left").filter(within).drop("_end")
    return counting(_repeats(near)).select(
        "window", "accession", F.concat_ws("/", "accession", "infoTableSk").alias("entry"), "_ord"
    )


def _filing_counters(filings: DataFrame) -> DataFrame:
    """Per window: filings, nameless managers, types and quantiles of the lag, from one pass.

    Counts per (type, lag) are summed by type and by lag; both are few, whatever the row count.
    """
    c = F.col
    base = filings.groupBy("window", "submissionType", lag_days().alias("lag")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.coalesce("managerName", F.lit("")) == "").alias("nameless")
    )
    sums = base.groupingSets(
        [["window", "submissionType"], ["window", "lag"]], "window", "submissionType", "lag"
    ).agg(F.grouping("lag").alias("by_type"), F.sum("n").alias("_n"), F.sum("nameless").alias("_nameless"))
    by_type = c("by_type") == 1
    level = F.when(~by_type & c("lag").isNotNull(), F.struct(c("lag").alias("value"), c("_n").alias("n")))
    counted = sums.groupBy("window").agg(
        F.sum(F.when(by_type, c("_n"))).alias("filings"),
        F.sum(F.when(by_type, c("_nameless"))).alias("nullManagerFilings"),
        F.map_from_entries(
            F.array_sort(F.collect_list(F.when(by_type & c("submissionType").isNotNull(), F.struct("submissionType", "_n"))))
        ).alias("submissionTypes"),
        F.array_sort(F.collect_list(level)).alias("_levels"),
    )
    return counted.select(
        "window", "filings", "nullManagerFilings", "submissionTypes",
        *[level_quantile(c("_levels"), q).alias(f"lag_{name}") for name, q in LAG_QUANTILES.items()],
    )


def holdings_integrity(filings: DataFrame, holdings: DataFrame, order: Column | str) -> DataFrame:
    """One row per window with the counters of the 13F audit.

    `filings` and `holdings` carry `window`; `order` is the holdings' position in file order.
    Holdings without a filing in their window count as orphans and in the total only; the
    notice check still sees them.
    """
    c = F.col
    filed = filings.select("window", "accession").distinct().withColumn("_filed", F.lit(True))
    # What the counters need of a holding: its codes and one number of flags.
    empty = (F.coalesce("value", F.lit(0.0)) == 0) & (F.coalesce("sharesAmount", F.lit(0.0)) == 0)
    marks = {
        "null_issuer": F.coalesce("issuerName", F.lit("")) == "",
        "zero": empty,
        "figi": F.coalesce("figi", F.lit("")) != "",
    }
    marked = holdings.select(
        "window", "accession", "cusip", F.coalesce("putCall", F.lit("NULL")).alias("pc"),
        reduce(Column.__add__, [mark.cast("int") * 2**n for n, mark in enumerate(marks.values())]).alias("_marks"),
    )
    matched = marked.join(filed, ["window", "accession"], "left")
    # One pass at (window, known, cusip, put/call); its sums by CUSIP and by put/call then give
    # every counter and the inventory, without reading the holdings again.
    base = matched.groupBy("window", c("_filed").isNotNull().alias("known"), "cusip", "pc").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(F.bit_get("_marks", F.lit(n)) == 1).alias(name) for n, name in enumerate(marks)],
    )
    sums = base.groupingSets(
        [["window", "known", "cusip"], ["window", "known", "pc"]], "window", "known", "cusip", "pc"
    ).agg(
        F.grouping("cusip").alias("by_code"),
        *[F.sum(name).alias(f"_{name}") for name in ("n", "null_issuer", "zero", "figi")],
    )
    by_cusip, by_code = c("by_code") == 0, c("by_code") == 1

    def total(name: str, where: Column) -> Column:
        return F.coalesce(F.sum(F.when(where, c(f"_{name}"))), F.lit(0))

    counters = sums.groupBy("window").agg(
        total("n", by_cusip).alias("holdings"),
        total("n", by_cusip & ~c("known")).alias("orphanHoldings"),
        F.count_if(by_cusip & c("known")).alias("distinctCusips"),
        total("null_issuer", by_cusip & c("known")).alias("nullIssuerHoldings"),
        total("zero", by_cusip & c("known")).alias("zeroPositionHoldings"),
        total("n", by_cusip & c("known") & (c("cusip") == PLACEHOLDER)).alias("placeholderCusips"),
        total("figi", by_cusip & c("known")).alias("figiCoverage"),
        F.map_from_entries(
            F.array_sort(F.collect_list(F.when(by_code & c("known"), F.struct("pc", c("_n").alias("n")))))
        ).alias("putCall"),
    )
    # All rows of a key are known or none is, so orphans may be left out after the few repeats are found.
    duplicates = _first(repeated_keys(holdings, order, filed), ["window"], "entry", "_ord", "duplicateHoldingKeys")

    notice = (
        filings.filter(c("submissionType").startswith(NOTICE))
        .select("window", "accession")
        .join(holdings.select("window", "accession"), ["window", "accession"], "left_semi")
        .groupBy("window")
        .agg(F.count(F.lit(1)).alias("noticeFilingsWithHoldings"))
    )
    both = _filing_counters(filings).join(counters, "window", "full")
    joined = _join_windows([both, duplicates, notice])
    zero = [
        "filings", "holdings", "distinctCusips", "orphanHoldings", "noticeFilingsWithHoldings",
        "nullManagerFilings", "nullIssuerHoldings", "zeroPositionHoldings", "placeholderCusips",
        "figiCoverage",
    ]
    none = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<bigint>"))
    return joined.select(
        "window",
        *[F.coalesce(c(name), F.lit(0)).alias(name) for name in zero],
        F.coalesce("duplicateHoldingKeys", F.array().cast("array<string>")).alias("duplicateHoldingKeys"),
        F.coalesce("submissionTypes", none).alias("submissionTypes"),
        F.coalesce("putCall", none).alias("putCall"),
        *[c(f"lag_{q}") for q in LAG_QUANTILES],
    )


def insider_integrity(
    filings: DataFrame, transactions: DataFrame, order: Column | str
) -> DataFrame:
    """One row per window with the counters of the insider audit.

    `order` is the filings' position in file order: the first row of an accession supplies the
    day that transactions are compared with.
    """
    c = F.col
    per_accession = (
        filings.select("window", "accession", "ownerCik", "filingDate", as_column(order).alias("_ord"))
        .groupBy("window", "accession", "ownerCik")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.min_by("filingDate", "_ord").alias("day"),
            F.min("_ord").alias("_ord"),
        )
        .groupBy("window", "accession")
        .agg(
            F.sum("rows").alias("rows"),
            F.count(F.lit(1)).alias("owners"),
            F.min_by("day", "_ord").alias("day"),
            F.min("_ord").alias("_ord"),
        )
    )
    accessions = per_accession.groupBy("window").agg(F.count(F.lit(1)).alias("accessions"))
    surplus = c("rows") - c("owners") + 1
    duplicates = _first(
        per_accession.filter(c("owners") < c("rows")).withColumn(
            "entry", F.concat(c("accession"), F.lit(" x"), surplus.cast("string"))
        ),
        ["window"],
        "entry",
        "_ord",
        "duplicateFilingKeys",
    )
    filing_counts = filings.groupBy("window").agg(
        F.count(F.lit(1)).alias("filings"),
        F.count_if(c("formType").endswith("/A") & c("dateOfOriginalSubmission").isNull()).alias(
            "amendmentsWithoutOriginalDate"
        ),
        F.min("filingDate").alias("minFilingDate"),
        F.max("filingDate").alias("maxFilingDate"),
    )
    matched = transactions.select(
        "window", "accession", "transactionCode", "transactionDate", "issuerTicker", "shares", "pricePerShare"
    ).join(per_accession.select("window", "accession", "day"), ["window", "accession"], "left")
    known = c("day").isNotNull()
    negative = (F.coalesce("shares", F.lit(0.0)) < 0) | (F.coalesce("pricePerShare", F.lit(0.0)) < 0)
    # Codes are few, so this one shuffle carries a handful of rows per window and task.
    base = matched.groupBy("window", known.alias("known"), F.coalesce("transactionCode", F.lit("NULL")).alias("code")).agg(
        F.count(F.lit(1)).alias("_n"),
        F.count_if(known & (c("transactionDate") > c("day"))).alias("future"),
        F.count_if(known & (F.coalesce("issuerTicker", F.lit("")) == "")).alias("no_ticker"),
        F.count_if(known & c("shares").isNull()).alias("no_shares"),
        F.count_if(known & negative).alias("negative"),
    )
    counters = base.groupBy("window").agg(
        F.sum(F.when(c("known"), 0).otherwise(c("_n"))).alias("orphanTransactions"),
        F.sum("future").alias("futureDatedTransactions"),
        F.sum("no_ticker").alias("nullTickerTransactions"),
        F.sum("no_shares").alias("nullSharesTransactions"),
        F.sum("negative").alias("negativeAmounts"),
        F.sum("_n").alias("transactions"),
        F.map_from_entries(
            F.array_sort(F.collect_list(F.when(c("known"), F.struct("code", "_n"))))
        ).alias("transactionCodes"),
    )
    both = filing_counts.join(counters, "window", "full")
    joined = _join_windows([both, accessions, duplicates])
    zero = [
        "filings", "accessions", "transactions", "orphanTransactions", "futureDatedTransactions",
        "nullTickerTransactions", "nullSharesTransactions", "negativeAmounts",
        "amendmentsWithoutOriginalDate",
    ]
    none = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<bigint>"))
    return joined.select(
        "window",
        *[F.coalesce(c(name), F.lit(0)).alias(name) for name in zero],
        F.coalesce("duplicateFilingKeys", F.array().cast("array<string>")).alias("duplicateFilingKeys"),
        F.coalesce("transactionCodes", none).alias("transactionCodes"),
        "minFilingDate",
        "maxFilingDate",
    )


def window_accessions(filings: DataFrame) -> DataFrame:
    """Distinct (window, accession): a table, because a list would hold a whole window."""
    return filings.select("window", "accession").distinct()


def accession_spread(filings: DataFrame) -> DataFrame:
    """One row: distinct accessions, and how many lie in more than one window."""
    return (
        window_accessions(filings)
        .groupBy("accession")
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(
            F.count(F.lit(1)).alias("distinctAccessions"),
            F.count_if(F.col("n") > 1).alias("multiWindowAccessions"),
        )
    )


def _summed_maps(report: DataFrame, name: str) -> DataFrame:
    entries = report.select(F.explode(name).alias("code", "n"))
    totals = entries.groupBy("code").agg(F.sum("n").alias("n"))
    return totals.agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("code", "n")))).alias(name)
    )


def rollup(report: DataFrame, counters: list[str], inventories: list[str], samples: str) -> DataFrame:
    """One row over all windows: summed counters, merged inventories, the first samples.

    `report` is an A7 or A8 result: one row per window, so this step is small.
    """
    totals = report.agg(
        F.count(F.lit(1)).alias("windows"),
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in counters],
    )
    entries = (
        report.select("window", F.posexplode(samples).alias("pos", "entry"))
        .orderBy("window", "pos")
        .limit(SAMPLE)
        .agg(F.sort_array(F.collect_list(F.struct("window", "pos", "entry"))).alias("top"))
        .select(F.transform("top", lambda e: e["entry"]).alias(samples))
    )
    parts = [_summed_maps(report, name) for name in inventories]
    return side_by_side(totals, *parts, entries)


def boundary_overlaps(report: DataFrame) -> DataFrame:
    """Adjacent windows, by first filing day, whose days overlap (W4). One row per window in."""
    c = F.col
    # Few rows (one per archive), so one ordered window is right here.
    ordered = Window.orderBy(c("minFilingDate").asc_nulls_first(), "window")
    return (
        report.select("window", "minFilingDate", "maxFilingDate")
        .withColumn("previous", F.lag("window").over(ordered))
        .withColumn("previousMax", F.lag("maxFilingDate").over(ordered))
        .filter(c("minFilingDate") <= c("previousMax"))
        .select("previous", "previousMax", "window", "minFilingDate")
    )


def listed_overlaps(report: DataFrame) -> DataFrame:
    """One row: the overlaps as a list of `before[last day] x after[first day]`, by first day."""
    c = F.col
    text = F.concat(
        c("previous"), F.lit("["), c("previousMax").cast("string"), F.lit("] x "),
        c("window"), F.lit("["), c("minFilingDate").cast("string"), F.lit("]"),
    )
    found = boundary_overlaps(report).select(F.struct("minFilingDate", "window", text.alias("text")).alias("at"))
    listed = F.transform(F.array_sort(F.collect_list("at")), lambda e: e["text"])
    return found.agg(listed.alias("boundaryOverlaps"))


def filing_lags(submissions: DataFrame) -> DataFrame:
    """Days from period to filing for originals and amendments.

    `submissions` needs submissionType, filingDate and periodOfReport; rows that miss a date
    are skipped.
    """
    kind = F.when(F.col("submissionType").endswith("/A"), "amendment").otherwise("original")
    lags = submissions.select(kind.alias("kind"), lag_days().alias("lag"))
    return floor_quantiles(lags, ["kind"], "lag", LAG_QUANTILES)


def archive_label(key: Column, prefix: str) -> Column:
    """The path segment between the raw prefix and the content hash, or null."""
    rest = F.when(key.startswith(f"{prefix}/"), F.substr(key, F.lit(len(prefix) + 2)))
    label = F.when(F.instr(rest, "/") > 0, F.substring_index(rest, "/", 1))
    return F.when((label != "") & (F.instr(label, "..") == 0), label)


def archives_by_label(objects: DataFrame, prefix: str) -> DataFrame:
    """The first listed object per window label."""
    labelled = objects.select(archive_label(F.col("key"), prefix).alias("label"), "key")
    named = labelled.filter(F.col("label").isNotNull()).distinct()
    return named.groupBy("label").agg(F.min("key").alias("key"))


def coverage(objects: DataFrame, ledger: DataFrame, dataset: str, prefix: str) -> DataFrame:
    """Windows on one side only: `missing_raw` fails an audit, `unreceipted` is listed."""
    raw = archives_by_label(objects, prefix).select("label")
    identity = F.col("identity")
    done = ledger.select("identity").distinct()
    named = done.select(
        F.substring(identity, F.instr(identity, ":") + F.lit(1), F.length(identity)).alias("label")
    ).filter(F.col("label") != "").distinct()
    expected = raw.withColumn("identity", F.concat(F.lit(f"{dataset}:"), F.col("label")))
    return (
        named.join(raw, "label", "left_anti")
        .select("label", F.lit("missing_raw").alias("status"))
        .unionByName(
            expected.join(done, "identity", "left_anti").select("label", F.lit("unreceipted").alias("status"))
        )
    )


class MissingRaw(ValueError):
    """Finished windows whose raw archive is not there."""


def gate_verdict(found: DataFrame, dataset: str) -> DataFrame:
    """One row from a coverage: may the audit go on, what is missing, what has no ledger row.

    `found` holds windows, one row per archive at most, so the lists are short.
    """
    missing = F.array_sort(F.collect_list(F.when(F.col("status") == "missing_raw", F.col("label"))))
    open_ = F.collect_list(F.when(F.col("status") == "unreceipted", F.concat(F.lit(f"{dataset}:"), F.col("label"))))
    listed = found.agg(missing.alias("_missing"), F.array_sort(open_).alias("unreceipted"))
    return listed.select(
        (F.size("_missing") == 0).alias("passes"),
        F.size("_missing").cast("long").alias("missing"),
        F.slice("_missing", 1, 3).alias("sample"),
        "unreceipted",
    )


def require_covered(verdict: DataFrame) -> None:
    """Refuse an audit that would pass over finished windows in silence."""
    row = verdict.first()
    if not row.passes:
        raise MissingRaw(f"no raw archive for {row.missing} finished window(s), e.g. {', '.join(row.sample)}")
