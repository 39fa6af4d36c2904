"""WARC archives: written by Spark as plain files, read back by boundary-chain verification.

Writing: of pages with equal payloads the one with the smallest id is a `response`, the others are
`revisit` records without payload that name it. Records are values of the text sink, whose line
separator is the end of a record.

Reading: the text source cuts files at every magic, in splits. Lengths of the cuts give offsets; each cut
is a candidate record, whose header gives the offset of its successor. Pointer jumping from offset 0
of each file, in as many rounds as the logarithm of the records of a file, keeps the reachable
candidates; a magic inside a payload is never reached. Payloads that hold a magic are put together
again from the cuts of their files, read a second time.

Defined cases: a null html is an empty payload; a null url has no header; line breaks in a url are
dropped; repeated rows of a page are written each; a null id is written and read as null; an empty
table writes no archive and reads nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from filinglake.llm import common
from filinglake.session import work_path

MAGIC = "WARC/1.1\r\n"
END = "\r\n\r\n"
# Payloads of at least so many bytes are written once.
LEAST_BYTES = 0
RECORDS_PER_FILE = 4096
# Revisits (some 60 bytes each) that may be broadcast; beyond, payloads are shuffled to be joined with them.
BROADCAST_REVISITS = 200_000
DATE = "2026-01-01T00:00:00Z"
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8"


def base32_sha1(text: Column) -> Column:
    """Bare upper-case base32 of the SHA-1 of the UTF-8 text: 40 bits, or 10 hex digits, give 8 letters."""
    digest = F.sha1(text.cast("binary"))
    parts = [F.lpad(F.conv(F.substring(digest, 10 * k + 1, 10), 16, 32), 8, "0") for k in range(4)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def records(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """One text per page: its WARC record without the final separator."""
    rows = pages.select(
        F.col("page_id").cast("long"), F.regexp_replace("url", "[\r\n]", "").alias("url"), F.coalesce("html", F.lit("")).alias("html")
    ).withColumn("digest", base32_sha1(F.col("html")))
    shared = F.octet_length("html") >= least_bytes
    first = rows.where(shared).groupBy("digest").agg(F.min("page_id").alias("first"))
    # Small rows decide; the payloads move once, by page, however many pages share one.
    verdict = (
        rows.where(shared).select("page_id", "digest").join(first, "digest").where(~F.col("page_id").eqNullSafe(F.col("first"))).distinct()
    )
    key = F.coalesce("page_id", F.lit(-(2**63)))
    verdict = common.land(verdict.withColumn("__id", key).drop("page_id"), "warc-revisits")
    if verdict.count() <= BROADCAST_REVISITS:
        verdict = F.broadcast(verdict)
    told = rows.withColumn("__id", key).join(verdict, ["__id", "digest"], "left")
    revisit = F.col("first").isNotNull()
    block = F.when(revisit, F.lit(_HTTP + END)).otherwise(F.concat(F.lit(_HTTP + END), "html"))
    header = F.concat_ws(
        "\r\n",
        F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: <urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(">")),
        F.concat(F.lit("WARC-Target-URI: "), "url"),
        F.lit(f"WARC-Date: {DATE}"),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), "digest"),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: <urn:page:"), F.col("first").cast("string"), F.lit(">"))),
        F.lit("Content-Type: application/http;msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")),
    )
    return told.select(F.concat(F.lit(MAGIC), header, F.lit(END), block).alias("value"))


def write(pages: DataFrame, path: str, least_bytes: int = LEAST_BYTES) -> str:
    """Write a WARC record for every page below `path`, at most RECORDS_PER_FILE a file."""
    records(pages, least_bytes).write.option("lineSep", END).option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)
    return path


def cuts(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, turn, value): what lies behind every magic, in file order by (block, turn); a file by its hash."""
    return (
        spark.read.option("lineSep", MAGIC)
        .text(path)
        .select(
            F.xxhash64("_metadata.file_path").alias("file"),  # 8 bytes instead of a path in every join
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("turn"),
            "value",
        )
    )


def _headed(cut: DataFrame) -> DataFrame:
    """Adds the header fields of each cut, whether it is a whole record by itself, and its payload's size and digest."""
    head, at = F.substring_index("value", END, 1), F.instr("value", END)
    field = lambda name, pattern: F.regexp_extract(F.concat(F.lit("\r\n"), "head"), f"\r\n{name}: {pattern}\r?(?:\n|$)", 1)
    return (
        cut.withColumn("size", F.octet_length("value"))
        .withColumns({"head": head, "at": at})
        .withColumn("length", F.when(F.col("at") > 0, field("Content-Length", "([0-9]+)").try_cast("long")))
        .withColumn("rest", _behind(F.col("value")))
        .withColumn("whole", F.coalesce((F.octet_length("rest") == F.col("length") + len(END)) & F.endswith("rest", F.lit(END)), F.lit(False)))
        .withColumn("payload", _payload(_behind(F.col("rest"))))
        .select(
            "file", "block", "turn", "size", "length", "whole",
            (F.octet_length("head") + len(END)).alias("head_size"),
            field("WARC-Type", "([a-z]+)").alias("record_type"),
            field("WARC-Record-ID", "<urn:page:(-?[0-9]+)>").try_cast("long").alias("page_id"),
            field("WARC-Refers-To", "<urn:page:(-?[0-9]+)>").try_cast("long").alias("refers_to"),
            field("WARC-Payload-Digest", "sha1:([A-Z2-7]+)").alias("told_digest"),
            F.octet_length("payload").cast("long").alias("payload_bytes"),
            base32_sha1(F.col("payload")).alias("payload_digest"),
        )
    )


def _behind(text: Column) -> Column:
    """What follows the first blank line."""
    return F.substring(text, F.instr(text, F.lit(END)) + len(END), F.length(text))


def _payload(inner: Column) -> Column:
    """The HTTP body without the end of the record; meaningful for whole records."""
    return F.substring(inner, F.lit(1), F.length(inner) - len(END))


def _placed(cut: DataFrame) -> DataFrame:
    """Adds the offset of each cut's magic; what lies before a file's first magic has none. One window a file, of bounded size."""
    order = Window.partitionBy("file").orderBy("block", "turn").rowsBetween(Window.unboundedPreceding, -1)
    before = F.sum(F.col("size") + len(MAGIC)).over(order)
    return cut.withColumn("offset", (before - len(MAGIC)).cast("long")).where("offset IS NOT NULL")


def reachable(candidates: DataFrame) -> DataFrame:
    """(file, offset) of the records that the chain from offset 0 of each file meets.

    Takes (file, offset, successor). Every round, each reached record reaches the one its pointer names and
    all pointers double, so a chain of n records takes log2(n) rounds; each round is landed.
    """
    state = candidates.select("file", "offset", F.col("successor").alias("jump"), (F.col("offset") == 0).alias("reached"))
    state, turn = common.land(state, "warc-chain"), 0
    while True:
        landed = state
        target = state.select("file", F.col("offset").alias("jump"), F.col("jump").alias("farther"))
        hit = state.where("reached AND jump IS NOT NULL").select("file", F.col("jump").alias("offset"), F.lit(True).alias("hit"))
        state = (
            state.join(target, ["file", "jump"], "left")
            .join(hit, ["file", "offset"], "left")
            .select("file", "offset", F.col("farther").alias("jump"), (F.col("reached") | F.coalesce("hit", F.lit(False))).alias("reached"))
        )
        before, state, turn = landed, common.land(state, f"warc-chain{turn}"), turn + 1
        common.discard(before)
        if state.where("reached AND jump IS NOT NULL").isEmpty():
            return state.where("reached").select("file", "offset")


def read(spark: SparkSession, path: str) -> DataFrame:
    """page_id, record_type, refers_to, payload_bytes and payload_digest of every record in the archives.

    Size and digest are computed from the payload that was read; a revisit takes them from the response
    its digest names.
    """
    placed = common.land(_placed(_headed(cuts(spark, path))), "warc-cuts")
    successor = F.col("offset") + len(MAGIC) + F.col("head_size") + F.col("length") + len(END)
    chain = reachable(placed.select("file", "offset", successor.alias("successor")))
    found = placed.join(chain, ["file", "offset"]).withColumn("until", successor)
    kept = ["file", "offset", "page_id", "record_type", "refers_to", "told_digest", "payload_bytes", "payload_digest"]
    whole = found.where("whole").select(*kept)
    broken = common.land(found.where("NOT whole").select("file", "offset", "until", "head_size", "page_id", "record_type", "refers_to", "told_digest"), "warc-split")
    if not broken.isEmpty():
        again = cuts(spark, path).join(broken.select("file").distinct(), "file", "left_semi").withColumn("size", F.octet_length("value"))
        pieces = _placed(again).select(F.col("file").alias("in_file"), F.col("offset").alias("at"), "value")
        owner = broken.select("file", "offset", "until")
        joined = (
            pieces.join(owner, F.expr("in_file = file AND at >= offset AND at < until"))
            .groupBy("file", "offset")
            .agg(F.array_sort(F.collect_list(F.struct("at", "value"))).alias("parts"))
        )
        body = F.array_join(F.transform("parts", lambda p: p["value"]), MAGIC)
        mended = (
            joined.select("file", "offset", body.alias("value"))
            .withColumn("payload", _payload(_behind(_behind(F.col("value")))))
            .select("file", "offset", F.octet_length("payload").cast("long").alias("payload_bytes"), base32_sha1(F.col("payload")).alias("payload_digest"))
        )
        whole = whole.union(broken.join(mended, ["file", "offset"]).select(*kept))
    responses = whole.where("record_type = 'response'")
    full = responses.groupBy(F.col("payload_digest").alias("told_digest")).agg(F.first("payload_bytes").alias("payload_bytes"))
    revisits = whole.where("record_type = 'revisit'").drop("payload_bytes").join(full, "told_digest")
    out = ["page_id", "record_type", "refers_to", "payload_bytes", "payload_digest"]
    return responses.select(*out).union(revisits.withColumn("payload_digest", F.col("told_digest")).select(*out))


def round_trip(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Write every page into archives in the shared folder and read them back."""
    spark = pages.sparkSession
    found = read(spark, write(pages, work_path(spark, "llm-warc"), least_bytes))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
