"""Daily form index text (S4) and the insider forms in it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filinglake.functions.text import SPACE_CLASS, trimmed
from filinglake.operators.checks import Checked, split_broken
from filinglake.sources.tsv import BROADCAST_FILES

# Insider form types, the width of the form column, the separator, and the
# shape of the rest of a line, read from its right-hand columns.
INSIDER_FORMS = ("3", "3/A", "4", "4/A", "5", "5/A")
FORM_WIDTH = 17
SEPARATOR = rf"^-{{20,}}{SPACE_CLASS}*$"
REST = (
    rf"^(\S.*?){SPACE_CLASS}{{2,}}(\d+){SPACE_CLASS}+(\d{{4}})(\d{{2}})(\d{{2}}){SPACE_CLASS}+(\S+){SPACE_CLASS}*$"
)

MARK = "\x01"
PARTS = f"$1{MARK}$2{MARK}$3-$4-$5{MARK}$6"


def _of_files(found: DataFrame) -> DataFrame:
    """What was found in each file, one row a file, found once and sent to all tasks if the files are few enough."""
    rows = found.limit(BROADCAST_FILES + 1).collect()
    return F.broadcast(found.sparkSession.createDataFrame(rows, found.schema)) if len(rows) <= BROADCAST_FILES else found


def read_index(lines: DataFrame) -> Checked:
    """Entries below the dashed separator of every file in `lines` (archive_key, ord, line).

    Rejects hold lines of another shape and files without a separator.
    """
    c = F.col
    dashed = c("line").startswith("-" * 20) & c("line").rlike(SEPARATOR)
    separators = _of_files(lines.groupBy("archive_key").agg(F.min(F.when(dashed, c("ord"))).alias("_at")))
    # A line and its two halves leave a generator: filters on them are not pushed below, where each of their terms
    # would make or cut the line again.
    cut = F.struct("line", F.substring("line", 1, FORM_WIDTH), F.expr(f"substring(line, {FORM_WIDTH + 1})"))
    halves = lines.select("archive_key", "ord", F.inline(F.array(cut)).alias("line", "_left", "_right"))
    body = (
        halves.join(separators.filter(c("_at").isNotNull()), "archive_key")
        .filter((c("ord") > c("_at")) & (trimmed(c("line")) != ""))
        .select(
            "archive_key",
            "ord",
            "line",
            trimmed(c("_left")).alias("form"),
            # One match per line; its parts come back in one text.
            F.regexp_replace("_right", REST, PARTS).alias("_parts"),
        )
        .select("*", F.split("_parts", MARK).alias("_part"))
    )
    part = lambda n: F.get("_part", F.lit(n))
    columns = {
        "archive_key": c("archive_key"),
        "ord": c("ord"),
        "formType": c("form"),
        "companyName": part(0),
        "cik": part(1),
        "dateFiled": part(2),
        "fileName": part(3),
        "accession": F.regexp_replace(F.substring_index(part(3), "/", -1), r"\.txt$", ""),
    }
    rules = {"index line": (c("form") == "") | (F.size("_part") != 4)}
    entries = split_broken("daily index", body, rules, columns, trimmed(c("line")))
    headless = separators.filter(c("_at").isNull()).select(
        F.array(F.lit("index separator")).alias("broken"), c("archive_key").alias("sample")
    )
    return Checked(entries.table, entries.rows, entries.rejects.unionByName(headless))


def insider_entries(entries: DataFrame) -> DataFrame:
    return entries.filter(F.col("formType").isin(*INSIDER_FORMS))
