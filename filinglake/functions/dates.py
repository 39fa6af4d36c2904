"""Dates as the sources print them, and the instant a filing could first have been known."""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

NEW_YORK = "America/New_York"
_MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"
_SEC_SHAPE = r"^[0-9]{1,2}-[A-Za-z]{3}-[0-9]{4}$"
# Fixed value: availability is strictly after acceptance.
ACCEPTANCE_DELAY = "interval 60 seconds"


def sec_date(cell: Column) -> Column:
    """A trimmed `31-OCT-2025` as a date; null when blank or not a calendar date."""
    # The shape leaves ASCII letters only: no case mapping by locale, and no date pattern to be run.
    month = F.translate(F.substring(cell, -8, 3), string.ascii_uppercase, string.ascii_lowercase)
    at = F.instr(F.lit(_MONTHS), month) + 2
    iso = F.concat_ws("-", F.right(cell, F.lit(4)), F.floor(at / 3).cast("string"), F.substring_index(cell, "-", 1))
    return F.when(cell.rlike(_SEC_SHAPE), F.when((at > 2) & (at % 3 == 0), iso.try_cast("date")))


def sec_date_broken(cell: Column, day: Column) -> Column:
    return day.isNull() & (cell != "")


def xml_date(cell: Column) -> Column:
    """First ten characters of an XML date; a zone suffix does not move the day."""
    day = F.substring(cell, 1, 10)
    return F.when(day.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), day.try_cast("date"))


def xml_date_broken(cell: Column) -> Column:
    """True where a present cell is no date."""
    return cell.isNotNull() & xml_date(cell).isNull()


def _dashed(cell: Column) -> Column:
    """The leading `20260911` as `2026-09-11`."""
    dash = F.lit("-")
    return F.concat(F.substring(cell, 1, 4), dash, F.substring(cell, 5, 2), dash, F.substring(cell, 7, 2))


def compact_date(cell: Column) -> Column:
    """`20260911` as a date."""
    return F.when(cell.rlike(r"^[0-9]{8}$"), _dashed(cell).try_cast("date"))


def end_of_day_new_york(day: Column) -> Column:
    """23:59:59.999 in New York on `day`, as a UTC instant (the session zone is UTC)."""
    midnight = F.to_utc_timestamp(F.date_add(day, 1).cast("timestamp"), NEW_YORK)
    return midnight - F.expr("interval 1 millisecond")


def acceptance_instant(cell: Column) -> Column:
    """`yyyyMMddHHmmss` New York clock time as a UTC instant."""
    colon = F.lit(":")
    clock = F.concat(
        _dashed(cell), F.lit(" "), F.substring(cell, 9, 2), colon, F.substring(cell, 11, 2), colon, F.substring(cell, 13, 2)
    )
    return F.when(
        cell.rlike(r"^[0-9]{14}$"), F.to_utc_timestamp(clock.try_cast("timestamp"), NEW_YORK)
    )


def available_after(accepted: Column) -> Column:
    return accepted + F.expr(ACCEPTANCE_DELAY)


def available_year(instant: Column) -> Column:
    """UTC year of an instant: the lake's shard."""
    return F.year(instant)


def utc_day(instant: Column) -> Column:
    return F.to_date(instant)
