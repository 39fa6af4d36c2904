"""Regex matches with their places, in DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Non-characters of Unicode mark a match inside a text; a text that holds them has them replaced first.
_OPEN, _CLOSE, _OTHER = "﷐", "﷑", "�"
SPAN = "ARRAY<STRUCT<start: INT, end: INT, value: STRING>>"
# Matches folded into one list before the lists are put together.
SLICE = 256


def clean(text: Column) -> Column:
    """The text, null as empty, as long as before and free of the marks. Few texts hold any to translate."""
    full = F.coalesce(text, F.lit(""))
    marked = F.contains(full, F.lit(_OPEN)) | F.contains(full, F.lit(_CLOSE))
    return F.when(marked, F.translate(full, _OPEN + _CLOSE, _OTHER + _OTHER)).otherwise(full)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once, however often `body` uses it."""
    return F.transform(F.array(value), body)[0]


def _placed(pieces: Column) -> Column:
    """Spans of the pieces of a cut text: every piece but the first begins with a match and its closing mark.

    An array that grows in a fold is copied at each step, so pieces are folded by slices, whose
    lists are flattened at the end.
    """

    def add(state: Column, piece: Column) -> Column:
        value = F.substring_index(piece, _CLOSE, 1)
        end = state["at"] + F.length(value)
        found = F.struct(state["at"].alias("start"), end.alias("end"), value.alias("value"))
        return F.struct((state["at"] + F.length(piece) - 1).alias("at"), F.concat(state["found"], F.array(found)).alias("found"))

    def block(state: Column, first: Column) -> Column:
        begin = F.struct(state["at"].alias("at"), F.array().cast(SPAN).alias("found"))
        return F.aggregate(
            F.slice(pieces, first, F.lit(SLICE)),
            begin,
            add,
            lambda part: F.struct(part["at"].alias("at"), F.concat(state["found"], F.array(part["found"])).alias("found")),
        )

    firsts = F.sequence(F.lit(2), F.greatest(F.size(pieces), F.lit(2)), F.lit(SLICE))
    start = F.struct(F.length(pieces[0]).alias("at"), F.array().cast(f"ARRAY<{SPAN}>").alias("found"))
    return F.aggregate(firsts, start, block, lambda state: F.flatten(state["found"]))


def matches(text: Column, pattern: str, guard: Column | None = None) -> Column:
    """Leftmost non-overlapping matches of a cleaned text as (start, end, value), in code points, end exclusive.

    Every match is put between marks, the text is cut at them, and the lengths of the cuts give the
    places. `guard` is a cheap condition without which nothing can match.
    """
    pieces = F.split(F.regexp_replace(text, pattern, f"{_OPEN}$0{_CLOSE}"), _OPEN)
    none = F.array().cast(SPAN)
    found = let(pieces, _placed)
    possible = text.rlike(pattern) if guard is None else guard & text.rlike(pattern)
    return F.when(possible, found).otherwise(none)


def joined(spans: Column) -> Column:
    """kind:start:end of an array of structs with these fields, comma-joined in the order given."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
