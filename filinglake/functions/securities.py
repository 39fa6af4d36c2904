"""Security identifiers and the free-text trading symbol."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from filinglake.functions.text import SPACE_CLASS, trimmed

# Shapes and words of the symbol field.
SYMBOL = r"^[A-Z]{1,5}([.\-/][A-Z0-9]{1,2})?$"
CLASS_SUFFIX = r"^[A-Z]{1,5}[a-z]$"
NO_SYMBOL = (
    "NONE", "N/A", "NA", "N.A.", "NULL", "NIL", "NOT APPLICABLE", "NOT TRADED", "-", "--",
)
# A symbol that no separator cuts.
_ONE_TOKEN = rf"^(?!AND\b){SYMBOL[1:-1]}\z"
_SEPARATOR = rf"{SPACE_CLASS}*(?:,|;|&|\bAND\b|{SPACE_CLASS}){SPACE_CLASS}*"


def _slash_parts(token: Column) -> Column:
    """Symbols of a token with slashes: one where exactly two parts end in a class of up to two letters, else each part."""
    parts = F.split(token, "/")
    one_symbol = (F.size(parts) == 2) & (F.length(F.get(parts, F.lit(1))) <= 2)
    return F.when(one_symbol, F.array(token)).otherwise(parts)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once, however often `body` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _cleaned(raw: Column) -> Column:
    """Upper case, without brackets, quotes and venue; an apostrophe may separate the class."""
    # Most are upper case already, which is told faster than made.
    upper = F.when(raw.rlike("[^ -`{-~]"), F.upper(raw)).otherwise(raw)
    plain = F.regexp_replace(F.translate(upper, '"()[]*', " " * 6), r"([A-Z])'([A-Z])$", "$1.$2")
    return trimmed(F.substring_index(F.replace(plain, F.lit("'")), ":", -1))


def _tokens(cleaned: Column) -> Column:
    words = F.filter(F.split(cleaned, _SEPARATOR), lambda word: word != "")
    return F.flatten(F.transform(words, _slash_parts))


def _pick(tokens: Column) -> Column:
    """The joined letters of a spelled-out symbol, else the first token that is a symbol."""
    spelled = F.array_join(tokens, "")
    is_spelled = (F.size(tokens) > 1) & F.forall(tokens, lambda t: t.rlike("^[A-Z]$"))
    symbols = F.filter(tokens, lambda t: t.rlike(SYMBOL) & ~t.isin(*NO_SYMBOL))
    return F.when(is_spelled, F.when(spelled.rlike(SYMBOL), spelled)).otherwise(
        F.get(symbols, F.lit(0))
    )


def issuer_ticker(filed: Column) -> Column:
    """The one joinable symbol in a filer's free text, or null when it names none."""

    def of_cleaned(cleaned: Column) -> Column:
        named = (cleaned != "") & ~cleaned.isin(*NO_SYMBOL)
        return F.when(named, F.when(cleaned.rlike(_ONE_TOKEN), cleaned).otherwise(_let(_tokens(cleaned), _pick)))

    def of_raw(raw: Column) -> Column:
        return F.when(raw.rlike(CLASS_SUFFIX), raw).otherwise(_let(_cleaned(raw), of_cleaned))

    return _let(trimmed(filed), of_raw)


def cusip_of_isin(isin: Column) -> Column:
    """The CUSIP inside a US ISIN; null for any other ISIN."""
    return F.when((F.length(isin) == 12) & isin.startswith("US"), F.substring(isin, 3, 9))


def placeholder_cusip(cusip: Column) -> Column:
    """Not nine characters, or nothing but zeroes or nines: no identified security."""
    return (F.length(cusip) != 9) | cusip.rlike("^(0+|9+)$")
