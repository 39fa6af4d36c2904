"""Reading text cells: trimming, numbers, flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as white space in the inputs (tab, line ends, no-break space,
# the Unicode space separators, byte order mark).
SPACES = (
    "\t\n\x0b\x0c\r \u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000\ufeff"
)
SPACE_CLASS = f"[{SPACES}]"

_DECIMAL = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
_RADIX = {16: r"^0[xX][0-9a-fA-F]+$", 8: r"^0[oO][0-7]+$", 2: r"^0[bB][01]+$"}


def trimmed(cell: Column) -> Column:
    """Both ends stripped of every space character, absent cells as empty text.

    Most cells need no more than the plain trim: the general one, which looks each character
    up, only runs where an end is neither a printable ASCII character nor past it by little.
    """
    plain = F.trim(F.coalesce(cell, F.lit("")))
    usual = F.ascii(plain).between(33, 126) & F.ascii(F.substring(plain, -1, 1)).between(33, 126)
    return F.when((plain == "") | usual, plain).otherwise(F.btrim(plain, F.lit(SPACES)))


def present(cell: Column) -> Column:
    """A trimmed cell, blank as null."""
    return F.when(cell != "", cell)


def text(cell: Column) -> Column:
    """Trimmed text, blank as null."""
    return present(trimmed(cell))


def nested_text(cell: Column) -> Column:
    """`text` for cells inside a lambda, where nothing shares parts: each part is computed once, and none of an absent cell."""

    def of_plain(plain: Column) -> Column:
        usual = F.ascii(plain).between(33, 126) & F.ascii(F.substring(plain, -1, 1)).between(33, 126)
        return F.when(plain != "", F.when(usual, plain).otherwise(present(F.btrim(plain, F.lit(SPACES)))))

    return F.when(cell.isNotNull(), F.get(F.transform(F.array(F.trim(cell)), of_plain), F.lit(0)))


def compact(cell: Column) -> Column:
    """Text with all white space removed, upper case, blank as null."""
    return present(F.upper(F.translate(F.coalesce(cell, F.lit("")), SPACES, "")))


def without_commas(cell: Column) -> Column:
    """A trimmed cell without thousands separators."""
    return F.when(
        cell.contains(","), trimmed(F.replace(cell, F.lit(","), F.lit("")))
    ).otherwise(cell)


def parse_number(cell: Column) -> Column:
    """A trimmed cell as a double; null when blank or no number. May overflow to infinity."""
    value = F.when(cell == "", F.lit(None).cast("double")).when(
        cell.rlike(_DECIMAL), cell.try_cast("double")
    )
    for radix, shape in _RADIX.items():
        value = value.when(cell.rlike(shape), _radix_number(cell, radix))
    return value


def _radix_number(cell: Column, radix: int) -> Column:
    """Digits behind a two-letter prefix, however many: the leading ones that fit 64 bits, scaled by the rest."""
    fitting = {16: 16, 8: 21, 2: 64}[radix]
    digits = F.ltrim(F.substr(cell, F.lit(3)), F.lit("0"))
    head = F.conv(F.concat(F.lit("0"), F.substring(digits, 1, fitting)), radix, 10).try_cast("double")
    return head * F.pow(F.lit(float(radix)), F.greatest(F.length(digits) - fitting, F.lit(0)))


def number_broken(cell: Column, value: Column) -> Column:
    """True where a non-blank trimmed cell gave no finite number."""
    return (cell != "") & (value.isNull() | (F.abs(value) == float("inf")))


def number(cell: Column) -> Column:
    """A trimmed cell as a finite double, else null."""
    value = parse_number(cell)
    return F.when(F.abs(value) != float("inf"), value)


def yes_no(cell: Column) -> Column:
    """Y or N in any case; anything else is unknown."""
    letter = F.upper(cell)
    return F.when(letter == "Y", F.lit(True)).when(letter == "N", F.lit(False))


def flag(cell: Column) -> Column:
    """1/true, 0/false in any case; anything else is unknown."""
    word = F.lower(cell)
    # The usual spellings need no case mapping.
    return (
        F.when(cell.isin("1", "true"), F.lit(True))
        .when(cell.isin("0", "false", ""), F.when(cell != "", F.lit(False)))
        .when(word == "true", F.lit(True))
        .when(word == "false", F.lit(False))
    )


def listed(cell: Column, code: str) -> Column:
    """Whether a comma-separated list names `code`, ignoring case and white space."""
    codes = F.concat(F.lit(","), F.coalesce(compact(cell), F.lit("")), F.lit(","))
    return F.contains(codes, F.lit(f",{code},"))
