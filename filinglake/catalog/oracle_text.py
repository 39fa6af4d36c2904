"""Pieces of oracle SQL used by several queries."""

from __future__ import annotations


def day(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d')"


def instant(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%dT%H:%M:%S.%g') || 'Z'"


def eod(x: str) -> str:
    """End of day in New York of a date, as ISO text in UTC."""
    return instant(
        f"((({x}) + 1)::TIMESTAMP AT TIME ZONE 'America/New_York') AT TIME ZONE 'UTC' - INTERVAL 1 MILLISECOND"
    )


def placeholder_words() -> str:
    return "('NONE','N/A','NA','N.A.','NULL','NIL','NOT APPLICABLE','NOT TRADED','-','--')"


def ticker(symbol: str) -> str:
    """The joinable symbol of a filer's text, written as one SQL expression."""
    raw = f"trim(coalesce({symbol}, ''))"
    plain = (
        f"replace(regexp_replace(translate(upper({raw}), '\"()[]*', '      '), '([A-Z])''([A-Z])$', '\\1.\\2'), '''', '')"
    )
    cleaned = f"trim(list_extract(string_split({plain}, ':'), -1))"
    words = f"list_filter(regexp_split_to_array({cleaned}, '\\s*(?:,|;|&|\\bAND\\b|\\s)\\s*'), lambda w: w <> '')"
    tokens = (
        f"flatten(list_transform({words}, lambda w: CASE WHEN len(string_split(w, '/')) = 2"
        f" AND length(string_split(w, '/')[2]) <= 2 THEN [w] ELSE string_split(w, '/') END))"
    )
    shape = "'[A-Z]{1,5}([.\\-/][A-Z0-9]{1,2})?'"
    joined = f"array_to_string({tokens}, '')"
    return f"""CASE WHEN regexp_full_match({raw}, '[A-Z]{{1,5}}[a-z]') THEN {raw}
        WHEN {cleaned} = '' OR {cleaned} IN {placeholder_words()} THEN NULL
        WHEN len({tokens}) > 1 AND len(list_filter({tokens}, lambda t: NOT regexp_full_match(t, '[A-Z]'))) = 0
        THEN CASE WHEN regexp_full_match({joined}, {shape}) THEN {joined} END
        ELSE list_extract(list_filter({tokens}, lambda t: regexp_full_match(t, {shape}) AND t NOT IN {placeholder_words()}), 1) END"""


def upper_median(x: str) -> str:
    return f"list_extract(list_sort(list({x})), 1 + CAST(floor(count({x}) / 2) AS INT))"


def floor_quantile(x: str, q: float) -> str:
    return f"list_extract(list_sort(list({x})), 1 + CAST(least(count({x}) - 1, floor({q} * count({x}))) AS INT))"
