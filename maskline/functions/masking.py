"""Positional, pattern, class and delimiter masks; skip guard; file stems and tag text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .binding import bind

#: Month and day of an eight-digit date.
DATE_POSITIONS = (5, 6, 7, 8)


def trimmed(value: Column) -> Column:
    """value without white space (of any script) at either end."""
    ends = r"(?U)^\s|\s$"
    return F.when(value.rlike(ends), F.regexp_replace(value, r"(?U)^\s+|\s+$", "")).otherwise(value)


def skip_clean(clean: Column) -> Column:
    """skip_value of a value that is trimmed already."""
    return clean.isNull() | F.lower(clean).isin("", "nan")


def skip_value(value: Column) -> Column:
    return bind(trimmed(value), skip_clean)


def mask_positions(value: Column, positions: tuple[int, ...], char: str) -> Column:
    """value with char at the 1-based positions that it has."""
    one = lambda v, p: F.when(F.length(v) >= p, F.overlay(v, F.lit(char), p, 1)).otherwise(v)
    return reduce(one, positions, value)


def mask_date(value: Column) -> Column:
    return mask_positions(value, DATE_POSITIONS, "0")


def mask_pattern(value: Column, pattern: str, char: str = "*") -> Column:
    """Every match of pattern replaced by char, as long as the match; classes are Unicode's."""
    pattern = "(?U)" + pattern
    between, found = F.split(value, pattern, -1), F.regexp_extract_all(value, F.lit(pattern), F.lit(0))
    padded = F.concat(found, F.array(F.lit("")))
    return F.array_join(F.zip_with(between, padded, lambda a, m: F.concat(a, F.repeat(F.lit(char), F.length(m)))), "")


def scrub(value: Column, patterns: list[str], char: str = "*") -> Column:
    """value with every match of each pattern masked, pattern after pattern; each step's result is computed once."""

    def step(pattern: str):
        return lambda v: F.when(v.rlike("(?U)" + pattern), mask_pattern(v, pattern, char)).otherwise(v)

    return reduce(lambda v, p: bind(v, step(p)), patterns, value)


def mask_class(value: Column, digit: str, letter: str) -> Column:
    return F.regexp_replace(F.regexp_replace(value, r"\p{Nd}", digit), r"\p{L}", letter)


def mask_around(value: Column, delimiter: str, length: int, after: bool, char: str = "*") -> Column:
    """length characters after (or before) every delimiter masked, delimiters of one character; parts in between as they are."""
    parts = F.split(value, "\\Q" + delimiter + "\\E", -1)
    n = F.size(parts)
    stars = lambda c, k: F.repeat(F.lit(char), F.least(F.length(c), F.lit(k)))

    def one(part, i):
        if after:
            return F.when(i == 0, part).otherwise(F.concat(stars(part, length), F.substring(part, length + 1, 2**30)))
        keep = F.greatest(F.length(part) - length, F.lit(0))
        return F.when(i == n - 1, part).otherwise(F.concat(F.substring(part, F.lit(1), keep), stars(part, length)))

    return F.array_join(F.transform(parts, one), delimiter)


def derived_pattern(kind: str, left: str, right: str = "") -> str:
    """A pattern whose first group lies before, after or in between given marks (regular expressions)."""
    return {"before": f"^(.+?){left}", "after": f"{left}(.+)$", "in_between": f"{left}(.+?){right}"}[kind]


def safe_stem(name: Column) -> Column:
    stem = F.substring(F.regexp_replace(name, "[^A-Za-z0-9_-]", "_"), 1, 64)
    return F.when(stem == "", "file").otherwise(stem)


def tag_text(grp: Column, elem: Column) -> Column:
    return F.format_string("%04X,%04X", grp, elem)


def parse_tag(text: Column, part: int) -> Column:
    """Group (1) or element (2) of a printed tag such as (0010,0020); null where it is none."""
    found = F.regexp_extract(text, r"^\(?([0-9A-Fa-f]{4}),\s*([0-9A-Fa-f]{4})\)?$", part)
    return F.when(found != "", F.conv(found, 16, 10).cast("int"))


def column_key(keyword: Column, grp: Column, elem: Column) -> Column:
    return F.coalesce(F.nullif(keyword, F.lit("")), F.format_string("%04X%04X", grp, elem))


def python_round_index(n: Column, q: float) -> Column:
    """Half-even rounded index q(n-1), at most n-1, from 0."""
    return F.least(n - 1, F.bround(F.lit(q) * (n - 1)).cast("int"))
