"""File paths, file names and the dates and table names found in them."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from quayside.functions.names import snake_column

# Database date tokens and Spark's letters for them, longest first.
DATE_TOKENS = (
    ("YYYY", "yyyy"), ("YY", "yy"), ("MONTH", "MMMM"), ("MON", "MMM"), ("MM", "MM"),
    ("DDD", "DDD"), ("DD", "dd"), ("HH24", "HH"), ("HH12", "hh"), ("HH", "hh"),
    ("MI", "mm"), ("SS", "ss"),
)


def directory(path: Column) -> Column:
    return F.regexp_extract(path, "^(.*)/([^/]*)$", 1)


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, "([^/]*)$", 1)


def extension(name: Column) -> Column:
    """Upper-case text after the last dot; the whole name when it has none."""
    return F.upper(F.element_at(F.split(name, "\\."), -1))


def java_regex(pattern: str) -> str:
    """A configured pattern as Java reads it; dialect parts Java would misread are refused."""
    if "(?P" in pattern or "\\Z" in pattern:
        raise ValueError(f"pattern uses syntax Java regular expressions lack: {pattern}")
    re.compile(pattern)
    return pattern


def matches(text: Column, pattern: str, ignore_case: bool = False) -> Column:
    """match anchored at the start, open at the end."""
    flag = "(?i)" if ignore_case else ""
    return text.rlike(f"{flag}^(?:{java_regex(pattern)})")


def extract(text: Column, pattern: str) -> Column:
    """First match of a pattern, its group 1 when it has a group, NULL when nothing matches."""
    pattern = java_regex(pattern)
    found = F.regexp_extract(text, pattern, 1 if re.compile(pattern).groups else 0)
    return F.when(text.rlike(pattern), found)


def date_pattern(fmt: str) -> str:
    """``YYYY-MM-DD`` as ``yyyy-MM-dd``."""
    out, rest = "", fmt
    while rest:
        for token, letters in DATE_TOKENS:
            if rest.upper().startswith(token):
                out, rest = out + letters, rest[len(token):]
                break
        else:
            out, rest = out + (f"'{rest[0]}'" if rest[0].isalpha() else rest[0]), rest[1:]
    return out


def file_date(name: Column, pattern: str, fmt: str | None = None) -> Column:
    """A tag from the file name, as ISO date text when a format is given."""
    tag = extract(name, pattern)
    if fmt is None:
        return tag
    return F.to_date(F.try_to_timestamp(tag, F.lit(date_pattern(fmt)))).cast("string")


def table_from_name(name: Column, pattern: str | None = None) -> Column:
    """Group 1 of the pattern, or the whole name, in snake case."""
    return snake_column(name if pattern is None else extract(name, pattern))
