"""Rewriting of raw delimited lines."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unquoted line prefixes that contain commas in known source files.
KNOWN_PREFIXES = (
    "In Foreclosure, Presale",
    "In Foreclosure, Postsale",
    "CRA, House America",
    "Interest Only, other than monthly",
    "Interest Only, monthly",
    'Second Lien Home Equity Line of Credit, Grade "B" or "C"',
    'First Lien Home Equity Line of Credit, Grade "B" or "C"',
    'Second Mortgage (Home Equity Loan), Grade "B" or "C"',
    'First Mortgage, Grade "B" or "C"',
)


def lines_of(text: Column) -> Column:
    """Array of the lines of a text. A final newline ends the last line, it starts no new one."""
    parts = F.split(F.regexp_replace(text, "\n\\z", ""), "\n")
    return F.when(text == "", F.array().cast("array<string>")).otherwise(parts)


def line_count(text: Column, newlines_only: bool = False) -> Column:
    """A1: lines of a text. ``newlines_only`` counts newline characters instead."""
    newlines = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit("")))
    if newlines_only:
        return newlines.cast("long")
    open_end = (text != "") & ~text.endswith("\n")
    return (newlines + open_end.cast("int")).cast("long")


def requote(line: Column, delimiter: str = ",", new_delimiter: str = ",") -> Column:
    """Double bare quotes in a quoted line and change the delimiter between its fields: between
    the outer quotes the line is taken apart where quoted fields meet, each field is escaped, and
    the fields are put together again."""
    opens = line.startswith('"')
    closes = line.endswith('"') & (F.length(line) > opens.cast("int"))
    inner = F.substring(line, opens.cast("int") + 1, F.length(line) - opens.cast("int") - closes.cast("int"))
    fields = F.transform(F.split(inner, re.escape(f'"{delimiter}"'), -1), lambda f: F.replace(f, F.lit('"'), F.lit('""')))
    edge = {side: F.when(there, '"').otherwise("") for side, there in (("left", opens), ("right", closes))}
    return F.concat(edge["left"], F.array_join(fields, f'"{new_delimiter}"'), edge["right"])


def requote_where_it_fits(line: Column, delimiter: str, fields: int) -> Column:
    """P8 inside a load: the line with its bare quotes doubled, if it then has the expected fields."""
    doubled = requote(line, delimiter, delimiter)
    return F.when(line.startswith('"') & (field_count(doubled, delimiter) == fields), doubled).otherwise(line)


def quote_prefixes(line: Column, prefixes: Sequence[str] = KNOWN_PREFIXES) -> Column:
    """Put quotes around a listed prefix at the start of a line, doubling quotes inside it.

    A quoted line starts with a quote, so no later prefix can match it: the first match decides.
    """
    out = line
    for prefix in reversed(prefixes):
        doubled = prefix.replace('"', '""')
        rest = F.substring(line, F.lit(len(prefix) + 1), F.length(line))
        out = F.when(
            line.startswith(prefix), F.concat(F.lit(f'"{doubled}"'), rest)
        ).otherwise(out)
    return out


def field_count(line: Column, delimiter: str = ",", quote: str = '"') -> Column:
    """Fields of a delimited line; delimiters inside quotes do not count."""
    q, d = re.escape(quote), re.escape(delimiter)
    bare = F.regexp_replace(line, f"{q}[^{q}]*{q}", "")
    return (F.size(F.split(bare, d, -1))).cast("long")


def prefixed(line: Column, file_id: Column, delimiter: str = ",") -> Column:
    """P1 on raw lines: the quoted file id as first field."""
    return F.concat(F.lit('"'), file_id.cast("string"), F.lit('"' + delimiter), line)
