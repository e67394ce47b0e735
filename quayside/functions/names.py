"""Snake-case names, for schemas on the driver and for columns of names."""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters turned into "_" one after the other, in this order (P5).
NAME_TAGS = (" ", "(", ".", ")", "$", "-", "~", "?", "{", "}", "\\", "/", ":", "___", "__")

# Replacements for header lists, in this order.
LIST_TAGS = (
    ("   ", " "), ("  ", " "), (" ", "_"), ("\\", "_"), ("/", "_"),
    (":", "_"), ("'", "_"), ("(", "_"), (")", "_"),
)

# Fixed value: collation clause removed from generated DDL.
COLLATION = 'COLLATE "SQL_Latin1_General_CP1_CI_AS"'

# Camel-case boundaries: the end of an acronym, and lower case or digit before upper case.
# Where a capital starts a new word.
_BOUNDARIES = ("([A-Z]+)([A-Z][a-z])", "([a-z0-9])([A-Z])")


def underscore(text: str) -> str:
    """``LoanID`` as ``loan_id``; dashes become underscores."""
    for pattern in _BOUNDARIES:
        text = re.sub(pattern, r"\1_\2", text)
    return text.replace("-", "_").lower()


def snake_name(text: str) -> str:
    """P5: one name in snake case. A leading blank becomes ``_``."""
    return reduce(lambda t, tag: t.replace(tag, "_"), NAME_TAGS, underscore(text)).strip()


def snake_names(names: Iterable[str]) -> list[str]:
    """A header list in snake case, with its own replacements."""
    return [
        reduce(lambda t, pair: t.replace(*pair), LIST_TAGS, underscore(n)).lower() for n in names
    ]


def snake_ddl(sql: str, columns: Iterable[str]) -> str:
    """DDL text with the given column names, where they stand as whole names, in snake case; all
    lower case."""
    renamed = {c: re.sub(r"[ ()]", "_", underscore(c)) for c in columns}
    text = re.sub(re.escape(COLLATION), "", sql)
    if renamed:
        longest_first = sorted(renamed, key=len, reverse=True)
        whole_name = r"(?<!\w)(?:" + "|".join(map(re.escape, longest_first)) + r")(?!\w)"
        text = re.sub(whole_name, lambda m: renamed[m.group()], text)
    return re.sub(r"\) ,", "),", text).lower()


def snake_column(name: Column) -> Column:
    """P5 on a column of names, with built-in functions."""
    for pattern in _BOUNDARIES:
        name = F.regexp_replace(name, pattern, "$1_$2")
    name = F.lower(F.replace(name, F.lit("-"), F.lit("_")))
    for tag in NAME_TAGS:
        name = F.replace(name, F.lit(tag), F.lit("_"))
    return F.trim(name)


def column_list(text: str | None) -> list[str] | None:
    """A configured column list: blanks and newlines dropped, split on commas."""
    if text is None or text == "None":
        return None
    return text.replace(" ", "").replace("\n", "").split(",")
