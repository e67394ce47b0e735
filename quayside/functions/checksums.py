"""MD5 over lines and rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unit separator between columns, and the mark of a NULL.
FIELD_SEPARATOR = "\u001f"
NULL_MARK = "\u0000"


def line_crc(line: Column) -> Column:
    """MD5 of a line without its newline."""
    return F.md5(line)


def row_crc(columns: Sequence[str | Column]) -> Column:
    """MD5 over columns in the given order.

    A separator and a NULL mark keep ('a', NULL) and (NULL, 'a') apart, which plain ``concat_ws``
    would not.
    """
    cols = [F.col(c) if isinstance(c, str) else c for c in columns]
    texts = [F.coalesce(c.cast("string"), F.lit(NULL_MARK)) for c in cols]
    return F.md5(F.concat_ws(FIELD_SEPARATOR, *texts))
