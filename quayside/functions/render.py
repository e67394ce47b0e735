"""Rows as JSON, HTML, Markdown and padded text, one text column per row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: how a missing value prints.
NULL_TEXT = "None"


def as_text(column: Column | str) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column.cast("string"), F.lit(NULL_TEXT))


def json_row(columns: Sequence[str]) -> Column:
    """K6: the values of a row as a JSON array of texts."""
    return F.to_json(F.array(*[as_text(c) for c in columns]))


def escape_html(text: Column) -> Column:
    for raw, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(raw), F.lit(entity))
    return text


def html_row(columns: Sequence[str]) -> Column:
    """K7: a table row; the text of cells is escaped."""
    cells = [F.concat(F.lit("<td>"), escape_html(as_text(c)), F.lit("</td>")) for c in columns]
    return F.concat(F.lit("<tr>"), *cells, F.lit("</tr>"))


def html_header(names: Sequence[str], sortable: Sequence[int] = ()) -> str:
    """K7: header cells, the chosen ones marked for sorting."""
    return "".join(
        f'<th data-sort="string">{n}</th>' if i in sortable else f"<th>{n}</th>"
        for i, n in enumerate(names)
    )


def markdown_row(columns: Sequence[str]) -> Column:
    """K8: ``| a | b |``."""
    return F.concat(F.lit("| "), F.concat_ws(" | ", *[as_text(c) for c in columns]), F.lit(" |"))


def markdown_header(names: Sequence[str]) -> list[str]:
    return ["| " + " | ".join(names) + " |", "|" + "-------------- | " * len(names)]


def padded(column: str | Column, width: int | Column, justify: str = "r", fill: str = " ") -> Column:
    """K9: text filled up to a width; longer text is kept whole, where ``lpad`` would cut it."""
    text = as_text(column)
    width = F.lit(width) if isinstance(width, int) else width
    gap = F.greatest(width - F.length(text), F.lit(0))
    if justify == "c":
        left = F.floor(gap / 2) + gap.bitwiseAND(width).bitwiseAND(F.lit(1))
    else:
        left = gap if justify == "r" else F.lit(0)
    left = left.cast("int")
    return F.concat(F.repeat(F.lit(fill), left), text, F.repeat(F.lit(fill), (gap - left).cast("int")))


def padded_row(columns: Sequence[str], widths: Sequence[int], justify: str = "r") -> Column:
    """K9: all columns of a row, each one wider than its width by one."""
    return F.concat(*[padded(c, w + 1, justify) for c, w in zip(columns, widths, strict=True)])


def text_widths(df: DataFrame) -> DataFrame:
    """Narrowest and widest text of each column; one aggregate over one scan."""
    def width(column: str, pick) -> Column:
        return pick(F.length(as_text(column))).cast("long")

    per_column = [
        F.struct(F.lit(c).alias("column_name"), width(c, F.min).alias("min_width"), width(c, F.max).alias("max_width"))
        for c in df.columns
    ]
    return df.agg(F.array(*per_column).alias("w")).select(F.inline("w"))
