"""Raw lines of files with their numbers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quayside.functions import text
from quayside.operators.skew import fits_broadcast
from quayside.sources.storage import metadata_path


def read_lines(
    spark: SparkSession, files: str | Sequence[str], keep_cr: bool = False, encoding: str = "UTF-8"
) -> DataFrame:
    """Lines with the file and block they come from, and a slot that follows the line order.

    ``keep_cr`` splits at newlines only, so that a carriage return stays visible (P10). Spark splits
    the bytes and takes them as UTF-8; another encoding is decoded here.
    """
    reader = spark.read.option("recursiveFileLookup", "true").option("encoding", encoding)
    if keep_cr:
        reader = reader.option("lineSep", "\n")
    return reader.text(files).select(
        metadata_path().alias("path"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_slot"),
        decoded(F.col("value"), encoding).alias("line"),
    )


def decoded(value: Column, encoding: str) -> Column:
    """A text whose bytes Spark took as UTF-8, in its own encoding."""
    return value if encoding.upper() in ("UTF-8", "UTF8") else F.decode(value.cast("binary"), encoding)


def number_lines(lines: DataFrame) -> DataFrame:
    """0-based line numbers of split files without a window over a file.

    Each (file, block) is counted; prefix sums over the blocks of a file give the lines before a
    block; inside a block the slot gives the order. The block table has one row per input split:
    it is broadcast when counted small, else joined by (file, block), where no group exceeds a split.
    """
    blocks = lines.groupBy("path", "_block").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_slot").alias("_first")
    )
    before = Window.partitionBy("path").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(
        "path", "_block",
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
    )
    if fits_broadcast(blocks):
        blocks = F.broadcast(blocks)
    return lines.join(blocks, ["path", "_block"]).select(
        "path", (F.col("_slot") + F.col("_shift")).alias("line_no"), "line"
    )


def data_lines(
    numbered: DataFrame, header_row: int = 0, has_header: bool = True, limit_rows: int | None = None
) -> DataFrame:
    """Lines after the header row, at most ``limit_rows`` of each file (F15: exactly that
    many); ``row_no`` counts data lines from 0."""
    start = header_row + 1 if has_header else header_row
    rows = numbered.withColumn("row_no", F.col("line_no") - start).filter("row_no >= 0")
    return rows if limit_rows is None else rows.filter(F.col("row_no") < limit_rows)


def lines_per_file(lines: DataFrame) -> DataFrame:
    """A1: lines of each file."""
    return lines.groupBy("path").agg(F.count(F.lit(1)).alias("lines"))


def line_endings(heads: DataFrame, delimiter: str = ",", header_row: int = 0) -> DataFrame:
    """P10: whether the first line of a file ends in a carriage return, and whether its header is
    quoted. ``heads`` come from ``head_lines(keep_cr=True)``, which reads no more than is needed."""
    return heads.filter(F.col("line_no") <= header_row).groupBy("path").agg(
        F.max(F.when(F.col("line_no") == 0, F.col("line").endswith("\r"))).alias("windows"),
        F.coalesce(
            F.max(F.when(F.col("line_no") == header_row, F.col("line").contains(f'"{delimiter}"'))),
            F.lit(False),
        ).alias("quoted_header"),
    )


def column_counts(
    numbered: DataFrame, delimiter: str = ",", header_row: int = 0, sample_size: int | None = 200
) -> DataFrame:
    """A4: median number of fields over the first ``sample_size`` data lines of each file (all
    lines for None). ``numbered`` are numbered lines; for a sample, ``head_lines`` gives them
    without reading whole files."""
    rows = data_lines(numbered, header_row, True, sample_size)
    return rows.groupBy("path").agg(
        F.median(text.field_count(F.col("line"), delimiter)).cast("int").alias("column_count")
    )


def header_columns(
    table_columns: Sequence[str], file_columns: int, append_file_id: bool, append_crc: bool
) -> list[str]:
    """The header of rewritten lines: the added columns, then the table's own by position. When
    the table has more columns than the file, the trailing ones are left out; fewer is an error."""
    added = (["file_id"] if append_file_id else []) + (["crc"] if append_crc else [])
    own = [c for c in table_columns if c not in ("file_id", "crc")]
    if len(own) < file_columns:
        raise ValueError(f"file has {file_columns} columns, table {len(own)}")
    return added + own[:file_columns]


def rewrite_lines(
    lines: DataFrame, catalog: DataFrame | None, append_crc: bool, delimiter: str = ","
) -> DataFrame:
    """Put the file id and the line checksum in front of each data line."""
    out = F.col("line")
    if append_crc:
        out = F.concat(F.md5("line"), F.lit(delimiter), out)
    if catalog is not None:
        from quayside.operators.skew import lookup_join

        lines = lookup_join(lines, catalog.select("path", "file_id"), ["path"])
        out = text.prefixed(out, F.col("file_id"), delimiter)
    return lines.withColumn("line", out)
