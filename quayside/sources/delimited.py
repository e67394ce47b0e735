"""Delimited files as text columns."""

from __future__ import annotations

import csv
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.functions import text
from quayside.functions.names import column_list, snake_name
from quayside.session import durable
from quayside.sources import lines as raw
from quayside.sources.records import INSIDE, TURNS, line_effect, record_counts, records
from quayside.sources.storage import head_lines, metadata_path

# Texts a pandas reader takes as missing.
PANDAS_NULLS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
# Names of encodings in configurations and Spark's names for them.
ENCODINGS = {"UTF8": "UTF-8", "LATIN1": "ISO-8859-1"}
# Stands for a quoted empty text while reading.
QUOTED_EMPTY = "\u0001"


def text_schema(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def spark_encoding(name: str) -> str:
    return ENCODINGS.get(name.upper(), name)


def clean_nulls(column: Column, nulls: str) -> Column:
    """F7. ``pandas``: a list of tokens is missing. ``copy``: only a bare empty text is.
    ``force_null``: an empty text is missing, quoted or not."""
    if nulls == "pandas":
        return F.when(~column.isin(QUOTED_EMPTY, *PANDAS_NULLS), column)
    if nulls == "force_null":
        return F.when(column != QUOTED_EMPTY, column)
    if nulls == "copy":
        return F.when(column == QUOTED_EMPTY, F.lit("")).otherwise(column)
    raise ValueError(f"unknown null rule {nulls}")


def header_names(
    spark: SparkSession, file: str, delimiter: str = ",", header_row: int = 0, encoding: str = "UTF8"
) -> list[str]:
    """Column names in snake case from the header line of one file (one short read)."""
    head = spark.read.text(file).limit(header_row + 1).select(raw.decoded(F.col("value"), spark_encoding(encoding)))
    return split_header(head.collect()[header_row][0].rstrip("\r"), delimiter)


def split_header(line: str, delimiter: str = ",") -> list[str]:
    return [snake_name(n) for n in next(csv.reader([line], delimiter=delimiter))]


def parse_list(value: str | None) -> list[str] | None:
    return column_list(value)


def choose_columns(
    file_columns: int, columns: Sequence[str], columns2: Sequence[str] | None
) -> list[str]:
    """The configured list, or the second one when the file has another number of columns."""
    if file_columns == len(columns):
        return list(columns)
    if not columns2 or file_columns != len(columns2):
        raise ValueError(f"file has {file_columns} columns, configuration {len(columns)}")
    return list(columns2)


def read_delimited(
    spark: SparkSession,
    files: str | Sequence[str],
    names: Sequence[str],
    delimiter: str = ",",
    quote: str = '"',
    encoding: str = "UTF8",
    has_header: bool = True,
    header_row: int = 0,
    limit_rows: int | None = None,
    nulls: str = "pandas",
    strict: bool = False,
    multi_line: bool = False,
    flag_bad: bool = False,
    append_crc: bool = False,
    rewrite: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """The rows of delimited files, every column a text, beside the file's ``path``.

    Nothing is inferred, so leading zeros stay and no extra pass is made. Files are split. Titles
    above the header and a row limit number the rows of each file and filter; blank lines are no
    rows. ``strict`` fails on a bad row. ``multi_line`` reads quoted newlines, in splits too
    (``records``): a quote that is never closed makes its line malformed and ends the file.
    ``flag_bad`` adds the text of a malformed line as ``_bad``, also where a field is surplus;
    ``append_crc`` adds the checksum of the raw line; ``rewrite`` changes lines before they are
    taken apart. The last two work on lines, so not with ``multi_line``.
    """
    by_line = append_crc or rewrite is not None
    if multi_line and by_line:
        raise ValueError("a row of several lines has no line to check or rewrite")
    bad = ["_bad"] if flag_bad else []
    schema = text_schema([*names, *bad])
    options = {
        "sep": delimiter, "quote": quote, "escape": quote, "emptyValue": QUOTED_EMPTY,
        "nullValue": "", "mode": "FAILFAST" if strict else "PERMISSIVE",
        "columnNameOfCorruptRecord": "_bad",
    }
    plain = header_row == 0 and limit_rows is None and not by_line and not multi_line
    if plain:
        rows = (
            spark.read.schema(schema)
            .options(**options, header=has_header, encoding=spark_encoding(encoding), recursiveFileLookup=True)
            .csv(files)
            .select(metadata_path().alias("path"), F.struct(*names, *bad).alias("_row"))
        )
    else:
        if multi_line:
            numbered = read_records(spark, files, delimiter, quote, encoding)
            options["multiLine"] = "true"
        else:
            found = raw.read_lines(spark, files, encoding=spark_encoding(encoding)).filter(F.trim("line") != "")
            numbered = raw.number_lines(found).withColumn("open", F.lit(False))
        if rewrite is not None:
            numbered = numbered.withColumn("line", rewrite(F.col("line")))
        if strict:
            unclosed = F.concat(F.lit("malformed row, a quote is not closed: "), "line")
            numbered = numbered.withColumn("line", F.when(F.col("open"), F.raise_error(unclosed)).otherwise(F.col("line")))
        ddl = ", ".join(f"`{f.name}` string" for f in schema)
        rows = raw.data_lines(numbered, header_row, has_header, limit_rows).withColumn(
            "_row", F.from_csv("line", ddl, options))
    extra = []
    if flag_bad:
        wrong = F.col("_row")["_bad"]
        extra.append((wrong if plain else F.when(F.col("open"), F.col("line")).otherwise(wrong)).alias("_bad"))
    if append_crc:
        extra.append(F.md5("line").alias("crc"))
    return rows.select("path", *extra, *[clean_nulls(F.col("_row")[n], nulls).alias(n) for n in names])


def has_quoted_newlines(
    spark: SparkSession, files: str | Sequence[str], delimiter: str = ",", encoding: str = "UTF8", quote: str = '"'
) -> bool:
    """Whether a line of the files ends inside a quoted field: only then must lines be joined. One
    scan that stays in the JVM and looks closer at lines with a quote only."""
    found = raw.read_lines(spark, files, True, spark_encoding(encoding))
    opens = line_effect(F.col("line"), delimiter, quote).isin(INSIDE, TURNS)
    return not found.filter(F.col("line").contains(quote)).filter(opens).isEmpty()


def read_records(
    spark: SparkSession, files: str | Sequence[str], delimiter: str = ",", quote: str = '"', encoding: str = "UTF8"
) -> DataFrame:
    """The records of files as texts with their numbers, quoted newlines inside."""
    return records(raw.read_lines(spark, files, True, spark_encoding(encoding)), delimiter, quote)


def count_rows(
    spark: SparkSession, files: str | Sequence[str], delimiter: str = ",", quote: str = '"', encoding: str = "UTF8",
    has_header: bool = True, header_row: int = 0,
) -> DataFrame:
    """A2: data rows of each file, and the columns of its first line; a quoted newline does not end
    a row. Files are split, nothing is taken apart, and no record is put together."""
    found = record_counts(raw.read_lines(spark, files, True, spark_encoding(encoding)), delimiter, quote)
    rows = F.col("records") - (header_row + 1 if has_header else header_row)
    counts = durable(found.select("path", rows.alias("rows")).filter("rows > 0"), "rows")
    first = head_lines(counts.select("path"), 1, spark_encoding(encoding), skip_blank=True)
    width = text.field_count(F.col("line"), delimiter, quote)
    return counts.join(first.select("path", width.cast("int").alias("columns")), "path")
