"""Unpivot, lookup dictionaries and encoding of text columns as ids."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quayside.operators.numbering import number_rows
from quayside.operators.skew import BROADCAST_BYTES, BROADCAST_ROWS, lookup_join
from quayside.session import durable_sized

# Fixed value: the text of a cell without a value.
NULL_TEXT = "NULL"
DICTIONARY = "id long, type string, name string"


def columns_like(columns: Sequence[str], pattern: str) -> list[str]:
    """The columns whose name matches from its start."""
    found = re.compile(pattern)
    return [c for c in columns if found.match(c)]


def unpivot_tables(
    tables: Mapping[str, DataFrame], schema: str, table_pattern: str, column_pattern: str, **options
) -> DataFrame:
    """The unpivoted rows of every table whose name matches, tagged with schema and table."""
    parts = [
        unpivot(tables[t], column_pattern, tags={"year": schema, "table_name": t}, **options)
        for t in columns_like(list(tables), table_pattern)
    ]
    if not parts:
        raise ValueError(f"no table matches {table_pattern}")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def unpivot(
    df: DataFrame, pattern: str, keep: Sequence[str] | None = None, keep_nulls: bool = False,
    names: str = "col_name", values: str = "col_val", tags: Mapping[str, str] | None = None,
) -> DataFrame:
    """The matching columns as (name, value) rows beside the kept ones; one scan. ``tags`` are
    fixed columns put in front, such as the schema and the table the rows come from."""
    wide = columns_like(df.columns, pattern)
    ids = [c for c in df.columns if c not in wide] if keep is None else list(keep)
    long = df.unpivot(ids, wide, names, values)
    if tags:
        long = long.select(*[F.lit(v).alias(c) for c, v in tags.items()], "*")
    return long if keep_nulls else long.filter(F.col(values).isNotNull())


def lookup_values(
    df: DataFrame, columns: Mapping[str, str], constants: Mapping[str, Sequence[str]] | None = None
) -> DataFrame:
    """Distinct (type, name) pairs: the values of each column under its type, and fixed
    names, such as the pivoted column names under ``stats``. One scan for all columns."""
    spark = df.sparkSession
    typed = df.select(*[F.col(c).cast("string").alias(t) for c, t in columns.items()])
    found = (
        typed.unpivot([], list(columns.values()), "type", "name")
        .filter(F.col("name").isNotNull())
        .distinct()
    )
    fixed = [F.struct(F.lit(t).alias("type"), F.lit(n).alias("name")) for t, ns in (constants or {}).items() for n in ns]
    if fixed:
        names = spark.range(1).select(F.inline(F.array(*fixed)))
        found = found.unionByName(names).distinct()
    return found


def new_lookup_values(found: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Pairs the dictionary does not have yet. Both sides are distinct, so the join is even."""
    return found.join(dictionary.select("type", "name"), ["type", "name"], "left_anti")


def extend_dictionary(dictionary: DataFrame, found: DataFrame) -> DataFrame:
    """The dictionary with new pairs added; old ids stay, new ones follow the highest
    in order of (type, name). The new pairs are written and counted once; few of them are numbered
    by one task, more over range partitions."""
    new, count, size = durable_sized(new_lookup_values(found, dictionary), "new-names")
    if count <= BROADCAST_ROWS and size <= BROADCAST_BYTES:
        fresh = new.withColumn("_n", F.row_number().over(Window.orderBy("type", "name")).cast("long"))
    else:
        fresh = number_rows(new, ["type", "name"], name="_n")
    top = dictionary.agg(F.coalesce(F.max("id"), F.lit(0)).alias("top"))
    added = fresh.select((F.col("_n") + top.scalar()).alias("id"), "type", "name")
    return dictionary.select("id", "type", "name").unionByName(added)


def empty_dictionary(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame([], DICTIONARY)


def encode(df: DataFrame, dictionary: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Replace each column by the id of its (type, name) pair, as inner joins.

    The dictionary is written and sized once, then each type is one join: a broadcast when the whole
    dictionary is small, else a lookup join with hot values split off.
    """
    table, count, size = durable_sized(dictionary.select("id", "type", "name"), "dictionary")
    small = count <= BROADCAST_ROWS and size <= BROADCAST_BYTES
    out = df
    for column, kind in columns.items():
        part = table.filter(F.col("type") == kind).select(
            F.col("name").alias(column), F.col("id").alias(f"{column}_id")
        )
        joined = (
            out.join(F.broadcast(part), column) if small else lookup_join(out, part, [column], stored=True)
        )
        out = joined.drop(column)
    return out


def melt_block(df: DataFrame, ids: Sequence[str], null_text: str = NULL_TEXT) -> DataFrame:
    """R2: the measure columns of a data block as rows, cells holding the NULL text dropped,
    quotes taken out of every text."""
    plain = df.select(*[F.replace(F.col(c), F.lit('"'), F.lit("")).alias(c) for c in df.columns])
    wide = [c for c in df.columns if c not in ids]
    return plain.unpivot(list(ids), wide, "measure", "stat_value").filter(
        F.col("stat_value") != null_text
    )
