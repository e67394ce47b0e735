"""The data dictionary and the statements that create its tables."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.functions.names import snake_ddl

# The database's names of types.
TYPE_NAMES = {
    "boolean": "boolean", "smallint": "smallint", "int": "integer", "bigint": "bigint",
    "float": "real", "double": "double precision", "string": "character varying",
    "timestamp": "timestamp without time zone", "timestamp_ntz": "timestamp without time zone",
    "date": "date",
}
FIELDS = "type string, table_name string, column_name string, data_type string, is_nullable string, ordinal_position int"


def type_name(kind: T.DataType) -> str:
    if isinstance(kind, T.ArrayType):
        return type_name(kind.elementType) + "[]"
    if isinstance(kind, T.DecimalType):
        return f"numeric({kind.precision},{kind.scale})"
    return TYPE_NAMES.get(kind.simpleString(), kind.simpleString())


# Fixed value: where Spark keeps the declared type of a text column.
DECLARED = "__CHAR_VARCHAR_TYPE_STRING"


def declared(field: T.StructField) -> tuple[str, int | None]:
    """The database's type of a column and the length a text column was declared with."""
    kind = re.fullmatch(r"(char|varchar)\((\d+)\)", (field.metadata or {}).get(DECLARED, ""))
    if kind is None:
        return type_name(field.dataType), None
    return {"char": "character", "varchar": "character varying"}[kind[1]], int(kind[2])


def _longest(name: str, df: DataFrame) -> DataFrame:
    """(table, column, length) of the longest text of every text column without a declared length;
    one scan."""
    texts = [f.name for f in df.schema if isinstance(f.dataType, T.StringType) and declared(f)[1] is None]
    if not texts:
        return df.sparkSession.createDataFrame([], "table_name string, column_name string, longest int")
    one = df.agg(*[F.max(F.length(c)).alias(c) for c in texts])
    return one.unpivot([], texts, "column_name", "longest").select(
        F.lit(name).alias("table_name"), "column_name", "longest"
    )


def data_dictionary(tables: dict[str, DataFrame], views: tuple[str, ...] = (), scan: bool = False) -> DataFrame:
    """Type, table, column, data type, length, nullable, position, from the schemas alone.

    The length of a text is the declared one. Without one it is missing; with ``scan`` the tables
    are read and it is the longest text found (0 for none). Columns that are no texts have 0.
    """
    spark = next(iter(tables.values())).sparkSession
    rows = []
    for t, df in tables.items():
        for i, f in enumerate(df.schema):
            kind, length = declared(f)
            if not isinstance(f.dataType, T.StringType):
                length = 0
            rows.append(("View" if t in views else "Table", t, f.name, kind, "YES" if f.nullable else "NO", i + 1, length))
    found = spark.createDataFrame(rows, f"{FIELDS}, length int")
    if scan:
        longest = reduce(DataFrame.unionByName, [_longest(t, df) for t, df in tables.items()])
        found = found.join(longest, ["table_name", "column_name"], "left").withColumn(
            "length", F.coalesce("length", "longest", F.lit(0)))
    return found.select(
        "type", "table_name", "column_name", "data_type", "length", "is_nullable", "ordinal_position"
    ).orderBy("type", "table_name", "ordinal_position")


def catalog_dictionary(spark: SparkSession, database: str, scan: bool = False) -> DataFrame:
    """C1 over the tables and views of a database of the session's catalog."""
    listed = [t for t in spark.catalog.listTables(database) if t.namespace == [database]]
    return data_dictionary(
        {t.name: spark.table(f"{database}.{t.name}") for t in listed},
        tuple(t.name for t in listed if t.tableType == "VIEW"), scan,
    )


def ddl(dictionary: DataFrame, schema: str) -> DataFrame:
    """One row per table; a group holds the columns of one table."""
    size = F.concat(F.lit("("), F.greatest("length", F.lit(1)), F.lit(")"))
    known = F.col("length").isNotNull()
    sized = (
        F.when((F.col("data_type") == "character varying") & known, F.concat(F.lit("varchar"), size))
        .when((F.col("data_type") == "character") & known, F.concat(F.lit("char"), size))
        .otherwise(F.col("data_type"))
    )
    need = F.when(F.col("is_nullable") == "NO", " not null").otherwise("")
    line = F.concat(F.col("column_name"), F.lit(" "), sized, need)
    name = F.concat(F.lit(f"{schema}."), F.col("table_name"))
    return (
        dictionary.filter("type = 'Table'")
        .groupBy("table_name")
        .agg(F.array_sort(F.collect_list(F.struct("ordinal_position", line.alias("line")))).alias("c"))
        .select(
            "table_name",
            F.concat(F.lit("create table "), name, F.lit(" ("), F.array_join("c.line", ", "), F.lit(");")).alias("create_sql"),
            F.concat(F.lit("drop table if exists "), name, F.lit(";")).alias("drop_sql"),
            F.concat(
                F.lit(f"select 1/count(*) from information_schema.tables where table_schema='{schema}' and table_name='"),
                F.col("table_name"), F.lit("';"),
            ).alias("verify_sql"),
        )
    )


def table_ddl(spark: SparkSession, table: str) -> str:
    """The statement of a catalog table with its column names in snake case."""
    text = spark.sql("SHOW CREATE TABLE IDENTIFIER(:t)", {"t": table}).first()[0]
    return snake_ddl(text, spark.table(table).columns)


# The given tables' columns, for the SQL counterpart.
GIVEN = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp",
    "events": "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding float[], label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def _given() -> list[tuple[str, int, str, str]]:
    out = []
    for t, text in GIVEN.items():
        for i, field in enumerate(text.split(", ")):
            name, kind = field.split(" ")
            base = kind.removesuffix("[]")
            out.append((t, i + 1, name, TYPE_NAMES[base] + kind[len(base):]))
    return out


def oracle_dictionary() -> str:
    return " UNION ALL ".join(
        f"SELECT 'Table' AS type, '{t}' AS table_name, '{c}' AS column_name, '{k}' AS data_type, "
        + (f"CAST((SELECT max(len({c})) FROM {t}) AS INTEGER)" if k == "character varying" else "CAST(0 AS INTEGER)")
        + f" AS length, 'YES' AS is_nullable, CAST({i} AS INTEGER) AS ordinal_position"
        for t, i, c, k in _given()
    )


def oracle_ddl() -> str:
    return f"""WITH d AS ({oracle_dictionary()})
SELECT table_name, 'create table publish.' || table_name || ' (' || string_agg(column_name || ' '
    || CASE WHEN data_type = 'character varying' THEN 'varchar(' || CAST(length AS VARCHAR) || ')' ELSE data_type END,
    ', ' ORDER BY ordinal_position) || ');' AS create_sql,
  'drop table if exists publish.' || table_name || ';' AS drop_sql,
  'select 1/count(*) from information_schema.tables where table_schema=''publish'' and table_name='''
    || table_name || ''';' AS verify_sql
FROM d GROUP BY table_name"""
