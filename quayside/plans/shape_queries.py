"""Queries that reshape, encode, check and render rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions import checksums, names, render, text
from quayside.operators import quality, reshape
from quayside.operators.skew import lookup_join
from quayside.plans.inputs import FILES_SQL, files, table
from quayside.plans.registry import query

MEASURES = r"l_(quantity|extendedprice|discount|tax)$"


def cents(column: str) -> Column:
    """Money as whole hundredths, so that sums do not depend on the order of addition."""
    return F.round(F.col(column) * 100).cast("long")


# --- names and lines -------------------------------------------------------------------------

SNAKE_TAGS_SQL = reduce(
    lambda sql, tag: f"replace({sql}, '{tag}', '_')",
    names.NAME_TAGS,
    "lower(replace(regexp_replace(regexp_replace({0}, '([A-Z]+)([A-Z][a-z])', '\\1_\\2', 'g'),"
    " '([a-z0-9])([A-Z])', '\\1_\\2', 'g'), '-', '_'))",
)


def snake_sql(column: str) -> str:
    return f"trim({SNAKE_TAGS_SQL.replace('{0}', column)})"


@query(
    "snake_names",
    f"""SELECT p_partkey, {snake_sql('p_name')} AS name, {snake_sql('p_brand')} AS brand,
       {snake_sql("concat_ws(' ', p_type, p_name, '(LoanID-HTTPServer)', p_brand)")} AS header
FROM part""",
)
def snake_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5 on names with blanks, signs, acronyms and camel case."""
    header = F.concat_ws(" ", "p_type", "p_name", F.lit("(LoanID-HTTPServer)"), "p_brand")
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        names.snake_column(F.col("p_name")).alias("name"),
        names.snake_column(F.col("p_brand")).alias("brand"),
        names.snake_column(header).alias("header"),
    )


LINES_SQL = """lines AS (
  SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) - 1 AS line_no
  FROM (SELECT doc_id, string_split(regexp_replace(text, '\\n$', ''), chr(10)) AS l
        FROM documents WHERE text <> ''))"""


def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of every document with its 0-based number; split inside the row, no shuffle."""
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.posexplode(text.lines_of(F.col("text"))).alias("line_no", "line")
    )


@query(
    "line_crc",
    f"""WITH {LINES_SQL}
SELECT doc_id, CAST(line_no AS BIGINT) AS line_no, md5(line) AS crc FROM lines""",
)
def line_crc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_lines(spark, sf_dir).select(
        "doc_id", F.col("line_no").cast("long").alias("line_no"),
        checksums.line_crc(F.col("line")).alias("crc"),
    )


@query(
    "line_scan",
    f"""WITH {LINES_SQL}
SELECT doc_id, CAST(line_no AS BIGINT) AS row_no, line FROM lines WHERE line_no > 0""",
)
def line_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The data lines of each file, the first line being its header."""
    return document_lines(spark, sf_dir).filter("line_no > 0").select(
        "doc_id", F.col("line_no").cast("long").alias("row_no"), "line"
    )


@query(
    "tag_file_id",
    f"""WITH {FILES_SQL}, {LINES_SQL}
SELECT f.file_id, CAST(l.line_no AS BIGINT) AS line_no,
       '"' || CAST(f.file_id AS VARCHAR) || '",' || l.line AS line
FROM lines l JOIN files s ON s.file_id = l.doc_id + 1
     JOIN files f ON f.file_path = s.file_path AND f.file_name = s.file_name""",
)
def tag_file_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines know only the path of their file; the catalog gives the id."""
    catalog = files(spark, sf_dir).select("file_id", "file_path", "file_name")
    located = files(spark, sf_dir, "text").select(
        "file_path", "file_name", F.posexplode(text.lines_of(F.col("text"))).alias("line_no", "line")
    )
    return lookup_join(located, catalog, ["file_path", "file_name"]).select(
        "file_id", F.col("line_no").cast("long").alias("line_no"),
        text.prefixed(F.col("line"), F.col("file_id")).alias("line"),
    )


@query(
    "requote_lines",
    """SELECT doc_id, md5(array_to_string(list_transform(string_split(text, chr(10)), lambda x:
         regexp_replace(regexp_replace(regexp_replace(replace(x, '"', '""'),
           '^""', '"'), '""$', '"'), '"" ""', '"|"', 'g')), chr(10))) AS crc,
       CAST(len(text) - len(replace(text, '"', '')) AS BIGINT) AS quotes
FROM documents""",
)
def requote_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P8 on every line of every text; the checksum stands for the rewritten text."""
    body = F.col("text")
    rewritten = F.transform(F.split(body, "\n"), lambda line: text.requote(line, " ", "|"))
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.md5(F.array_join(rewritten, "\n")).alias("crc"),
        (F.length(body) - F.length(F.replace(body, F.lit('"'), F.lit("")))).cast("long").alias("quotes"),
    )


# Line starts that hold a comma in the given texts, beside the known ones of source files.
TEXT_PREFIXES = (*text.KNOWN_PREFIXES, "The, ", "Of, ", "And, ", "In, ", "To, ")


def _prefix_sql() -> str:
    sql = "x"
    for p in TEXT_PREFIXES:
        doubled = p.replace('"', '""')
        sql = (f"(SELECT CASE WHEN starts_with(y, '{p}') THEN '\"{doubled}\"' || substr(y, {len(p) + 1})"
               f" ELSE y END FROM (SELECT {sql} AS y))")
    return sql


@query(
    "quote_prefixes",
    f"""WITH {LINES_SQL}, quoted AS (SELECT doc_id, line_no, line, {_prefix_sql().replace('SELECT x AS y', 'SELECT line AS y')} AS q FROM lines)
SELECT doc_id, md5(string_agg(q, chr(10) ORDER BY line_no)) AS crc,
       count(*) FILTER (WHERE q <> line) AS quoted
FROM quoted GROUP BY doc_id""",
)
def quote_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P9 on every line of every text, inside the row."""
    before = text.lines_of(F.col("text"))
    after = F.transform(before, lambda line: text.quote_prefixes(line, TEXT_PREFIXES))
    changed = F.filter(F.arrays_zip(before.alias("a"), after.alias("b")), lambda p: p["a"] != p["b"])
    return table(spark, sf_dir, "documents").filter("text <> ''").select(
        "doc_id",
        F.md5(F.array_join(after, "\n")).alias("crc"),
        F.size(changed).cast("long").alias("quoted"),
    )


@query(
    "median_fields",
    f"""WITH {LINES_SQL}
SELECT doc_id, CAST(median(len(string_split(regexp_replace(line, '"[^"]*"', '', 'g'), ',')))
                    AS DOUBLE) AS median_fields
FROM lines GROUP BY doc_id""",
)
def median_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4 over all lines of each text. Counts are reduced to (file, width) before the median."""
    lines = document_lines(spark, sf_dir).select(
        "doc_id", text.field_count(F.col("line")).alias("fields")
    )
    return lines.groupBy("doc_id").agg(F.median("fields").alias("median_fields"))


# --- reshape and dictionaries ----------------------------------------------------------------

@query(
    "unpivot_lineitem",
    """SELECT l_returnflag, l_linestatus, col_name, count(*) AS n,
       CAST(sum(CAST(round(col_val * 100) AS BIGINT)) AS BIGINT) AS cents
FROM (SELECT l_returnflag, l_linestatus, 'l_quantity' AS col_name, l_quantity AS col_val FROM lineitem
  UNION ALL SELECT l_returnflag, l_linestatus, 'l_extendedprice', l_extendedprice FROM lineitem
  UNION ALL SELECT l_returnflag, l_linestatus, 'l_discount', l_discount FROM lineitem
  UNION ALL SELECT l_returnflag, l_linestatus, 'l_tax', l_tax FROM lineitem)
WHERE col_val IS NOT NULL GROUP BY ALL""",
)
def unpivot_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four measures as rows, summed per name."""
    long = reshape.unpivot(
        table(spark, sf_dir, "lineitem"), MEASURES, keep=["l_returnflag", "l_linestatus"]
    )
    return long.groupBy("l_returnflag", "l_linestatus", "col_name").agg(
        F.count(F.lit(1)).alias("n"), F.sum(cents("col_val")).alias("cents")
    )


DIMS = {"o_orderstatus": "status", "o_orderpriority": "priority", "c_mktsegment": "segment"}

ORDERS_SQL = """wide AS (
  SELECT o.*, c.c_mktsegment FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey)"""

# Names that were encoded before: those of the orders before 1996.
FOUND_SQL = """ SELECT DISTINCT 'status' AS type, o_orderstatus AS name FROM {0}
  UNION SELECT DISTINCT 'priority', o_orderpriority FROM {0}
  UNION SELECT DISTINCT 'segment', c_mktsegment FROM {0}"""


def orders_with_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    segments = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), "c_mktsegment"
    )
    return lookup_join(table(spark, sf_dir, "orders"), segments, ["o_custkey"], stored=True)


@query(
    "new_lookup_values",
    f"""WITH {ORDERS_SQL}, old AS (SELECT * FROM wide WHERE o_orderstatus = 'F'),
 known AS ({FOUND_SQL.format('old')}), found AS ({FOUND_SQL.format('wide')})
SELECT f.type, f.name FROM found f
WHERE NOT EXISTS (SELECT 1 FROM known k WHERE k.type = f.type AND k.name = f.name)
  AND f.name IS NOT NULL""",
)
def new_lookup_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of all orders that the dictionary of the closed orders lacks."""
    wide = orders_with_segment(spark, sf_dir)
    known = reshape.lookup_values(wide.filter("o_orderstatus = 'F'"), DIMS)
    return reshape.new_lookup_values(reshape.lookup_values(wide, DIMS), known)


def _dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = orders_with_segment(spark, sf_dir)
    closed = reshape.lookup_values(wide.filter("o_orderstatus = 'F'"), DIMS)
    first = reshape.extend_dictionary(reshape.empty_dictionary(wide), closed)
    stats = {"stats": reshape.columns_like(table(spark, sf_dir, "lineitem").columns, MEASURES)}
    return reshape.extend_dictionary(first, reshape.lookup_values(wide, DIMS, stats))


DICTIONARY_SQL = f"""{ORDERS_SQL}, old AS (SELECT * FROM wide WHERE o_orderstatus = 'F'),
 known AS (SELECT row_number() OVER (ORDER BY type, name) AS id, type, name
           FROM ({FOUND_SQL.format('old')})),
 found AS ({FOUND_SQL.format('wide')}
  UNION SELECT 'stats', unnest(['l_quantity', 'l_extendedprice', 'l_discount', 'l_tax'])),
 fresh AS (SELECT f.type, f.name FROM found f
           WHERE NOT EXISTS (SELECT 1 FROM known k WHERE k.type = f.type AND k.name = f.name)),
 dictionary AS (SELECT * FROM known UNION ALL
   SELECT (SELECT max(id) FROM known) + row_number() OVER (ORDER BY type, name), type, name
   FROM fresh)"""


@query("build_dictionary", f"WITH {DICTIONARY_SQL} SELECT id, type, name FROM dictionary")
def build_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids given in a first run stay when a second run adds names."""
    return _dictionary(spark, sf_dir).select("id", "type", "name")


@query(
    "encode_orders",
    f"""WITH {DICTIONARY_SQL}
SELECT a.id AS o_orderstatus_id, b.id AS o_orderpriority_id, c.id AS c_mktsegment_id,
       count(*) AS n
FROM wide w JOIN dictionary a ON a.type = 'status' AND a.name = w.o_orderstatus
     JOIN dictionary b ON b.type = 'priority' AND b.name = w.o_orderpriority
     JOIN dictionary c ON c.type = 'segment' AND c.name = w.c_mktsegment
GROUP BY ALL""",
)
def encode_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three text columns of the facts as ids of the dictionary."""
    coded = reshape.encode(orders_with_segment(spark, sf_dir), _dictionary(spark, sf_dir), DIMS)
    return coded.groupBy("o_orderstatus_id", "o_orderpriority_id", "c_mktsegment_id").agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    "encode_unpivoted",
    """WITH long AS (
  SELECT l_returnflag, l_linestatus, 'l_quantity' AS col_name, l_quantity AS col_val FROM lineitem
  UNION ALL SELECT l_returnflag, l_linestatus, 'l_extendedprice', l_extendedprice FROM lineitem
  UNION ALL SELECT l_returnflag, l_linestatus, 'l_discount', l_discount FROM lineitem
  UNION ALL SELECT l_returnflag, l_linestatus, 'l_tax', l_tax FROM lineitem),
 dictionary AS (SELECT row_number() OVER (ORDER BY type, name) AS id, type, name FROM (
   SELECT 'flag' AS type, l_returnflag AS name FROM lineitem
   UNION SELECT 'line', l_linestatus FROM lineitem UNION SELECT 'stats', col_name FROM long))
SELECT a.id AS l_returnflag_id, b.id AS l_linestatus_id, c.id AS col_name_id, count(*) AS n,
       CAST(sum(CAST(round(col_val * 100) AS BIGINT)) AS BIGINT) AS cents
FROM long x JOIN dictionary a ON a.type = 'flag' AND a.name = x.l_returnflag
     JOIN dictionary b ON b.type = 'line' AND b.name = x.l_linestatus
     JOIN dictionary c ON c.type = 'stats' AND c.name = x.col_name
WHERE col_val IS NOT NULL GROUP BY ALL""",
)
def encode_unpivoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unpivot, then encode the kept columns and the column names."""
    wide = table(spark, sf_dir, "lineitem")
    base = {"l_returnflag": "flag", "l_linestatus": "line"}
    stats = {"stats": reshape.columns_like(wide.columns, MEASURES)}
    dictionary = reshape.extend_dictionary(
        reshape.empty_dictionary(wide), reshape.lookup_values(wide, base, stats)
    )
    long = reshape.unpivot(wide, MEASURES, keep=list(base))
    coded = reshape.encode(long, dictionary, {**base, "col_name": "stats"})
    return coded.groupBy("l_returnflag_id", "l_linestatus_id", "col_name_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum(cents("col_val")).alias("cents")
    )


# --- checksums, profiles, redaction ----------------------------------------------------------

@query(
    "row_crc",
    """SELECT c_custkey, md5(concat_ws(chr(31), CAST(c_custkey AS VARCHAR), c_name,
       CAST(c_nationkey AS VARCHAR), c_mktsegment)) AS crc FROM customer""",
)
def row_crc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row's checksum over chosen columns, in order."""
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        checksums.row_crc(["c_custkey", "c_name", "c_nationkey", "c_mktsegment"]).alias("crc"),
    )


def _money(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("decimal(18,2)") for c in columns})


def _profiled(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Tables with amounts as decimals and dates as dates, whose text is the same everywhere."""
    return {
        "customer": _money(table(spark, sf_dir, "customer"), "c_acctbal"),
        "part": _money(table(spark, sf_dir, "part"), "p_retailprice"),
        "orders": _money(table(spark, sf_dir, "orders"), "o_totalprice").withColumn(
            "o_orderdate", F.col("o_orderdate").cast("date")
        ),
    }


PROFILED_SQL = {
    "customer": ["c_custkey", "c_name", "c_nationkey", "CAST(c_acctbal AS DECIMAL(18,2))", "c_mktsegment"],
    "part": ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "CAST(p_retailprice AS DECIMAL(18,2))"],
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "CAST(o_totalprice AS DECIMAL(18,2))",
               "CAST(o_orderdate AS DATE)", "o_orderpriority"],
}


def _plain(expression: str) -> str:
    return expression.removeprefix("CAST(").split(" ")[0]


def _per_column_sql(template: str) -> str:
    return " UNION ALL ".join(
        template.format(t=t, c=_plain(e), e=f"CAST({e} AS VARCHAR)")
        for t, es in PROFILED_SQL.items() for e in es
    )


@query(
    "profile_maxlen",
    _per_column_sql("SELECT '{t}' AS table_name, '{c}' AS column_name, max(len({e})) AS max_len FROM {t}"),
)
def profile_maxlen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5 for three tables."""
    parts = [
        quality.profile_lengths(df).select(F.lit(t).alias("table_name"), "column_name", "max_len")
        for t, df in _profiled(spark, sf_dir).items()
    ]
    return reduce(DataFrame.unionByName, parts)


@query(
    "profile_merged",
    """SELECT column_name, max(n) AS max_len FROM (
  SELECT 'key' AS column_name, max(len(CAST(c_custkey AS VARCHAR))) AS n FROM customer
  UNION ALL SELECT 'name', max(len(c_name)) FROM customer
  UNION ALL SELECT 'key', max(len(CAST(s_suppkey AS VARCHAR))) FROM supplier
  UNION ALL SELECT 'name', max(len(s_name)) FROM supplier
  UNION ALL SELECT 'key', max(len(CAST(p_partkey AS VARCHAR))) FROM part
  UNION ALL SELECT 'name', max(len(p_name)) FROM part) GROUP BY column_name""",
)
def profile_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column lengths over all files that have the column; O4: shortest first."""
    profiles = [
        quality.profile_lengths(table(spark, sf_dir, t).select(F.col(k).alias("key"), F.col(n).alias("name")))
        for t, k, n in (("customer", "c_custkey", "c_name"), ("supplier", "s_suppkey", "s_name"),
                        ("part", "p_partkey", "p_name"))
    ]
    return quality.merge_profiles(profiles).orderBy("max_len", "column_name")


@query(
    "width_minmax",
    " UNION ALL ".join(
        f"SELECT '{_plain(e)}' AS column_name, min(len(CAST({e} AS VARCHAR))) AS min_width,"
        f" max(len(CAST({e} AS VARCHAR))) AS max_width FROM part"
        for e in PROFILED_SQL["part"]
    ),
)
def width_minmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The narrowest and widest text of each column."""
    return render.text_widths(_profiled(spark, sf_dir)["part"])


INDEXES = {
    "ix_order_line": ["l_orderkey", "l_linenumber"],
    "ix_part_supp": ["l_partkey", "l_suppkey"],
    "ix_flags": ["l_returnflag", "l_linestatus"],
}


@query(
    "index_cardinality",
    " UNION ALL ".join(
        f"SELECT '{name}' AS index_name, count(DISTINCT concat({', '.join(cols)})) AS cardinality"
        " FROM lineitem" for name, cols in INDEXES.items()
    ),
)
def index_cardinality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.index_cardinality(table(spark, sf_dir, "lineitem"), INDEXES)


@query("index_cardinality_approx")
def index_cardinality_approx(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.index_cardinality_approx(table(spark, sf_dir, "lineitem"), INDEXES)


@query(
    "column_stats",
    _per_column_sql(
        "SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) AS row_count,"
        " count(*) - count({c}) AS null_count, count(DISTINCT {e}) AS distinct_count,"
        " min({e}) AS min_text, max({e}) AS max_text, count(*) = count(DISTINCT {e}) AS is_key FROM {t}"
    ),
)
def column_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of every column of three tables."""
    parts = [
        quality.column_stats(df).withColumn("table_name", F.lit(t))
        for t, df in _profiled(spark, sf_dir).items()
    ]
    return reduce(DataFrame.unionByName, parts)


@query(
    "key_discovery",
    _per_column_sql(
        "SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) AS row_count,"
        " count(*) - count({c}) AS null_count, min({e}) AS min_text, max({e}) AS max_text,"
        " count(*) = count(DISTINCT {e}) AS is_key, true AS count_is_near FROM {t}"
    ),
)
def key_discovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys found by sketches: only columns that may be one are counted exactly. The counts
    of the others are sketches, compared here with exact ones."""
    parts = []
    for t, df in _profiled(spark, sf_dir).items():
        near = quality.column_stats(df, exact="keys")
        exact = quality.column_stats(df).select("column_name", F.col("distinct_count").alias("n"))
        close = F.abs(F.col("distinct_count") - F.col("n")) <= F.greatest(F.col("n") * 0.1, F.lit(1))
        parts.append(near.join(exact, "column_name").select(
            F.lit(t).alias("table_name"), "column_name", "row_count", "null_count", "min_text", "max_text", "is_key",
            close.alias("count_is_near")))
    return reduce(DataFrame.unionByName, parts)


@query(
    "index_cardinality_near",
    " UNION ALL ".join(f"SELECT '{name}' AS index_name, true AS is_near" for name in INDEXES),
)
def index_cardinality_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sketches of the indexes lie within a tenth of the exact counts."""
    lines = table(spark, sf_dir, "lineitem")
    exact = quality.index_cardinality(lines, INDEXES).withColumnRenamed("cardinality", "exact")
    near = F.abs(F.col("cardinality") - F.col("exact")) <= 0.1 * F.col("exact")
    return quality.index_cardinality_approx(lines, INDEXES).join(exact, "index_name").select("index_name", near.alias("is_near"))


REDACTION = {"c_custkey": "keep", "c_name": "Hash", "c_nationkey": "Increment", "c_acctbal": "drop"}


@query(
    "redact_customer",
    "SELECT c_custkey, md5(c_name) AS c_name, c_nationkey + 1 AS c_nationkey FROM customer",
)
def redact_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The segment has no rule, so it goes too."""
    return quality.redact(table(spark, sf_dir, "customer"), REDACTION)


# --- rendered rows ---------------------------------------------------------------------------

@query(
    "rows_json",
    """SELECT c_custkey, CAST(to_json([CAST(c_custkey AS VARCHAR), c_name, CAST(c_nationkey AS VARCHAR),
       c_mktsegment]) AS VARCHAR) AS row_json FROM customer""",
)
def rows_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        render.json_row(["c_custkey", "c_name", "c_nationkey", "c_mktsegment"]).alias("row_json"),
    )


@query(
    "rows_html",
    """SELECT page_id, '<tr><td>' || CAST(page_id AS VARCHAR) || '</td><td>'
       || replace(replace(replace(url, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') || '</td></tr>' AS row_html
FROM pages""",
)
def rows_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select(
        "page_id", render.html_row(["page_id", "url"]).alias("row_html")
    )


@query(
    "rows_markdown",
    """SELECT p_partkey, '| ' || CAST(p_partkey AS VARCHAR) || ' | ' || p_name || ' | ' || p_brand
       || ' | ' || CAST(p_size AS VARCHAR) || ' |' AS row_md FROM part""",
)
def rows_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        "p_partkey", render.markdown_row(["p_partkey", "p_name", "p_brand", "p_size"]).alias("row_md")
    )


@query(
    "rows_padded",
    """SELECT c_custkey,
       CASE WHEN len(c_mktsegment) < 8 THEN lpad(c_mktsegment, 8, ' ') ELSE c_mktsegment END AS right_text,
       CASE WHEN len(c_name) < 24 THEN rpad(c_name, 24, ' ') ELSE c_name END AS left_text,
       repeat('.', (12 - least(len(c_mktsegment), 12)) // 2) || c_mktsegment
         || repeat('.', (12 - least(len(c_mktsegment), 12) + 1) // 2) AS centred
FROM customer""",
)
def rows_padded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K9: texts longer than the width stay whole."""
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        render.padded("c_mktsegment", 8).alias("right_text"),
        render.padded("c_name", 24, "l").alias("left_text"),
        render.padded("c_mktsegment", 12, "c", ".").alias("centred"),
    )


@query(
    "topn_load",
    """SELECT o_orderkey, o_custkey, o_orderpriority FROM orders
ORDER BY o_totalprice DESC, o_orderkey LIMIT 100""",
)
def topn_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O3: the first rows of a load after a total order; each task keeps only its own first rows."""
    return (
        table(spark, sf_dir, "orders").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(100)
        .select("o_orderkey", "o_custkey", "o_orderpriority")
    )
