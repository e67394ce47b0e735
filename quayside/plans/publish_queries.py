"""Queries that publish the given tables in each delivery mode, write whole documents and create tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions import names as naming
from quayside.operators import merge, reshape
from quayside.plans import dictionary
from quayside.plans.inputs import TABLES, table
from quayside.plans.intake_queries import BOOK_ROWS
from quayside.plans.publish_job import PublishJob
from quayside.plans.registry import query
from quayside.session import durable, scratch_path
from quayside.sources import archives, lines, listing, storage, tables

# Orders as a delivered table: a file id per customer, a time, and amounts in cents.
DELIVERED = ["o_orderkey", "file_id", "cents", "cdo_last_update"]
DELIVERED_SQL = """d AS (
  SELECT o_orderkey, o_custkey AS file_id, CAST(round(o_totalprice * 100) AS BIGINT) AS cents,
         o_orderdate AS cdo_last_update, o_orderpriority FROM orders)"""


def _delivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("file_id"), F.round(F.col("o_totalprice") * 100).cast("long").alias("cents"),
        F.col("o_orderdate").alias("cdo_last_update"), "o_orderpriority")


def _newest_version(spark: SparkSession, item: dict, sources: list[DataFrame], catalog: DataFrame | None = None) -> DataFrame:
    """The target after a run for each source, beside the number of runs whose counts agree."""
    item = {"move_data": True, "tables": ["orders"], "db": {"source_db": {"schema": "src"}, "target_db": {"schema": "pub"}}, **item}
    folder = scratch_path(spark, "publish")
    for source in sources:
        kept = durable(source.select(*DELIVERED), "source")
        job = PublishJob(spark, item, folder, lambda name, s=kept: s, ["orders"], catalog)
        log = job.run()
    whole = durable(log, "log")
    good = whole.filter("status = 'Completed' AND rows_dumped = rows_loaded").agg(F.count(F.lit(1)).alias("n"))
    target = tables.VersionedTable(spark, job.path("orders"), kept.schema).read()
    return durable(target, "target").select("o_orderkey", "file_id", "cents").withColumn("good_runs", good.scalar())


@query(
    "publish_killfill",
    f"WITH {DELIVERED_SQL} SELECT o_orderkey, file_id, cents + 1 AS cents, CAST(2 AS BIGINT) AS good_runs FROM d WHERE o_orderkey % 3 <> 0",
)
def publish_killfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mode that replaces the target: after the second run only its rows are left."""
    rows = _delivered(spark, sf_dir)
    later = rows.filter("o_orderkey % 3 <> 0").withColumn("cents", F.col("cents") + 1)
    return _newest_version(spark, {"delivery_type": "KILLFILL"}, [rows, later])


@query(
    "publish_file_id",
    f"""WITH {DELIVERED_SQL}
SELECT o_orderkey, file_id, CASE WHEN file_id % 2 = 0 THEN cents ELSE cents + 1 END AS cents, CAST(2 AS BIGINT) AS good_runs FROM d""",
)
def publish_file_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L3: files the target has are not moved again; the second run adds the others."""
    rows = _delivered(spark, sf_dir)
    return _newest_version(spark, {"delivery_type": "FILE_ID"},
                           [rows.filter("file_id % 2 = 0"), rows.withColumn("cents", F.col("cents") + 1)])


@query(
    "publish_last_update",
    f"""WITH {DELIVERED_SQL}, t AS (SELECT max(cdo_last_update) AS t FROM d WHERE cdo_last_update < TIMESTAMP '1997-01-01')
SELECT o_orderkey, file_id, CASE WHEN cdo_last_update > t THEN cents + 1 ELSE cents END AS cents, CAST(2 AS BIGINT) AS good_runs
FROM d, t WHERE cdo_last_update < TIMESTAMP '1997-01-01' OR cdo_last_update > t""",
)
def publish_last_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L4: rows newer than the newest one of the target are merged by key."""
    rows = _delivered(spark, sf_dir)
    early = rows.filter("cdo_last_update < timestamp'1997-01-01'")
    return _newest_version(
        spark, {"delivery_type": "CDO_LAST_UPDATE", "keys": ["o_orderkey"], "tie_column": "file_id"},
        [early, rows.withColumn("cents", F.col("cents") + 1)])


@query(
    "publish_project",
    f"""WITH {DELIVERED_SQL}
SELECT o_orderkey, file_id, CASE WHEN file_id % 2 = 0 THEN cents ELSE cents + 1 END AS cents, CAST(2 AS BIGINT) AS good_runs
FROM d JOIN customer ON c_custkey = file_id WHERE c_mktsegment = 'BUILDING'""",
)
def publish_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the files of a project, each once."""
    rows = _delivered(spark, sf_dir)
    catalog = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("file_id"), F.col("c_mktsegment").alias("project_name"))
    return _newest_version(spark, {"delivery_type": "PROJECT", "project": "BUILDING"},
                           [rows.filter("file_id % 2 = 0"), rows.withColumn("cents", F.col("cents") + 1)], catalog)


@query(
    "publish_distributed",
    f"""WITH {DELIVERED_SQL}, parts AS (
  SELECT 'KILLFILL' AS mode, o_orderkey, file_id, cents + 1 AS cents FROM d WHERE o_orderkey % 3 <> 0
  UNION ALL SELECT 'FILE_ID', o_orderkey, file_id, CASE WHEN file_id % 2 = 0 THEN cents ELSE cents + 1 END FROM d
  UNION ALL SELECT 'CDO_LAST_UPDATE', o_orderkey, file_id, CASE WHEN cdo_last_update > t THEN cents + 1 ELSE cents END
    FROM d, (SELECT max(cdo_last_update) AS t FROM d WHERE cdo_last_update < TIMESTAMP '1997-01-01')
    WHERE cdo_last_update < TIMESTAMP '1997-01-01' OR cdo_last_update > t)
SELECT mode, file_id, count(*) AS n, CAST(sum(cents) AS BIGINT) AS cents, CAST(8 AS INTEGER) AS buckets, CAST(2 AS BIGINT) AS good_runs
FROM parts GROUP BY mode, file_id""",
)
def publish_distributed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Targets that the job creates in the catalog, distributed by the file id, through
    two runs of three modes; the sums per file need no shuffle."""
    rows = durable(_delivered(spark, sf_dir).select(*DELIVERED), "source")
    later = rows.withColumn("cents", F.col("cents") + 1)
    runs = {
        "KILLFILL": [rows, later.filter("o_orderkey % 3 <> 0")], "FILE_ID": [rows.filter("file_id % 2 = 0"), later],
        "CDO_LAST_UPDATE": [rows.filter("cdo_last_update < timestamp'1997-01-01'"), later]}
    found = []
    for mode, sources in runs.items():
        schema = f"pub_{uuid.uuid4().hex}"
        spark.sql(f"CREATE DATABASE {schema} LOCATION '{scratch_path(spark, 'published')}'")
        item = {"move_data": True, "delivery_type": mode, "keys": ["o_orderkey"], "tie_column": "file_id", "distributed_by": "file_id",
                "buckets": 8, "tables": ["orders"], "db": {"source_db": {"schema": "src"}, "target_db": {"schema": schema}}}
        folder = scratch_path(spark, "publish")
        for source in sources:
            log = PublishJob(spark, item, folder, lambda name, s=source: s, ["orders"]).run()
        about = {r[0]: r[1] for r in spark.sql(f"DESCRIBE EXTENDED {schema}.orders").collect()}
        good = durable(log, "log").filter("status = 'Completed' AND rows_dumped = rows_loaded").count()
        sums = spark.table(f"{schema}.orders").groupBy("file_id").agg(F.count(F.lit(1)).alias("n"), F.sum("cents").alias("cents"))
        found.append(durable(sums.select(
            F.lit(mode).alias("mode"), "file_id", "n", "cents", F.lit(int(about["Num Buckets"])).alias("buckets"),
            F.lit(good).cast("long").alias("good_runs")), "sums"))
        spark.sql(f"DROP DATABASE {schema} CASCADE")
    return found[0].unionByName(found[1]).unionByName(found[2])


@query(
    "null_batches",
    """SELECT 'select * from src.customer where segment' || CASE WHEN segment IS NULL THEN ' IS NULL' ELSE '=''' || segment || '''' END AS src_sql,
       count(*) AS rows_dumped, count(*) AS rows_loaded, 'Completed' AS status, CAST(sum(c_custkey) AS BIGINT) AS ids
FROM (SELECT c_custkey, CASE WHEN c_nationkey % 3 <> 0 THEN c_mktsegment END AS segment FROM customer) GROUP BY segment""",
)
def null_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without a batch value are a batch of their own, moved and logged as any other."""
    rows = durable(table(spark, sf_dir, "customer").select(
        "c_custkey", F.when(F.col("c_nationkey") % 3 != 0, F.col("c_mktsegment")).alias("segment")), "source")
    item = {"delivery_type": "SCHEMA", "move_data": True, "tables": [{"table": "customer", "batch_method": "COLUMN", "column": "segment"}],
            "db": {"source_db": {"schema": "src"}, "target_db": {"schema": "pub"}}}
    job = PublishJob(spark, item, scratch_path(spark, "publish"), lambda name: rows, ["customer"])
    log = durable(job.run(), "log")
    moved = spark.read.parquet(job.path("customer")).groupBy(F.col("publish_batch").alias("src_sql_hash")).agg(F.sum("c_custkey").alias("ids"))
    return log.join(moved, "src_sql_hash").select("src_sql", "rows_dumped", "rows_loaded", "status", "ids")


@query(
    "retained_dump",
    """SELECT CAST(c_custkey AS VARCHAR) AS k, c_name AS name, c_mktsegment AS segment FROM customer""",
)
def retained_dump(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4: the rows of a publish run kept as delimited files beside the target."""
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    kept = scratch_path(spark, "kept")
    item = {"delivery_type": "SCHEMA", "move_data": True, "retain_data_file_path": kept,
            "tables": [{"table": "customer", "batch_method": "COLUMN", "column": "c_mktsegment"}],
            "db": {"source_db": {"schema": "src"}, "target_db": {"schema": "pub"}}}
    PublishJob(spark, item, scratch_path(spark, "publish"), lambda name: rows, ["customer"]).run()
    return spark.read.schema("k string, name string, segment string").csv(f"{kept}/customer")


@query(
    "named_dump",
    """SELECT CAST(n_nationkey AS VARCHAR) AS Code, n_name AS Country, CAST(n_regionkey AS VARCHAR) AS Region FROM nation
UNION ALL SELECT CAST(c_custkey AS VARCHAR), c_name, CAST(c_nationkey AS VARCHAR) FROM customer""",
)
def named_dump(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5: queries dumped under given names, read back by their headers."""
    folder = scratch_path(spark, "named")
    tables.dump_named(table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey"), f"{folder}/a", "Code,Country,Region")
    tables.dump_named(table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey"), f"{folder}/b", "Code,Country,Region")
    return spark.read.csv(f"{folder}/*", header=True)


def _document(spark: SparkSession, sf_dir: str, write: Callable[[DataFrame, str], None]) -> DataFrame:
    """A written document line by line, each with its place."""
    folder = scratch_path(spark, "document")
    write(table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment").orderBy("c_custkey"), folder)
    from quayside.operators.numbering import number_rows

    text = lines.read_lines(spark, folder)
    return number_rows(text, ["path", "_block", "_slot"], name="place").select("place", "line")


def _document_sql(head: str, row: str, tail: str, between: str = "") -> str:
    """The lines of a document: head, a line per customer, tail."""
    return f"""SELECT CAST(place AS BIGINT) AS place, line FROM (
  SELECT 1 + n AS place, CASE WHEN n = 1 THEN '' ELSE '{between}' END || row AS line
  FROM (SELECT row_number() OVER (ORDER BY c_custkey) AS n, {row} AS row FROM customer)
  UNION ALL SELECT 1, '{head}'
  UNION ALL SELECT count(*) + 2, '{tail}' FROM customer)"""


@query("whole_json", _document_sql(
    '{"data": [', "CAST(to_json([CAST(c_custkey AS VARCHAR), c_name, c_mktsegment]) AS VARCHAR)", "]}", ", "))
def whole_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6: a JSON document of all rows, written by the executors."""
    return _document(spark, sf_dir, tables.dump_json)


@query("whole_html", _document_sql(
    '<table><thead><tr><th data-sort="string">c_custkey</th><th>c_name</th><th>c_mktsegment</th></tr></thead><tbody>',
    "'<tr><td>' || CAST(c_custkey AS VARCHAR) || '</td><td>' || c_name || '</td><td>' || c_mktsegment || '</td></tr>'",
    "</tbody></table>"))
def whole_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K7: an HTML table of all rows."""
    return _document(spark, sf_dir, lambda df, path: tables.dump_html(df, path, [0]))


@query("whole_markdown", """SELECT CAST(place AS BIGINT) AS place, line FROM (
  SELECT 2 + row_number() OVER (ORDER BY c_custkey) AS place,
         '| ' || CAST(c_custkey AS VARCHAR) || ' | ' || c_name || ' | ' || c_mktsegment || ' |' AS line FROM customer
  UNION ALL SELECT 1, '| c_custkey | c_name | c_mktsegment |'
  UNION ALL SELECT 2, '|-------------- | -------------- | -------------- | '
  UNION ALL SELECT count(*) + 3, '' FROM customer)""")
def whole_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K8: a Markdown table of all rows."""
    return _document(spark, sf_dir, tables.dump_markdown)


def _all_given() -> str:
    return " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c.split(' ')[0]}' AS column_name, CAST({i} AS INTEGER) AS place, CAST(0 AS BIGINT) AS n"
        for t, columns in dictionary.GIVEN.items() for i, c in enumerate(columns.split(", "), 1))


@query("created_like", _all_given())
def created_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An empty table like each given one, distributed by its first column."""
    schema = f"like_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {schema} LOCATION '{scratch_path(spark, 'like')}'")
    rows = []
    for t in TABLES:
        source = table(spark, sf_dir, t)
        tables.create_like(spark, f"{schema}.{t}", source, source.columns[0], 4)
        made = spark.table(f"{schema}.{t}")
        rows += [(t, f.name, i, made.count()) for i, f in enumerate(made.schema, 1) if f.dataType == source.schema[f.name].dataType]
    spark.sql(f"DROP DATABASE {schema} CASCADE")
    return spark.createDataFrame(rows, "table_name string, column_name string, place int, n long")


@query(
    "snake_statements",
    """SELECT n_name, 'create table t (' || lower(n_name) || '_key int, loan_id text, the_rate_of_' || lower(n_name) || ' text)' AS statement,
       lower(n_name) || '_key,loan_id,_state' AS names FROM nation""",
)
def snake_statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A header list and the statement that creates its table, in snake case."""
    rows = []
    for r in table(spark, sf_dir, "nation").collect():
        name = r["n_name"].capitalize()
        columns = [f"{name}Key", "LoanID", f"The Rate(of {name}"]
        sql = f"CREATE TABLE t ({columns[0]} INT, {columns[1]} TEXT, {columns[2]} TEXT)"
        rows.append((r["n_name"], naming.snake_ddl(sql, columns), ",".join(naming.snake_names([f"{name}Key", "LoanID", " State"]))))
    return spark.createDataFrame(rows, "n_name string, statement string, names string")


@query("column_added", "SELECT c_custkey, CAST(NULL AS INTEGER) IS NULL AS empty_number, true AS empty_text FROM customer")
def column_added(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M9: empty columns of known types."""
    rows = merge.add_column(merge.add_column(table(spark, sf_dir, "customer"), "number", "Integer"), "note", "String")
    kinds = dict(rows.dtypes)
    return rows.select("c_custkey", (F.col("number").isNull() & F.lit(kinds["number"] == "int")).alias("empty_number"),
                       (F.col("note").isNull() & F.lit(kinds["note"] == "string")).alias("empty_text"))


@query(
    "unpivot_matching",
    """SELECT year, table_name, col_name, count(*) AS n, CAST(sum(v) AS BIGINT) AS total FROM (
  SELECT 'y2020' AS year, 'orders' AS table_name, 'o_custkey' AS col_name, o_custkey AS v FROM orders
  UNION ALL SELECT 'y2020', 'orders', 'o_orderkey', o_orderkey FROM orders
  UNION ALL SELECT 'y2020', 'supplier', 's_suppkey', s_suppkey FROM supplier) GROUP BY ALL""",
)
def unpivot_matching(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns and tables whose names match, as rows with their table."""
    given = {"orders": table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"),
             "supplier": table(spark, sf_dir, "supplier").select("s_suppkey"), "part": table(spark, sf_dir, "part").select("p_partkey")}
    long = reshape.unpivot_tables(given, "y2020", "orders|supp", ".*_(order|cust|supp)key", keep=[])
    return long.groupBy("year", "table_name", "col_name").agg(F.count(F.lit(1)).alias("n"), F.sum("col_val").alias("total"))


@query(
    "melted_block",
    """SELECT replace(c_name, '#', '') AS dimension, measure, stat_value FROM (
  SELECT c_name, 'segment' AS measure, c_mktsegment AS stat_value FROM customer
  UNION ALL SELECT c_name, 'nation', CAST(c_nationkey AS VARCHAR) FROM customer WHERE c_nationkey % 4 <> 0)""",
)
def melted_block(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R2: the measures of a block as rows; cells that hold the text for nothing are dropped, quotes
    go from every text."""
    rows = table(spark, sf_dir, "customer").select(
        F.replace("c_name", F.lit("#"), F.lit('"')).alias("dimension"), F.concat(F.lit('"'), "c_mktsegment", F.lit('"')).alias("segment"),
        F.when(F.col("c_nationkey") % 4 == 0, reshape.NULL_TEXT).otherwise(F.col("c_nationkey").cast("string")).alias("nation"))
    return reshape.melt_block(rows, ["dimension"])


@query(
    "member_profiles",
    """SELECT CAST(c_custkey // 50 AS BIGINT) AS book, 'data/' || CAST(c_nationkey AS VARCHAR) || '.csv' AS member,
       CAST(2 + c_nationkey % 3 AS INTEGER) AS n_columns FROM customer WHERE (c_custkey // 50) % 7 <> 3 GROUP BY c_custkey // 50, c_nationkey""",
)
def member_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of the members of archives, from their first lines; archives that can't be
    read, and members of other names, give nothing."""
    folder = scratch_path(spark, "packs")

    def pack(batch):
        import zipfile

        import pandas as pd

        book = int(batch["book"].iloc[0])
        path = f"{folder}/{book}.zip"
        sink, name = storage.task_filesystem(path)
        sink.create_dir(name.rsplit("/", 1)[0], recursive=True)
        with sink.open_output_stream(name, compression=None) as out:
            if book % 7 == 3:
                out.write(b"no archive")
            else:
                with zipfile.ZipFile(out, "w") as z:
                    for nation in sorted(set(batch["nation"])):
                        z.writestr(f"data/{nation}.csv", ",".join(["k", '"a,b"', "c", "d"][:2 + nation % 3]) + "\n1,2\n")
                    z.writestr("readme.txt", "x\n")
        return pd.DataFrame({"path": [path], "book": [book]})

    rows = table(spark, sf_dir, "customer").select(
        F.floor(F.col("c_custkey") / 50).alias("book"), F.col("c_nationkey").cast("long").alias("nation"))
    packed = durable(rows.groupBy("book").applyInPandas(pack, "path string, book long"), "packed")
    found = archives.profile_members(listing.list_files(spark, folder), r".*\.csv$")
    return found.filter("error is null").join(packed.withColumnRenamed("path", "parent_path"), "parent_path").select(
        "book", "member", F.col("columns").alias("n_columns"))


@query(
    "file_endings",
    """SELECT CAST(c_custkey // 5000 AS BIGINT) AS book, CAST(c_nationkey AS BIGINT) AS nation, c_nationkey % 2 = 0 AS windows,
       c_nationkey % 3 = 0 AS quoted_header, CAST(2 AS INTEGER) AS fields
FROM customer GROUP BY c_custkey // 5000, c_nationkey""",
)
def file_endings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P10, A4: line ends and header quotes of files, and the median number of fields, all from their heads."""
    from quayside.plans.intake_queries import write_texts

    folder = scratch_path(spark, "endings")
    end = F.when(F.col("nation") % 2 == 0, "\r\n").otherwise("\n")
    head = F.when(F.col("nation") % 3 == 0, '"key","name"').otherwise("key,name")
    rows = table(spark, sf_dir, "customer").select(
        F.floor(F.col("c_custkey") / BOOK_ROWS).alias("book"), F.col("c_nationkey").cast("long").alias("nation"),
        F.concat_ws(",", F.col("c_custkey").cast("string"), "c_name").alias("line"))
    bodies = rows.groupBy("book", "nation").agg(F.sort_array(F.collect_list("line")).alias("lines")).withColumn("end", end)
    text = F.concat(head, F.col("end"), F.array_join(F.transform("lines", lambda x: F.concat(x, F.col("end"))), ""))
    write_texts(bodies.select(F.concat_ws("_", F.col("book").cast("string"), F.concat(F.col("nation").cast("string"), F.lit(".csv"))).alias("place"), text.alias("text")), folder)
    found = durable(listing.list_files(spark, folder), "found")
    endings = lines.line_endings(storage.head_lines(found, 1, keep_cr=True))
    counts = lines.column_counts(storage.head_lines(found, 201))
    base = F.regexp_extract("path", r"(\d+)_(\d+)\.csv$", 1), F.regexp_extract("path", r"(\d+)_(\d+)\.csv$", 2)
    return endings.join(counts, "path").select(
        base[0].cast("long").alias("book"), base[1].cast("long").alias("nation"), "windows", "quoted_header",
        F.col("column_count").alias("fields"))
