"""Queries that run the load job end to end: faults, strict loads, staged merges, rewritten lines, limits, actions."""

from __future__ import annotations

import uuid
from functools import reduce

import yaml
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions.text import KNOWN_PREFIXES
from quayside.operators import quality
from quayside.plans import config
from quayside.plans.delivery_queries import MERGE_SQL, _staging, _target
from quayside.plans.inputs import table
from quayside.plans.intake_queries import BOOK_ROWS, write_texts
from quayside.plans.load_job import LoadJob
from quayside.plans.logs import Logs
from quayside.plans.registry import query
from quayside.session import durable, scratch_path
from quayside.sources import tables


def step_list(*names: str) -> list[dict]:
    return [{"logic": n} for n in names]


class Run:
    """A load job in a database of its own, which goes when the run is over."""

    def __init__(self, spark: SparkSession):
        self.spark, self.schema = spark, f"run_{uuid.uuid4().hex}"
        self.work = scratch_path(spark, "work")

    def __enter__(self) -> Run:
        self.spark.sql(f"CREATE DATABASE {self.schema} LOCATION '{scratch_path(self.spark, 'database')}'")
        return self

    def __exit__(self, *_) -> None:
        self.spark.sql(f"DROP DATABASE {self.schema} CASCADE")

    def load(self, folder: str, mapping: list[dict], **path_settings) -> DataFrame:
        """The catalog after the run."""
        block = {"path": folder, "project_name": "p", **path_settings, "mapping": [
            {"file_type": "CSV", "schema_name": self.schema, **m} for m in mapping]}
        job = LoadJob.from_yaml(self.spark, yaml.safe_dump([block]), self.work, self.schema)
        return durable(job.run(), "catalog")

    def rows(self, name: str) -> DataFrame:
        """A copy of a loaded table, which outlives the database."""
        return durable(self.spark.table(f"{self.schema}.{name}"), "loaded")

    def logs(self) -> Logs:
        return Logs(self.spark, f"{self.work}/logging")


def write_lines(rows: DataFrame, folder: str, head: str, order: str = "c_custkey") -> None:
    """Files by ``place`` of a head and the rows' ``line``; callers keep a file to BOOK_ROWS lines."""
    bodies = rows.groupBy("place").agg(F.array_sort(F.collect_list(F.struct(order, "line"))).alias("lines"))
    write_texts(bodies.select("place", F.concat(F.lit(head), F.array_join("lines.line", "\n"), F.lit("\n")).alias("text")), folder)


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with the file of their nation and block of keys."""
    return table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_mktsegment", F.col("c_nationkey").cast("long").alias("nation"),
        F.floor(F.col("c_custkey") / BOOK_ROWS).alias("book"))


def file_of(ending: str) -> Column:
    return F.concat_ws("_", F.lit("n"), F.col("nation").cast("string"), F.concat(F.col("book").cast("string"), F.lit(ending)))


FILE_SQL = "'n_' || CAST(c_nationkey AS VARCHAR) || '_' || CAST(c_custkey // 5000 AS VARCHAR)"


@query(
    "load_faults",
    f"""SELECT {FILE_SQL} || CASE c_nationkey % 4 WHEN 2 THEN '.zip' WHEN 3 THEN '.dat' ELSE '.csv' END AS file_name,
       CASE c_nationkey % 4 WHEN 0 THEN 'Processed' ELSE 'FAILED' END AS state,
       CASE c_nationkey % 4 WHEN 0 THEN count(*) ELSE 0 END AS n_rows,
       CASE c_nationkey % 4 WHEN 0 THEN '' WHEN 1 THEN 'pandas_import' WHEN 2 THEN 'extract_compressed_file'
            ELSE 'no_such_step' END AS failed_in,
       CASE c_nationkey % 4 WHEN 0 THEN count(*) ELSE 0 END AS n_found
FROM customer GROUP BY c_nationkey, c_custkey // 5000""",
)
def load_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files with a surplus field, files that are no archives and files of a mapping
    with an unknown step fail alone; the others are loaded, the error log tells which step failed."""
    folder = scratch_path(spark, "faults")
    kind = F.col("nation") % 4
    ending = F.element_at(F.array(*[F.lit(e) for e in (".csv", ".csv", ".zip", ".dat")]), (kind + 1).cast("int"))
    last = F.max("c_custkey").over(_file_window())
    line = F.concat_ws(",", F.col("c_custkey").cast("string"), "c_name", F.when((kind == 1) & (F.col("c_custkey") == last), "surplus"))
    rows = customers(spark, sf_dir).withColumn("_e", ending)
    write_lines(rows.select(F.concat(file_of(""), "_e").alias("place"), "c_custkey", line.alias("line")), folder, "key,name\n")
    with Run(spark) as run:
        catalog = run.load(folder, [
            {"file_regex": r".*\.zip$", "file_type": "zip", "process_logic": step_list("extract_compressed_file")},
            {"file_regex": r".*\.dat$", "table_name": "t", "process_logic": step_list("no_such_step", "pandas_import")},
            {"file_regex": r".*\.csv$", "table_name": "t", "append_file_id": True, "process_logic": step_list("pandas_import")},
        ])
        loaded = run.rows("t").groupBy(F.col("file_id").cast("long").alias("id")).agg(F.count(F.lit(1)).alias("n"))
        errors = durable(run.logs().errors.read(), "errors").groupBy(F.col("file_id").alias("id")).agg(F.max("program_unit").alias("unit"))
    return catalog.join(errors, "id", "left").join(loaded, "id", "left").select(
        "file_name", F.col("file_process_state").alias("state"),
        F.coalesce("rows_inserted", F.lit(0)).cast("long").alias("n_rows"), F.coalesce("unit", F.lit("")).alias("failed_in"),
        F.coalesce("n", F.lit(0)).alias("n_found"))


def _file_window():
    from pyspark.sql import Window

    return Window.partitionBy("nation", "book")


@query(
    "strict_load_run",
    """SELECT step, CAST(c_custkey AS VARCHAR) AS k,
       CASE step WHEN 'pg_bulk_copy' THEN '' ELSE '<null>' END AS quoted, '<null>' AS bare, c_name AS name
FROM customer, (VALUES ('client_copy'), ('pg_bulk_copy')) AS s(step) WHERE c_nationkey % 5 <> 0""",
)
def strict_load_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strict loads: files with a short row stay out as a whole; a quoted empty text is
    missing for one importer and a text for the other, a bare one is missing for both."""
    folder = scratch_path(spark, "strict")
    rows = customers(spark, sf_dir)
    short = (F.col("nation") % 5 == 0) & (F.col("c_custkey") == F.max("c_custkey").over(_file_window()))
    line = F.when(short, F.col("c_custkey").cast("string")).otherwise(
        F.concat(F.col("c_custkey").cast("string"), F.lit(',"",,'), F.concat(F.lit('"'), "c_name", F.lit('"'))))
    for step in ("client_copy", "pg_bulk_copy"):
        placed = rows.select(F.concat(F.lit(f"{step}/"), file_of(".csv")).alias("place"), "c_custkey", line.alias("line"))
        write_lines(placed, folder, "k,quoted,bare,name\n")
    with Run(spark) as run:
        run.load(folder, [
            {"file_regex": rf".*/{s}/.*\.csv$", "table_name": s, "process_logic": step_list(s)}
            for s in ("client_copy", "pg_bulk_copy")])
        found = [run.rows(s).withColumn("step", F.lit(s)) for s in ("client_copy", "pg_bulk_copy")]
    shown = [F.coalesce(c, F.lit("<null>")).alias(c) for c in ("quoted", "bare")]
    return found[0].unionByName(found[1]).select("step", "k", *shown, "name")


def _staged_orders(spark: SparkSession, sf_dir: str, run: Run) -> DataFrame:
    """The orders' staging through the load job into a target that holds the older ones."""
    folder = scratch_path(spark, "staged")
    columns = ("o_orderkey", "o_orderstatus", "cents")
    texts = [F.col(c).cast("string").alias(c) for c in columns]
    old = _target(spark, sf_dir).select(F.lit(0).cast("long").alias("file_id"), *texts)
    old.write.saveAsTable(f"{run.schema}.orders")
    tables.dump_csv(_staging(spark, sf_dir).select(*columns), folder, header=True)
    spark.sql(f"CREATE DATABASE {run.schema}_stg LOCATION '{scratch_path(spark, 'database')}'")
    catalog = run.load(folder, [{
        "file_regex": r".*\.csv$", "schema_name": f"{run.schema}_stg", "table_name": "orders", "keys": ["o_orderkey"],
        "process_logic": step_list("pandas_import", "upsert_table_from_stg")}])
    spark.sql(f"DROP DATABASE {run.schema}_stg CASCADE")
    return catalog


@query(
    "staged_upsert_run",
    f"""WITH {MERGE_SQL}
SELECT o_orderkey, o_orderstatus, cents, action IN ('insert', 'update') AS from_file FROM result""",
)
def staged_upsert_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1, M2, M4: files staged by the load job and merged by key; unchanged rows keep their id."""
    with Run(spark) as run:
        _staged_orders(spark, sf_dir, run)
        merged = run.rows("orders")
    return merged.select(
        F.col("o_orderkey").cast("long").alias("o_orderkey"), "o_orderstatus", F.col("cents").cast("long").alias("cents"),
        (F.col("file_id") != 0).alias("from_file"))


@query(
    "staged_upsert_status",
    f"""WITH {MERGE_SQL}
SELECT 'orders' AS table_name, 'upsert_table_from_stg' AS program_unit, 'Y' AS success,
       (SELECT count(*) FROM target) AS previous_record_count,
       count(*) FILTER (action = 'insert') AS records_inserted, count(*) FILTER (action = 'update') AS records_updated,
       CAST(0 AS BIGINT) AS records_deleted, count(*) AS current_record_count FROM result""",
)
def staged_upsert_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The status row that a staged merge leaves."""
    with Run(spark) as run:
        _staged_orders(spark, sf_dir, run)
        status = durable(run.logs().status.read(), "status")
    return status.select(
        F.substring_index("table_name", ".", -1).alias("table_name"), "program_unit", "success", "previous_record_count",
        "records_inserted", "records_updated", "records_deleted", "current_record_count")


PREFIX_SQL = "[" + ", ".join("'" + p.replace("'", "''") + "'" for p in KNOWN_PREFIXES) + "]"


@query(
    "rewrite_run",
    f"""SELECT 'prefix' AS kind, ({PREFIX_SQL})[CAST(c_custkey % {len(KNOWN_PREFIXES)} AS INTEGER) + 1] AS a,
       CAST(c_custkey AS VARCHAR) AS b FROM customer
UNION ALL SELECT 'quotes', c_name || ' "the ' || c_mktsegment || '" one', CAST(c_custkey AS VARCHAR) FROM customer""",
)
def rewrite_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines rewritten on their way into the table: known prefixes with delimiters are
    quoted, bare quotes inside quoted fields doubled."""
    folder = scratch_path(spark, "rewrite")
    rows = customers(spark, sf_dir)
    prefix = F.element_at(F.array(*[F.lit(p) for p in KNOWN_PREFIXES]), (F.col("c_custkey") % len(KNOWN_PREFIXES) + 1).cast("int"))
    key = F.col("c_custkey").cast("string")
    quoted = F.concat(F.lit('"'), "c_name", F.lit(' "the '), "c_mktsegment", F.lit('" one","'), key, F.lit('"'))
    for kind, line in (("prefix", F.concat_ws(",", prefix, key)), ("quotes", quoted)):
        placed = rows.select(F.concat(F.lit(f"{kind}/"), file_of(".csv")).alias("place"), "c_custkey", line.alias("line"))
        write_lines(placed, folder, "a,b\n")
    with Run(spark) as run:
        run.load(folder, [
            {"file_regex": r".*/prefix/.*csv$", "table_name": "prefix", "process_logic": step_list("sed_modify_file", "pandas_import")},
            {"file_regex": r".*/quotes/.*csv$", "table_name": "quotes", "new_delimiter": ",", "process_logic": step_list("pandas_import")},
        ])
        found = [run.rows(k).select(F.lit(k).alias("kind"), "a", "b") for k in ("prefix", "quotes")]
    return found[0].unionByName(found[1])


@query(
    "limit_run",
    f"""SELECT {FILE_SQL} || '.csv' AS file_name, CAST(c_custkey AS VARCHAR) AS k, c_name AS name,
       md5(CAST(c_custkey AS VARCHAR) || ',' || c_name) AS crc
FROM customer QUALIFY row_number() OVER (PARTITION BY c_nationkey, c_custkey // 5000 ORDER BY c_custkey) <= 7""",
)
def limit_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first rows below two title lines and a header of every file, with the
    checksum of their lines and the id of their file."""
    folder = scratch_path(spark, "limits")
    line = F.concat_ws(",", F.col("c_custkey").cast("string"), "c_name")
    write_lines(customers(spark, sf_dir).select(file_of(".csv").alias("place"), "c_custkey", line.alias("line")),
                folder, "a title\nanother, one\nk,name\n")
    with Run(spark) as run:
        catalog = run.load(folder, [{
            "file_regex": r".*csv$", "table_name": "t", "limit_rows": 7, "header_row_location": 2, "append_crc": True,
            "append_file_id": True, "process_logic": step_list("pandas_import")}])
        loaded = run.rows("t")
    names = catalog.select(F.col("id").alias("file_id"), "file_name")
    return loaded.withColumn("file_id", F.col("file_id").cast("long")).join(names, "file_id").select("file_name", "k", "name", "crc")


@query(
    "action_run",
    f"""SELECT kind, file_name, n FROM (
  SELECT 'set' AS kind, {FILE_SQL} || '.csv' AS file_name, count(*) AS n FROM customer GROUP BY c_nationkey, c_custkey // 5000
  UNION ALL SELECT 'each', {FILE_SQL} || '.csv', count(*) FROM customer GROUP BY c_nationkey, c_custkey // 5000
  UNION ALL SELECT 'once', '', 1)""",
)
def action_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M7: statements after a load: one for all files of the pass, one that counts the rows of each file
    on its own, and one that names no file."""
    folder = scratch_path(spark, "actions")
    line = F.concat_ws(",", F.col("c_custkey").cast("string"), "c_name")
    write_lines(customers(spark, sf_dir).select(file_of(".csv").alias("place"), "c_custkey", line.alias("line")), folder, "k,name\n")
    with Run(spark) as run:
        spark.sql(f"CREATE TABLE {run.schema}.audit (file_id long, k string) USING parquet")
        spark.sql(f"CREATE TABLE {run.schema}.sizes (file_id long, n long) USING parquet")
        spark.sql(f"CREATE TABLE {run.schema}.runs (n int) USING parquet")
        catalog = run.load(folder, [{
            "file_regex": r".*csv$", "table_name": "t", "append_file_id": True, "process_logic": step_list("pandas_import"),
            "post_action": [
                {"sql": "insert into {schema_name}.audit select file_id, k from {schema_name}.{table_name} where file_id = {file_id}"},
                {"sql": "insert into {schema_name}.sizes select {file_id}, count(1) from {schema_name}.{table_name} where file_id = '{file_id}'"},
                {"sql": "insert into {schema_name}.runs values (1)"},
                {"sql": "vacuum analyze {schema_name}.{table_name}"},
            ]}])
        audit = run.rows("audit").groupBy("file_id").agg(F.count(F.lit(1)).alias("n"))
        sizes, once = run.rows("sizes"), run.rows("runs").agg(F.count(F.lit(1)).alias("n"))
    names = catalog.select(F.col("id").alias("file_id"), "file_name")
    parts = [d.join(names, "file_id").select(F.lit(k).alias("kind"), "file_name", "n") for k, d in (("set", audit), ("each", sizes))]
    return parts[0].unionByName(parts[1]).unionByName(once.select(F.lit("once").alias("kind"), F.lit("").alias("file_name"), "n"))


@query(
    "config_rows",
    """SELECT CAST(n_nationkey AS INTEGER) AS place, '.*' || lower(n_name) || '.*' AS file_regex, 'p' || CAST(n_regionkey AS VARCHAR) AS project,
       CASE WHEN n_nationkey < 3 THEN 'first' WHEN n_nationkey < 9 THEN 't3' ELSE 't9' END AS table_name,
       CASE WHEN n_nationkey % 2 = 0 THEN 'generate_checksum,pandas_import' ELSE 'generate_checksum' END AS steps,
       CASE WHEN n_nationkey % 5 = 0 THEN CAST(n_nationkey + 1 AS INTEGER) ELSE 100 END AS limit_rows,
       n_nationkey % 3 = 0 AS reprocess FROM nation""",
)
def config_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mapping rows of a configuration written from the nations: a table name stays for the
    entries after it, limits and reprocessing come from the path, steps of the path run first."""
    blocks = []
    for r in table(spark, sf_dir, "nation").orderBy("n_nationkey").collect():
        k = r["n_nationkey"]
        entry = {"file_regex": f".*{r['n_name'].lower()}.*", "file_type": "CSV", "reprocess": k % 3 == 0}
        if k % 2 == 0:
            entry["process_logic"] = step_list("custom_logic.pandas_import")
        if k % 5 == 0:
            entry["limit_rows"] = str(k + 1)
        blocks.append({
            "path": f"/in/{k}", "project_name": f"p{r['n_regionkey']}", "limit_rows": 100,
            "table_name": "first" if k < 3 else "t3" if k < 9 else "t9",
            "process_logic": step_list("custom_logic.generate_checksum"), "mapping": [entry]})
    blocks.append({"path": "/off", "enabled": False, "project_name": "off", "mapping": [{"file_regex": "x", "file_type": "CSV"}]})
    rows = [
        (m.order, m.file_regex, m.project_name, m.table_name, ",".join(m.steps), m.limit_rows, bool(m.reprocess))
        for m in config.read_mappings(yaml.safe_dump(blocks))]
    return spark.createDataFrame(
        rows, "place int, file_regex string, project string, table_name string, steps string, limit_rows int, reprocess boolean")


@query(
    "filled_statements",
    """SELECT n_name, 'delete from src' || CAST(n_regionkey AS VARCHAR) || '.nation_' || CAST(n_nationkey AS VARCHAR)
       || ' where file_id IN (SELECT file_id FROM ids)' AS wide,
       'select count(*) from src' || CAST(n_regionkey AS VARCHAR) || '.nation_' || CAST(n_nationkey AS VARCHAR)
       || ' where x = :file_id' AS narrow, 'load ' || n_name || ' into pub.' || n_name AS filled FROM nation""",
)
def filled_statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names and values put into configured statements, and the form for sets of files."""
    out = []
    for r in table(spark, sf_dir, "nation").collect():
        schema, name = f"src{r['n_regionkey']}", f"nation_{r['n_nationkey']}"
        bound = config.bind_sql("delete from {schema_name}.{table_name} where file_id = {file_id}", schema, name, None)
        narrow = config.bind_sql("select count(*) from {schema_name}.{table_name} where x = '{file_id}'", schema, name, None)
        filled = config.fill_templates({"name": r["n_name"], "db": {"schema": "pub"}, "sql": ["load {{name}} into {{schema}}.{{name}}"]},
                                       {"name": r["n_name"], "db": {"schema": "pub"}})
        wide, _ = config.over_files(bound, "ids")
        out.append((r["n_name"], wide, narrow if config.over_files(narrow, "ids")[0] is None else "", filled["sql"][0]))
    return spark.createDataFrame(out, "n_name string, wide string, narrow string, filled string")


@query(
    "reconcile_run",
    """SELECT 'load_' || CAST(c_nationkey % 3 AS VARCHAR) AS table_name, count(*) AS rows_recorded,
       count(*) + CASE WHEN c_nationkey % 3 = 1 THEN 2 ELSE 0 END AS rows_present,
       CAST(CASE WHEN c_nationkey % 3 = 1 THEN 2 ELSE 0 END AS BIGINT) AS difference
FROM customer GROUP BY c_nationkey % 3""",
)
def reconcile_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that the catalog recorded for each table against rows found in it, after
    two rows were put into one table behind the job's back. The files of all three tables are one
    read and one write."""
    folder = scratch_path(spark, "reconcile")
    line = F.concat_ws(",", F.col("c_custkey").cast("string"), "c_name")
    place = F.concat(F.lit("load_"), (F.col("nation") % 3).cast("string"), F.lit("-"), file_of(".csv"))
    write_lines(customers(spark, sf_dir).select(place.alias("place"), "c_custkey", line.alias("line")), folder, "k,name\n")
    with Run(spark) as run:
        catalog = run.load(folder, [{
            "file_regex": r".*csv$", "table_name_extract": r"(load_\d).*", "process_logic": step_list("pandas_import")}])
        spark.sql(f"INSERT INTO {run.schema}.load_1 VALUES ('x', 'y'), ('x', 'z')")
        counts = [run.rows(f"load_{k}").agg(F.count(F.lit(1)).alias("rows")).withColumn("table_name", F.lit(f"load_{k}")) for k in range(3)]
    recorded = catalog.select(F.substring_index("database_table", ".", -1).alias("table_name"), F.col("rows_inserted").alias("rows"))
    present = reduce(DataFrame.unionByName, counts)
    return quality.reconcile(recorded, present, "table_name")
