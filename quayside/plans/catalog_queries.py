"""Queries on the file catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions import paths, text
from quayside.operators import catalog as cat
from quayside.operators import mapping
from quayside.operators.skew import lookup_join
from quayside.plans.inputs import FILES_SQL, files, table
from quayside.plans.registry import query

YEAR = r"\d{4}"

# The date of a file: a member takes the one in its archive's name.
DATED_SQL = f"""WITH {FILES_SQL}, dated AS (
  SELECT f.*, CAST(make_date(CAST(regexp_extract(coalesce(p.file_name, f.file_name), '[0-9]{{4}}')
                             AS BIGINT), 1, 1) AS VARCHAR) AS file_name_data
  FROM files f LEFT JOIN files p ON f.parent_file_id = p.file_id)"""


@query(
    "load_reconciliation",
    f"""WITH {FILES_SQL}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY project_name, crc
                               ORDER BY parent_file_id, file_path, file_name) AS copy_no
  FROM files WHERE file_process_state = 'Processed'),
 loaded AS (SELECT file_id FROM ranked WHERE copy_no = 1),
 per_file AS (SELECT l_suppkey + 1 AS file_id, count(*) AS n FROM lineitem GROUP BY 1)
SELECT f.project_name,
       count(*) AS files_total,
       count(l.file_id) AS files_loaded,
       CAST(coalesce(sum(p.n), 0) AS BIGINT) AS rows_source,
       CAST(coalesce(sum(CASE WHEN l.file_id IS NOT NULL THEN p.n END), 0) AS BIGINT) AS rows_loaded,
       CAST(coalesce(sum(p.n), 0) - coalesce(sum(CASE WHEN l.file_id IS NOT NULL THEN p.n END), 0)
            AS BIGINT) AS rows_missing
FROM files f LEFT JOIN loaded l ON f.file_id = l.file_id
     LEFT JOIN per_file p ON f.file_id = p.file_id
GROUP BY f.project_name""",
)
def load_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A12 with A18 and J3: rows of the source files against rows of the files that were loaded."""
    catalog = files(spark, sf_dir)
    order = [F.col("parent_file_id"), F.col("file_path"), F.col("file_name")]
    loaded = cat.first_copies(catalog, order).select("file_id", F.lit(True).alias("loaded"))
    per_file = (
        table(spark, sf_dir, "lineitem")
        .groupBy((F.col("l_suppkey") + 1).alias("file_id"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    rows = F.coalesce(F.sum("n"), F.lit(0))
    rows_loaded = F.coalesce(F.sum(F.when(F.col("loaded"), F.col("n"))), F.lit(0))
    return (
        catalog.select("file_id", "project_name")
        .join(loaded, "file_id", "left")
        .join(per_file, "file_id", "left")
        .groupBy("project_name")
        .agg(
            F.count(F.lit(1)).alias("files_total"),
            F.count("loaded").alias("files_loaded"),
            rows.alias("rows_source"),
            rows_loaded.alias("rows_loaded"),
            (rows - rows_loaded).alias("rows_missing"),
        )
    )


@query(
    "new_files",
    f"""WITH {FILES_SQL}, known AS (
  SELECT file_name, file_path FROM files WHERE file_process_state <> 'RAW')
SELECT file_name, file_path, project_name, crc FROM files f
WHERE NOT EXISTS (SELECT 1 FROM known k
                  WHERE k.file_name = f.file_name AND k.file_path = f.file_path)""",
)
def new_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalog knows the files that were worked on before."""
    listing = files(spark, sf_dir)
    known = listing.filter(F.col("file_process_state") != cat.RAW)
    return cat.unseen_files(listing, known).select("file_name", "file_path", "project_name", "crc")


@query(
    "work_order",
    f"""{DATED_SQL}
SELECT file_id, file_name_data,
       row_number() OVER (ORDER BY file_name_data NULLS LAST, parent_file_id, file_path, file_name)
         AS position
FROM dated WHERE file_process_state = 'RAW' AND reprocess""",
)
def work_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    dated = cat.file_dates(files(spark, sf_dir), YEAR, "YYYY")
    return cat.work_order(dated).select("file_id", "file_name_data", "position")


@query(
    "file_name_date",
    f"""{DATED_SQL}
SELECT file_id, parent_file_id, file_name, file_name_data FROM dated""",
)
def file_name_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    dated = cat.file_dates(files(spark, sf_dir), YEAR, "YYYY")
    return dated.select("file_id", "parent_file_id", "file_name", "file_name_data")


@query(
    "table_from_name",
    f"""WITH {FILES_SQL}
SELECT file_id,
       lower(replace(replace(regexp_extract(file_name, '^([a-z]+[0-9]+_[0-9]{{4}})_', 1),
                             '-', '_'), '.', '_')) AS table_name,
       replace(lower(file_name), '.', '_') AS default_table_name
FROM files""",
)
def table_from_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table in group 1 of the name pattern, and the default made from the whole name."""
    name = F.col("file_name")
    return files(spark, sf_dir).select(
        "file_id",
        paths.table_from_name(name, r"^([a-z]+[0-9]+_[0-9]{4})_").alias("table_name"),
        paths.table_from_name(name).alias("default_table_name"),
    )


@query(
    "duplicate_files",
    f"""WITH {FILES_SQL}
SELECT b.file_id, b.project_name, b.crc FROM files b
WHERE EXISTS (SELECT 1 FROM files a WHERE a.file_process_state = 'Processed' AND a.crc = b.crc
              AND a.project_name = b.project_name AND a.file_id <> b.file_id)""",
)
def duplicate_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cat.duplicate_files(files(spark, sf_dir)).select("file_id", "project_name", "crc")


FINISHED_SQL = f"""WITH {FILES_SQL}, finished AS (
  SELECT DISTINCT p.file_id, p.file_name, p.file_path
  FROM files p LEFT JOIN files c ON c.parent_file_id = p.file_id
       AND c.file_process_state <> 'Processed' AND NOT c.duplicate_file
  WHERE p.parent_file_id = 0 AND p.file_process_state = 'Processed' AND c.file_id IS NULL)"""


@query("finished_imports", f"{FINISHED_SQL} SELECT * FROM finished")
def finished_imports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cat.finished_imports(files(spark, sf_dir)).select("file_id", "file_name", "file_path")


@query(
    "finished_children",
    f"""{FINISHED_SQL}
SELECT c.file_id, c.parent_file_id, f.file_name AS parent_file_name
FROM files c JOIN finished f ON c.parent_file_id = f.file_id""",
)
def finished_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cat.finished_children(files(spark, sf_dir)).select(
        "file_id", "parent_file_id", "parent_file_name"
    )


@query(
    "children_per_parent",
    f"""WITH {FILES_SQL}
SELECT parent_file_id, count(*) AS total_files FROM files WHERE parent_file_id > 0
GROUP BY parent_file_id""",
)
def children_per_parent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cat.children_per_parent(files(spark, sf_dir))


def _reset_sql(hit: str, reprocess: str = "reprocess") -> str:
    return f"""WITH {FILES_SQL}, marked AS (SELECT *, {hit} AS hit FROM files)
SELECT file_id, CASE WHEN hit THEN 'RAW' ELSE file_process_state END AS file_process_state,
       {reprocess} AS reprocess,
       CASE WHEN hit THEN false ELSE duplicate_file END AS duplicate_file
FROM marked"""


def _reset(spark: SparkSession, sf_dir: str, option: str) -> DataFrame:
    return cat.reset_files(files(spark, sf_dir), option).select(
        "file_id", "file_process_state", "reprocess", "duplicate_file"
    )


@query("reset_all", _reset_sql("true", "true"))
def reset_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reset(spark, sf_dir, "ALL")


@query("reset_failed", _reset_sql("(upper(file_process_state) = 'FAILED' AND reprocess)"))
def reset_failed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reset(spark, sf_dir, "FAILED")


@query(
    "reset_raw",
    _reset_sql("(upper(file_process_state) = 'RAW' AND file_type IN ('CSV', 'DATA'))"),
)
def reset_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reset(spark, sf_dir, "RAW")


@query("reset_data", _reset_sql("(file_type IN ('CSV', 'DATA'))"))
def reset_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reset(spark, sf_dir, "DATA")


@query(
    "latest_state",
    """SELECT user_id AS file_id,
       arg_max(event_type, (ts, event_id)) AS state,
       arg_max(props, (ts, event_id)) FILTER (WHERE event_type = 'error') AS last_message,
       count(*) AS changes
FROM events GROUP BY user_id""",
)
def latest_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O2, M6: the state of a file is its newest step; only errors carry a message."""
    steps = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("file_id"), F.col("event_type").alias("state"), "ts", "event_id",
        F.when(F.col("event_type") == "error", F.col("props")).alias("message"),
    )
    return cat.latest_state(steps, "file_id", "state", ["ts", "event_id"], "message")


@query(
    "process_trail",
    """SELECT user_id AS file_id, event_type AS step,
       row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS trail_pos
FROM events""",
)
def process_trail(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("file_id"), F.col("event_type").alias("step"), "ts", "event_id"
    )
    return cat.process_trail(steps, "file_id", "step", [F.desc("ts"), F.desc("event_id")])


@query(
    "publish_errors",
    f"""WITH {FILES_SQL}, log AS (
  SELECT user_id * 100 + day(ts) AS data_id, user_id + 1 AS file_id,
         CASE WHEN event_type = 'error' THEN 0 ELSE 1 END AS row_counts FROM events),
 named AS (SELECT l.*, f.file_name, f.file_path FROM log l LEFT JOIN files f USING (file_id))
SELECT DISTINCT y.data_id, y.file_name, y.file_path
FROM (SELECT data_id FROM named GROUP BY data_id HAVING count(*) > 1 AND max(row_counts) = 0) x
JOIN named y ON x.data_id = y.data_id""",
)
def publish_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file is published once a day; a try that ended in an error published no row."""
    log = table(spark, sf_dir, "events").select(
        (F.col("user_id") * 100 + F.dayofmonth("ts")).alias("data_id"),
        (F.col("user_id") + 1).alias("file_id"),
        F.when(F.col("event_type") == "error", 0).otherwise(1).alias("row_counts"),
    )
    names = files(spark, sf_dir).select("file_id", "file_name", "file_path")
    return cat.publish_errors(lookup_join(log, names, ["file_id"], "left"))


@query(
    "path_parts",
    """SELECT page_id, regexp_extract(url, '^(.*)/([^/]*)$', 1) AS file_path,
       regexp_extract(url, '([^/]*)$', 1) AS file_name,
       upper(list_extract(string_split(regexp_extract(url, '([^/]*)$', 1), '.'), -1)) AS file_type
FROM pages""",
)
def path_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.col("url")
    return table(spark, sf_dir, "pages").select(
        "page_id",
        paths.directory(url).alias("file_path"),
        paths.base_name(url).alias("file_name"),
        paths.extension(paths.base_name(url)).alias("file_type"),
    )


# Mapping patterns in configuration order; plain http pages of other languages stay unmatched.
URL_PATTERNS = (r"https?://BLOG\.", r".*utm_source", r".*/en/", r"https://")


@query(
    "first_match",
    """SELECT page_id, CASE
         WHEN regexp_matches(url, '(?i)^(?:https?://BLOG\\.)') THEN 'https?://BLOG\\.'
         WHEN regexp_matches(url, '(?i)^(?:.*utm_source)') THEN '.*utm_source'
         WHEN regexp_matches(url, '(?i)^(?:.*/en/)') THEN '.*/en/'
         WHEN regexp_matches(url, '(?i)^(?:https://)') THEN 'https://' END AS file_regex
FROM pages""",
)
def first_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pattern that decides a page's mapping, NULL when there is no configuration for it."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    mapped = mapping.map_files(pages, F.col("url"), URL_PATTERNS)
    pattern = F.get(F.array(*[F.lit(p) for p in URL_PATTERNS]), F.col("mapping"))
    return mapped.select("page_id", pattern.alias("file_regex"))


@query(
    "file_checksums",
    "SELECT doc_id, md5(text) AS crc FROM documents",
)
def file_checksums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The checksum of each whole file."""
    return table(spark, sf_dir, "documents").select("doc_id", F.md5("text").alias("crc"))


@query(
    "file_sizes",
    """SELECT doc_id, CAST(strlen(text) AS BIGINT) AS file_size,
       round(strlen(text) / 1024 / 1024, 2) AS size_mb FROM documents""",
)
def file_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and megabytes of each file."""
    size = F.octet_length("text").cast("long")
    return table(spark, sf_dir, "documents").select(
        "doc_id", size.alias("file_size"), cat.size_mb(size).alias("size_mb")
    )


@query(
    "lines_per_doc",
    """SELECT doc_id,
       CAST(len(text) - len(replace(text, chr(10), ''))
            + CASE WHEN text <> '' AND NOT ends_with(text, chr(10)) THEN 1 ELSE 0 END AS BIGINT)
         AS lines,
       CAST(len(text) - len(replace(text, chr(10), '')) AS BIGINT) AS newlines
FROM documents""",
)
def lines_per_doc(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = F.col("text")
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        text.line_count(body).alias("lines"),
        text.line_count(body, newlines_only=True).alias("newlines"),
    )
