"""Queries that merge, deliver, check and document tables."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.operators import deliver, merge, numbering, quality
from quayside.operators.skew import lookup_join
from quayside.plans.inputs import FILES_SQL, TABLES, files, table
from quayside.plans.registry import query
from quayside.session import durable, scratch_path
from quayside.sources import delimited, html, tables
from quayside.plans import dictionary

# --- merges: the target holds the orders before 1999, staging those from 1997 on, with the price
# of closed orders corrected; 1997 and 1998 are on both sides.

ORDER_COLUMNS = ("o_orderkey", "o_orderstatus", "cents", "file_id")


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").withColumn(
        "cents", F.round(F.col("o_totalprice") * 100).cast("long")
    )


def _target(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _orders(spark, sf_dir).filter("o_orderdate < timestamp'1999-01-01'")
        .withColumn("file_id", F.lit(1).cast("long")).select(*ORDER_COLUMNS)
    )


def _staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _orders(spark, sf_dir).filter("o_orderdate >= timestamp'1997-01-01'")
        .withColumn("cents", F.col("cents") + F.when(F.col("o_orderstatus") == "F", 100).otherwise(0))
        .withColumn("file_id", F.lit(2).cast("long")).select(*ORDER_COLUMNS)
    )


MERGE_SQL = """priced AS (SELECT *, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders),
 target AS (SELECT o_orderkey, o_orderstatus, cents, CAST(1 AS BIGINT) AS file_id FROM priced
            WHERE o_orderdate < TIMESTAMP '1999-01-01'),
 staging AS (SELECT o_orderkey, o_orderstatus,
                    cents + CASE WHEN o_orderstatus = 'F' THEN 100 ELSE 0 END AS cents,
                    CAST(2 AS BIGINT) AS file_id FROM priced
             WHERE o_orderdate >= TIMESTAMP '1997-01-01'),
 merged AS (
  SELECT coalesce(t.o_orderkey, s.o_orderkey) AS o_orderkey,
    CASE WHEN t.o_orderkey IS NULL THEN 'insert' WHEN s.o_orderkey IS NULL THEN 'target_only'
         WHEN t.o_orderstatus IS DISTINCT FROM s.o_orderstatus OR t.cents IS DISTINCT FROM s.cents
           THEN 'update' ELSE 'unchanged' END AS action,
    t.o_orderstatus AS t_status, s.o_orderstatus AS s_status, t.cents AS t_cents,
    s.cents AS s_cents, t.file_id AS t_file, s.file_id AS s_file
  FROM target t FULL JOIN staging s ON t.o_orderkey = s.o_orderkey),
 result AS (
  SELECT o_orderkey, action,
    CASE WHEN action IN ('insert', 'update') THEN s_status ELSE t_status END AS o_orderstatus,
    CASE WHEN action IN ('insert', 'update') THEN s_cents ELSE t_cents END AS cents,
    CASE WHEN action IN ('insert', 'update') THEN s_file ELSE t_file END AS file_id FROM merged)"""


@query("upsert_result", f"WITH {MERGE_SQL} SELECT * FROM result")
def upsert_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1: the table after the merge."""
    return merge.merge_rows(_target(spark, sf_dir), _staging(spark, sf_dir), ["o_orderkey"])


@query("upsert_actions", f"WITH {MERGE_SQL} SELECT action, count(*) AS n FROM result GROUP BY action")
def upsert_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsert_result(spark, sf_dir).groupBy("action").agg(F.count(F.lit(1)).alias("n"))


@query(
    "upsert_straight",
    f"""WITH {MERGE_SQL}
SELECT o_orderkey, coalesce(s_status, t_status) AS o_orderstatus, coalesce(s_cents, t_cents) AS cents,
       coalesce(s_file, t_file) AS file_id FROM merged""",
)
def upsert_straight(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M3: staging always wins."""
    return merge.merge_rows(
        _target(spark, sf_dir), _staging(spark, sf_dir), ["o_orderkey"], check_changes=False
    ).drop("action")


@query(
    "upsert_nokey",
    f"""WITH {MERGE_SQL}
SELECT o_orderkey, o_orderstatus, cents, file_id FROM target
UNION ALL SELECT o_orderkey, o_orderstatus, cents, 9 FROM staging""",
)
def upsert_nokey(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2: without a key the staged rows are stamped and appended."""
    return merge.load_from_staging(_target(spark, sf_dir), _staging(spark, sf_dir), [], 9)


@query(
    "load_status_row",
    f"""WITH {MERGE_SQL}
SELECT 'publish.orders' AS table_name, 'publish.orders_upsert' AS program_unit,
  'UPSERT' AS program_unit_type_code, 'Y' AS success,
  (SELECT count(*) FROM target) AS previous_record_count,
  count(*) FILTER (WHERE action = 'insert') AS records_inserted,
  count(*) FILTER (WHERE action = 'update') AS records_updated,
  CAST(0 AS BIGINT) AS records_deleted, count(*) AS current_record_count
FROM result""",
)
def load_status_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = _target(spark, sf_dir)
    merged = merge.merge_rows(target, _staging(spark, sf_dir), ["o_orderkey"])
    return merge.load_status(target, merged, "publish.orders", "publish.orders_upsert")


@query(
    "insert_ignore",
    f"""WITH {MERGE_SQL}
SELECT * FROM staging s WHERE NOT EXISTS (SELECT 1 FROM target t WHERE t.o_orderkey = s.o_orderkey)""",
)
def insert_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only orders the target lacks."""
    return merge.insert_ignore(_target(spark, sf_dir), _staging(spark, sf_dir), ["o_orderkey"])


@query(
    "append_counts",
    f"""WITH {MERGE_SQL}
SELECT file_id, o_orderstatus, count(*) AS n FROM (
  SELECT o_orderkey, o_orderstatus, cents, file_id FROM target UNION ALL SELECT * FROM staging)
GROUP BY ALL""",
)
def append_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1: a real append to a table; the staged columns come in another order."""
    target = tables.VersionedTable(spark, scratch_path(spark, "append"), _target(spark, sf_dir).schema)
    target.replace(_target(spark, sf_dir))
    staged = _staging(spark, sf_dir)
    target.append(staged.select(*reversed(staged.columns)))
    return target.read().groupBy("file_id", "o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query(
    "conditional_update",
    f"""WITH {MERGE_SQL}
SELECT o_orderkey, CASE WHEN file_id = 0 THEN 7 ELSE file_id END AS file_id
FROM (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 0 ELSE o_orderkey END AS file_id FROM orders)""",
)
def conditional_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M8: rows that were loaded without a file id get one."""
    loaded = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "P", F.lit(0).cast("long"))
        .otherwise(F.col("o_orderkey")).alias("file_id"),
    )
    return merge.set_where(loaded, "file_id", F.lit(7), F.col("file_id") == 0)


# --- deliveries: the rows of a file are the line items of a supplier; suppliers with a positive
# balance were delivered before.

LINE_SQL = """lines AS (SELECT l_suppkey + 1 AS file_id, l_returnflag,
  CAST(round(l_extendedprice * 100) AS BIGINT) AS cents FROM lineitem),
 sent AS (SELECT s_suppkey + 1 AS file_id FROM supplier WHERE s_acctbal > 0)"""


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_suppkey") + 1).alias("file_id"), "l_returnflag",
        F.round(F.col("l_extendedprice") * 100).cast("long").alias("cents"),
    )


def _sent_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").filter("s_acctbal > 0").select(
        (F.col("s_suppkey") + 1).alias("file_id")
    )


def _per_file(rows: DataFrame) -> DataFrame:
    return rows.groupBy("file_id").agg(F.count(F.lit(1)).alias("n"), F.sum("cents").alias("cents"))


PER_FILE_SQL = "SELECT file_id, count(*) AS n, CAST(sum(cents) AS BIGINT) AS cents FROM"


@query(
    "deliver_file_id",
    f"""WITH {LINE_SQL} {PER_FILE_SQL} lines WHERE file_id NOT IN
  (SELECT file_id FROM lines WHERE file_id IN (SELECT file_id FROM sent)) GROUP BY file_id""",
)
def deliver_file_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L3: files of the source that the target has no row of."""
    source = _lines(spark, sf_dir)
    target = lookup_join(source, _sent_ids(spark, sf_dir), ["file_id"], "left_semi")
    return _per_file(deliver.deliver_file_id(source, target))


@query(
    "deliver_killfill",
    f"""WITH {LINE_SQL}
SELECT l_returnflag, count(*) AS n, CAST(sum(cents) AS BIGINT) AS cents FROM lines GROUP BY 1""",
)
def deliver_killfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2: the target's old rows are replaced as a whole."""
    source = _lines(spark, sf_dir)
    target = tables.VersionedTable(spark, scratch_path(spark, "killfill"), source.schema)
    target.replace(lookup_join(source, _sent_ids(spark, sf_dir), ["file_id"], "left_semi"))
    target.replace(source)
    return target.read().groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.sum("cents").alias("cents")
    )


@query(
    "deliver_project",
    f"""WITH {LINE_SQL} {PER_FILE_SQL} lines WHERE file_id IN (
  SELECT s_suppkey + 1 FROM supplier JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA') GROUP BY file_id""",
)
def deliver_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of the files of one project; projects are regions."""
    nations = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    catalog = table(spark, sf_dir, "supplier").join(
        nations, F.col("s_nationkey") == F.col("n_nationkey")
    ).select((F.col("s_suppkey") + 1).alias("file_id"), F.col("r_name").alias("project_name"))
    return _per_file(deliver.deliver_project(_lines(spark, sf_dir), catalog, "ASIA"))


LATEST_SQL = """latest AS (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS r
  FROM events WHERE {0})"""


@query(
    "deliver_last_update",
    f"""WITH {LATEST_SQL.format("ts < TIMESTAMP '2024-01-20'")},
 target AS (SELECT user_id, event_type, ts, event_id FROM latest WHERE r = 1),
 fresh AS (SELECT user_id, event_type, ts, event_id, row_number() OVER (
             PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS r
           FROM events WHERE ts > (SELECT max(ts) FROM target)),
 newest AS (SELECT user_id, event_type, ts, event_id FROM fresh WHERE r = 1)
SELECT t.user_id, t.event_type, t.event_id, 'target_only' AS action FROM target t
WHERE NOT EXISTS (SELECT 1 FROM newest n WHERE n.user_id = t.user_id AND n.event_type = t.event_type)
UNION ALL
SELECT n.user_id, n.event_type, n.event_id, CASE WHEN EXISTS (SELECT 1 FROM target t
  WHERE n.user_id = t.user_id AND n.event_type = t.event_type) THEN 'update' ELSE 'insert' END
FROM newest n""",
)
def deliver_last_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L4: the target ends on 19 January; newer rows replace it key by key."""
    source = table(spark, sf_dir, "events").select("user_id", "event_type", "ts", "event_id")
    keys = ["user_id", "event_type"]
    target = (
        source.filter("ts < timestamp'2024-01-20'").groupBy(*keys)
        .agg(F.max(F.struct("ts", "event_id")).alias("r")).select(*keys, "r.*")
    )
    return deliver.deliver_last_update(source, target, keys, "ts", "event_id").drop("ts")


@query(
    "id_delta",
    "SELECT o_orderkey AS id FROM orders EXCEPT SELECT l_orderkey FROM lineitem",
)
def id_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order ids without a line item."""
    ids = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"))
    return deliver.id_delta(ids, table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("id")), "id")


@query(
    "anti_diff",
    """SELECT o_orderkey, o_custkey, o_orderstatus FROM orders
WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""",
)
def anti_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders without a line item."""
    left = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return quality.anti_diff(left, table(spark, sf_dir, "lineitem"), {"o_orderkey": "l_orderkey"})


# --- batches ---------------------------------------------------------------------------------

@query(
    "batch_plan",
    """WITH plan AS (
  SELECT DISTINCT 'select * from src.orders where o_orderdate=DATE ''' || CAST(CAST(o_orderdate AS DATE) AS VARCHAR) || '''' AS src_sql,
         'publish.orders' AS trg_table, min(o_orderdate) OVER (PARTITION BY o_orderdate) < TIMESTAMP '1996-01-01' AS old FROM orders
  UNION ALL SELECT DISTINCT 'select * from src.customer where c_mktsegment=''' || c_mktsegment || '''', 'publish.customer', false FROM customer
  UNION ALL SELECT DISTINCT 'select * from src.lineitem where l_suppkey=' || CAST(l_suppkey AS VARCHAR), 'publish.lineitem', false FROM lineitem
  UNION ALL SELECT DISTINCT 'select * from src.part', 'publish.part', false FROM part)
SELECT md5(src_sql) AS src_sql_hash, src_sql, trg_table FROM plan WHERE NOT old""",
)
def batch_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1: batches by date, text, number and a whole table; those of 1995 were planned before."""
    days = table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("o_orderdate"))

    def by_day(df: DataFrame) -> DataFrame:
        return deliver.plan_batches(df, "src.orders", "publish.orders", "COLUMN", "o_orderdate")

    plan = reduce(DataFrame.unionByName, [
        by_day(days),
        deliver.plan_batches(table(spark, sf_dir, "customer"), "src.customer", "publish.customer", "COLUMN", "c_mktsegment"),
        deliver.plan_batches(table(spark, sf_dir, "lineitem"), "src.lineitem", "publish.lineitem", "COLUMN", "l_suppkey"),
        deliver.plan_batches(table(spark, sf_dir, "part"), "src.part", "publish.part"),
    ])
    known = by_day(days.filter("o_orderdate < date'1996-01-01'"))
    return deliver.new_batches(plan, known).drop("batch_value")


@query(
    "migration_log_rows",
    """SELECT o_orderpriority, count(*) AS rows_dumped, count(*) AS rows_loaded, 'Completed' AS status
FROM orders WHERE o_orderpriority <> '1-URGENT' GROUP BY 1""",
)
def migration_log_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A real move of the open batches; the urgent one was finished before."""
    source = table(spark, sf_dir, "orders")
    batches = source.select("o_orderpriority").distinct()
    return deliver.move_batches(source, "o_orderpriority", batches.filter("o_orderpriority <> '1-URGENT'"))


@query(
    "publish_log_rows",
    f"""WITH {FILES_SQL}, {LINE_SQL}
SELECT p.file_id, p.row_counts, 'Completed' AS publish_status, f.file_name, f.file_path
FROM (SELECT file_id, count(*) AS row_counts FROM lines GROUP BY 1) p LEFT JOIN files f USING (file_id)""",
)
def publish_log_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows moved per file, with the file's name and path."""
    moved = _lines(spark, sf_dir).groupBy("file_id").agg(
        F.count(F.lit(1)).alias("row_counts"), F.lit("Completed").alias("publish_status")
    )
    return deliver.publish_log(moved, files(spark, sf_dir))


# --- compliance ------------------------------------------------------------------------------

RULES = (
    (1, "o_orderstatus", "f;o"),
    (2, "o_orderpriority", "1-urgent;2-high;NULL"),
    (3, "review", "NULL"),
)

# The open set: every violation of orders before 1998, active for those before 1997.
FOUND_VIOLATIONS_SQL = """reviewed AS (
  SELECT *, CASE WHEN o_totalprice > 400000 THEN 'large' END AS review FROM orders),
 found AS (
  SELECT CAST(1 AS BIGINT) AS rule_id, o_orderkey AS record_id, o_orderdate FROM reviewed
    WHERE lower(o_orderstatus) NOT IN ('f', 'o')
  UNION ALL SELECT 2, o_orderkey, o_orderdate FROM reviewed
    WHERE lower(o_orderpriority) NOT IN ('1-urgent', '2-high') AND NOT (o_orderpriority IS NULL)
  UNION ALL SELECT 3, o_orderkey, o_orderdate FROM reviewed WHERE review IS NOT NULL),
 open_set AS (SELECT rule_id, record_id, o_orderdate < TIMESTAMP '1997-01-01' AS active FROM found
              WHERE o_orderdate < TIMESTAMP '1998-01-01')"""


def _reviewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").withColumn(
        "review", F.when(F.col("o_totalprice") > 400000, "large")
    )


def _open_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    def found(before: str) -> DataFrame:
        rows = _reviewed(spark, sf_dir).filter(F.col("o_orderdate") < F.lit(before).cast("timestamp"))
        return quality.violations(rows, "o_orderkey", RULES)

    old = found("1997-01-01").withColumn("active", F.lit(True))
    closed = _reviewed(spark, sf_dir).filter(
        "o_orderdate >= timestamp'1997-01-01' and o_orderdate < timestamp'1998-01-01'"
    )
    return old.unionByName(
        quality.violations(closed, "o_orderkey", RULES).withColumn("active", F.lit(False))
    )


@query("violations", f"WITH {FOUND_VIOLATIONS_SQL} SELECT rule_id, record_id FROM found")
def violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V1 before the open set is taken out."""
    return quality.violations(_reviewed(spark, sf_dir), "o_orderkey", RULES)


@query(
    "violations_new",
    f"""WITH {FOUND_VIOLATIONS_SQL}
SELECT rule_id, record_id FROM found f WHERE NOT EXISTS (SELECT 1 FROM open_set o
  WHERE o.active AND o.rule_id = f.rule_id AND o.record_id = f.record_id)""",
)
def violations_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.new_violations(violations(spark, sf_dir), _open_set(spark, sf_dir))


@query(
    "violations_upsert",
    f"""WITH {FOUND_VIOLATIONS_SQL}
SELECT f.rule_id, f.record_id, true AS active, coalesce(NOT o.active, false) AS reopened
FROM found f LEFT JOIN open_set o ON o.rule_id = f.rule_id AND o.record_id = f.record_id""",
)
def violations_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V2: closed violations that are found again become active."""
    return quality.reopen_violations(_open_set(spark, sf_dir), violations(spark, sf_dir)).drop("action")


# --- files, blocks and pages -----------------------------------------------------------------

@query(
    "block_ranges",
    """SELECT event_type AS sheet, row_number() OVER w AS block, event_id AS start_row,
       coalesce(lead(event_id) OVER w - 1, -1) AS end_row
FROM events WHERE value >= 100 WINDOW w AS (PARTITION BY event_type ORDER BY event_id)""",
)
def block_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sheets are event types; an event of high value starts a block. -1 marks an open end."""
    starts = table(spark, sf_dir, "events").filter("value >= 100").select(
        F.col("event_type").alias("sheet"), "event_id"
    )
    return numbering.block_ranges(starts, "event_id", ["event_id"], ["sheet"]).fillna(-1, ["end_row"])


@query(
    "page_links",
    r"""WITH bare AS (SELECT page_id, regexp_replace(html,
  '(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>', '', 'g') AS body FROM pages),
 found AS (SELECT page_id,
  regexp_extract_all(body, '(?is)<a\b[^>]*?\bhref\s*=\s*"([^"]*)"[^>]*>(.*?)</a\s*>', 1) AS h,
  regexp_extract_all(body, '(?is)<a\b[^>]*?\bhref\s*=\s*"([^"]*)"[^>]*>(.*?)</a\s*>', 2) AS t FROM bare)
SELECT page_id, CAST(generate_subscripts(h, 1) - 1 AS INTEGER) AS pos, unnest(h) AS href, unnest(t) AS text
FROM found""",
)
def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every link of every page."""
    return html.links(table(spark, sf_dir, "pages"))


@query(
    "page_elements",
    " UNION ALL ".join(
        rf"""SELECT '{tag}' AS tag, page_id, CAST(len(string_split_regex(regexp_replace(lower(html),
  '(?s)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>', '', 'g'), '<{tag}[\s/>]')) - 1 AS BIGINT) AS n FROM pages"""
        for tag in ("a", "li", "p", "table", "tr", "form")
    ),
)
def page_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links, list items, paragraphs, tables, table rows and forms of every page."""
    tags = ("a", "li", "p", "table", "tr", "form")
    return html.element_counts(table(spark, sf_dir, "pages"), tags)


@query(
    "new_links",
    r"""WITH bare AS (SELECT page_id, url, regexp_replace(html,
  '(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>', '', 'g') AS body FROM pages),
 found AS (SELECT url,
  unnest(regexp_extract_all(body, '(?is)<a\b[^>]*?\bhref\s*=\s*"([^"]*)"[^>]*>(.*?)</a\s*>', 1)) AS href,
  unnest(regexp_extract_all(body, '(?is)<a\b[^>]*?\bhref\s*=\s*"([^"]*)"[^>]*>(.*?)</a\s*>', 2)) AS text FROM bare)
SELECT DISTINCT href, text FROM found f WHERE regexp_matches(text, '^(?:[a-z])')
  AND NOT EXISTS (SELECT 1 FROM found k WHERE k.url LIKE 'http://%' AND k.href = f.href)""",
)
def new_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links whose text starts in lower case; those of plain http pages are catalogued."""
    pages = table(spark, sf_dir, "pages")
    found = html.links(pages)
    known = html.links(pages.filter("url like 'http://%'"))
    return html.new_links(found, known, "[a-z]")


@query(
    "csv_scan",
    """SELECT CAST(o_orderkey AS VARCHAR) AS order_id, o_orderstatus AS status,
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS price,
       CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL ELSE o_orderpriority END AS priority
FROM orders""",
)
def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table dumped without header and read back as text under configured names;
    the unspecified priority is dumped as a token that means missing."""
    folder = scratch_path(spark, "csv")
    tables.dump_csv(
        table(spark, sf_dir, "orders").select(
            "o_orderkey", "o_orderstatus", F.col("o_totalprice").cast("decimal(18,2)"),
            F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "N/A").otherwise(F.col("o_orderpriority")),
        ), folder,
    )
    names = ["order_id", "status", "price", "priority"]
    return delimited.read_delimited(spark, folder, names, has_header=False).drop("path")


@query(
    "export_all_counts",
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{t}.csv' AS file_name, count(*) AS n FROM {t}" for t in TABLES
    ),
)
def export_all_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every table exported as CSV files, then the rows of the files counted."""
    sources = {t: table(spark, sf_dir, t) for t in TABLES}
    folder = scratch_path(spark, "export")
    exported = tables.export_tables(sources, folder)
    counts = reduce(DataFrame.unionByName, [
        delimited.count_rows(spark, f"{folder}/{t}.csv")
        .agg(F.sum("rows").alias("n")).withColumn("table_name", F.lit(t))
        for t, df in sources.items()
    ])
    return exported.select("table_name", "file_name").join(counts, "table_name")


@query(
    "tables_to_move",
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS n FROM {t}"
        for t in sorted(TABLES) if t not in ("orders", "lineitem")
    ),
)
def tables_to_move(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables the configuration does not list, with the rows to move."""
    todo = deliver.tables_to_move(TABLES, ["orders", "lineitem"])
    return reduce(DataFrame.unionByName, [
        table(spark, sf_dir, t).agg(F.count(F.lit(1)).alias("n")).withColumn("table_name", F.lit(t))
        for t in todo
    ])


@query("data_dictionary", dictionary.oracle_dictionary())
def data_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every column of every table, with the longest text it holds."""
    return dictionary.data_dictionary({t: table(spark, sf_dir, t) for t in TABLES}, scan=True)


@query("ddl_text", dictionary.oracle_ddl())
def ddl_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Create, drop and verify statements of every table."""
    tables_ = {t: table(spark, sf_dir, t) for t in TABLES}
    return dictionary.ddl(dictionary.data_dictionary(tables_, scan=True), "publish")


DECLARED_TABLES = {
    "customer": "c_custkey bigint, c_name varchar(25), c_mktsegment char(10), c_acctbal double",
    "nation": "n_nationkey int, n_name varchar(25), n_regionkey int",
}


@query(
    "declared_dictionary",
    """SELECT type, table_name, column_name, data_type, CAST(length AS INTEGER) AS length, 'YES' AS is_nullable,
       CAST(ordinal_position AS INTEGER) AS ordinal_position, (SELECT count(*) FROM customer) AS n
FROM (VALUES
  ('Table', 'customer', 'c_custkey', 'bigint', 0, 1), ('Table', 'customer', 'c_name', 'character varying', 25, 2),
  ('Table', 'customer', 'c_mktsegment', 'character', 10, 3), ('Table', 'customer', 'c_acctbal', 'double precision', 0, 4),
  ('Table', 'nation', 'n_nationkey', 'integer', 0, 1), ('Table', 'nation', 'n_name', 'character varying', 25, 2),
  ('Table', 'nation', 'n_regionkey', 'integer', 0, 3),
  ('View', 'customer_names', 'c_name', 'character varying', 25, 1), ('View', 'customer_names', 'longest', 'character varying', -1, 2)
) AS d(type, table_name, column_name, data_type, length, ordinal_position)""",
)
def declared_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables with declared lengths, filled from the given ones, and a view over one, as the
    catalog knows them: no row is read for the dictionary."""
    schema = f"declared_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {schema} LOCATION '{scratch_path(spark, 'declared')}'")
    for t, columns in DECLARED_TABLES.items():
        spark.sql(f"CREATE TABLE {schema}.{t} ({columns}) USING parquet")
        names = [c.split(" ")[0] for c in columns.split(", ")]
        table(spark, sf_dir, t).select(*names).write.insertInto(f"{schema}.{t}")
    spark.sql(f"CREATE VIEW {schema}.customer_names AS SELECT c_name, upper(c_mktsegment) AS longest FROM {schema}.customer")
    n = spark.table(f"{schema}.customer").count()
    found = durable(dictionary.catalog_dictionary(spark, schema).withColumn("n", F.lit(n).cast("long")), "dictionary")
    found = found.fillna(-1, ["length"])  # an upper-cased text has no declared length
    spark.sql(f"DROP DATABASE {schema} CASCADE")
    return found


@query("catalog_scan")
def catalog_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The data folder as a catalog, with size and checksum of each whole file."""
    from quayside.operators.catalog import size_mb
    from quayside.sources.listing import list_files
    from quayside.sources.storage import file_md5

    found = durable(list_files(spark, sf_dir, r".*\.parquet$"), "listing")
    return found.join(file_md5(found), "path").select(
        "file_name", "file_path", "file_size", size_mb(F.col("file_size")).alias("size_mb"), "crc"
    )
