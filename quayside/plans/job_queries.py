"""Queries that run the jobs end to end on files made from the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import yaml
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.plans.delivery_queries import MERGE_SQL, _orders, _staging, _target
from quayside.plans.inputs import FILES_SQL, files, table
from quayside.plans.load_job import LoadJob
from quayside.plans.publish_job import PublishJob
from quayside.plans.registry import query
from quayside.session import durable, scratch_path
from quayside.sources import archives, storage, tables
from quayside.streaming import pickup


@query(
    "archive_members",
    f"""WITH {FILES_SQL}
SELECT f.parent_file_id, f.file_name AS member, CAST(strlen(d.text) AS BIGINT) AS file_size, f.crc
FROM files f JOIN documents d ON f.file_id = d.doc_id + 1 WHERE f.parent_file_id > 0""",
)
def archive_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every archive of the catalog written as a zip file with its members' texts,
    then expanded again and its members checksummed. An archive has at most nine members by the
    catalog's numbering, so a group is small whatever the table size."""
    folder = scratch_path(spark, "archives")

    def pack(batch):
        import zipfile

        import pandas as pd

        parent = int(batch["parent_file_id"].iloc[0])
        path = f"{folder}/{parent}.zip"
        sink, name = storage.task_filesystem(path)
        sink.create_dir(name.rsplit("/", 1)[0], recursive=True)
        with sink.open_output_stream(name, compression=None) as out, zipfile.ZipFile(out, "w") as z:
            for member, body in zip(batch["file_name"], batch["text"], strict=True):
                z.writestr(member, body)
        return pd.DataFrame({"path": [path], "parent_file_id": [parent]})

    members = files(spark, sf_dir, "text").filter("parent_file_id > 0").select("parent_file_id", "file_name", "text")
    packed = durable(
        members.groupBy("parent_file_id").applyInPandas(pack, "path string, parent_file_id long"), "packed"
    )
    found = archives.expand_archives(packed.withColumn("crc", F.lit("all")), scratch_path(spark, "extracted"))
    sums = storage.file_md5(found).drop("error")
    return (
        found.join(packed.withColumnRenamed("path", "parent_path"), "parent_path")
        .join(sums, "path").select("parent_file_id", "member", "file_size", "crc")
    )


@query(
    "load_run",
    """SELECT o_orderstatus, count(*) AS n, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents,
       CAST(0 AS BIGINT) AS difference FROM orders GROUP BY o_orderstatus""",
)
def load_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The load job on the orders as delimited files: listed, catalogued, checksummed, counted,
    checked for duplicates and appended with their file id. ``difference`` compares the rows of the
    table with the rows the catalog recorded."""
    folder, work = scratch_path(spark, "incoming"), scratch_path(spark, "work")
    rows = _orders(spark, sf_dir).select("o_orderkey", "o_orderstatus", "o_orderpriority", "cents")
    tables.dump_csv(rows, folder, header=True)
    schema = f"load_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {schema} LOCATION '{scratch_path(spark, 'database')}'")
    steps = ["count_file_linux_wc", "generate_checksum", "log_file_size", "abort_if_duplicate"]
    config = [{
        "path": folder, "project_name": "orders",
        "process_logic": [{"logic": s} for s in steps],
        "mapping": [{
            "file_regex": r".*\.csv$", "file_type": "CSV", "schema_name": schema, "table_name": "orders",
            "append_file_id": True, "process_logic": [{"logic": "pandas_import"}],
        }],
    }]
    catalog = LoadJob.from_yaml(spark, yaml.safe_dump(config), work).run()
    recorded = catalog.agg(F.sum("rows_inserted").alias("n"))
    loaded = spark.table(f"{schema}.orders")
    present = loaded.agg(F.count(F.lit(1)).alias("n"))
    result = durable(
        loaded.groupBy("o_orderstatus").agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.col("cents").cast("long")).alias("cents")
        ).withColumn("difference", present.scalar() - recorded.scalar()),
        "loaded",
    )
    spark.sql(f"DROP DATABASE {schema} CASCADE")
    return result


@query(
    "publish_run",
    """SELECT 'pub.customer' AS trg_table, 'select * from src.customer where c_mktsegment=''' || c_mktsegment || '''' AS src_sql,
       count(*) AS rows_dumped, count(*) AS rows_loaded, 'Completed' AS status FROM customer GROUP BY c_mktsegment
UNION ALL SELECT 'pub.supplier', 'select * from src.supplier where s_nationkey=' || CAST(s_nationkey AS VARCHAR),
       count(*), count(*), 'Completed' FROM supplier GROUP BY s_nationkey
UNION ALL SELECT 'pub.part', 'select * from src.part', count(*), count(*), 'Completed' FROM part""",
)
def publish_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The publish job over three tables: two in batches by a column, the rest of the
    schema whole. It runs twice; the second run finds nothing to move."""
    item = {
        "delivery_type": "SCHEMA", "move_data": True, "all_tables": True,
        "db": {"source_db": {"schema": "src"}, "target_db": {"schema": "pub"}},
        "tables": [
            {"table": "customer", "batch_method": "COLUMN", "column": "c_mktsegment"},
            {"table": "supplier", "batch_method": "COLUMN", "column": "s_nationkey"},
        ],
    }
    job = PublishJob(
        spark, item, scratch_path(spark, "publish"), lambda name: table(spark, sf_dir, name),
        ["customer", "part", "supplier"],
    )
    job.run()
    return job.run().select("trg_table", "src_sql", "rows_dumped", "rows_loaded", "status")


@query(
    "stream_pickup",
    """SELECT event_type, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids FROM events GROUP BY event_type""",
)
def stream_pickup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as files that arrive in two lots, the second with copies of the first;
    the stream runs after each lot and once more, and loads every row once."""
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    incoming = scratch_path(spark, "arriving")
    target, seen, checkpoint = (scratch_path(spark, n) for n in ("streamed", "seen", "checkpoint"))
    names = ["event_id", "event_type"]

    def run() -> None:
        pickup.load_available(spark, incoming, names, target, seen, checkpoint, has_header=False).awaitTermination()

    early = events.filter("event_type <> 'view'")
    tables.dump_csv(early, f"{incoming}/lot1")
    run()
    tables.dump_csv(early, f"{incoming}/lot2/copies")
    tables.dump_csv(events.filter("event_type = 'view'"), f"{incoming}/lot2/new")
    run()
    run()
    return spark.read.parquet(target).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("event_id").cast("long")).alias("ids")
    )


@query(
    "upsert_partitions",
    f"""WITH {MERGE_SQL}
SELECT r.o_orderkey, r.o_orderstatus, r.cents, r.file_id, o.o_orderpriority
FROM result r JOIN orders o ON r.o_orderkey = o.o_orderkey""",
)
def upsert_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1 on a table partitioned by priority: only partitions that staging touches are rewritten."""
    priority = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    target = _target(spark, sf_dir).join(priority, "o_orderkey")
    staging = _staging(spark, sf_dir).join(priority, "o_orderkey")
    path = scratch_path(spark, "partitioned")
    target.hint("rebalance", F.col("o_orderpriority")).write.partitionBy("o_orderpriority").parquet(path)
    tables.upsert_partitions(spark, path, target.schema, staging, ["o_orderkey"], "o_orderpriority")
    return spark.read.schema(target.schema).parquet(path)


@query(
    "numbered_lines",
    """SELECT CAST(sum(len(text) - len(replace(text, chr(10), ''))
         + CASE WHEN text <> '' AND NOT ends_with(text, chr(10)) THEN 1 ELSE 0 END) AS BIGINT) AS lines,
       CAST(0 AS BIGINT) AS misnumbered FROM documents""",
)
def numbered_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All texts as raw text files whose lines carry their own place; the files are
    read in splits and numbered, and a line whose number is not its place is counted."""
    from quayside.functions.text import lines_of
    from quayside.sources import lines

    folder = scratch_path(spark, "texts")
    body = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(lines_of(F.col("text"))).alias("p", "line"))

    def place(batches: Iterator) -> Iterator:
        at = 0
        for batch in batches:
            batch["value"] = [f"{at + i} {line}" for i, line in enumerate(batch["line"])]
            at += len(batch)
            yield batch[["value"]]

    body.select("line").mapInPandas(place, "value string").write.text(folder)
    numbered = lines.number_lines(lines.read_lines(spark, folder))
    wrong = F.col("line_no") != F.regexp_extract("line", r"^(\d+) ", 1).cast("long")
    return numbered.agg(F.count(F.lit(1)).alias("lines"), F.count_if(wrong).alias("misnumbered"))
