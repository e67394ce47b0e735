"""Publishing tables from a source schema to a target schema, batch by batch, with a log."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.operators import deliver
from quayside.operators.skew import lookup_join
from quayside.plans.config import bind_sql, fill_templates
from quayside.session import durable
from quayside.sources.tables import CatalogTable, VersionedTable, dump_csv

log = logging.getLogger(__name__)

WORK_SCHEMA = T.StructType([
    T.StructField("src_sql_hash", T.StringType()), T.StructField("src_sql", T.StringType()),
    T.StructField("trg_table", T.StringType()), T.StructField("batch_value", T.StringType()),
])
LOG_SCHEMA = T.StructType([
    T.StructField("src_sql_hash", T.StringType()), T.StructField("trg_table", T.StringType()),
    T.StructField("src_sql", T.StringType()), T.StructField("rows_dumped", T.LongType()),
    T.StructField("rows_loaded", T.LongType()), T.StructField("status", T.StringType()),
    T.StructField("start_time", T.TimestampNTZType()), T.StructField("end_time", T.TimestampNTZType()),
])
# The modes that fill one target from one source.
SINGLE = (deliver.KILLFILL, deliver.FILE_ID, deliver.LAST_UPDATE, deliver.PROJECT)
# The partition column of published tables: the hash of the batch a row came with.
BATCH = "publish_batch"


class PublishJob:
    """One item of a publish configuration.

    The target of a table is a folder partitioned by batch: a batch that is moved again replaces
    its own partition, so a run that was cut off can be repeated without doubling rows. Batches
    with a completed log row are not moved again.
    """

    def __init__(
        self, spark: SparkSession, item: Mapping[str, Any], target_dir: str,
        source: Callable[[str], DataFrame] | None = None, source_tables: list[str] | None = None,
        catalog: DataFrame | None = None,
    ):
        self.spark, self.item, self.target_dir = spark, item, target_dir.rstrip("/")
        self.source_schema = item["db"]["source_db"]["schema"]
        self.target_schema = item["db"]["target_db"]["schema"]
        self.source = source or (lambda name: spark.table(f"{self.source_schema}.{name}"))
        self.source_tables, self.catalog = source_tables, catalog
        self.work = VersionedTable(spark, f"{self.target_dir}/migration_work", WORK_SCHEMA)
        self.log = VersionedTable(spark, f"{self.target_dir}/migration_log", LOG_SCHEMA)

    def tables(self) -> list[dict[str, Any]]:
        """The configured tables, and with ``all_tables`` every other table of the schema, each
        once (F20)."""
        listed: list[dict[str, Any]] = []
        for entry in self.item.get("tables") or []:
            listed.append({"table": entry, "batch_method": "ALL"} if isinstance(entry, str) else dict(entry))
        named = [e["table"] for e in listed if e.get("table")]
        wide = [e for e in listed if not e.get("table")]
        plan = [e for e in listed if e.get("table")]
        if not listed or self.item.get("all_tables") or wide:
            known = self.source_tables
            if known is None:
                known = [t.name for t in self.spark.catalog.listTables(self.source_schema)]
            pattern = wide[0] if wide else {"batch_method": "ALL"}
            plan += [{**pattern, "table": t} for t in deliver.tables_to_move(known, named)]
        if not plan:
            raise ValueError("no tables found to plan")
        return plan

    def path(self, table: str) -> str:
        return f"{self.target_dir}/{self.target_schema}/{table}"

    def _names(self, table: str) -> tuple[str, str]:
        return f"{self.source_schema}.{table}", f"{self.target_schema}.{table}"

    def plan(self) -> DataFrame:
        """L1: add the batches that are not in the work table yet. An empty chunk is an error."""
        for entry in self.tables():
            table, method = entry["table"], entry["batch_method"]
            source, target = self._names(table)
            column = entry.get("column")
            rows = self.source(table)
            chunk = self.spark.sql(entry["chunk_sql"]).toDF(column) if entry.get("chunk_sql") else None
            plan = deliver.plan_batches(rows, source, target, method, column, chunk)
            known = self.work.read()
            fresh = durable(deliver.new_batches(plan, known).select(*WORK_SCHEMA.names), "plan")
            if not fresh.isEmpty():
                self.work.append(fresh)
            elif method == "COLUMN" and (chunk if chunk is not None else rows).isEmpty():
                raise ValueError(f"no batches for {target}")
        return self.work.read()

    def open_batches(self) -> DataFrame:
        done = self.log.read().filter("status = 'Completed'").select("src_sql_hash").distinct()
        return self.work.read().join(done, "src_sql_hash", "left_anti")

    def move(self) -> DataFrame:
        """One job per table over all its open batches, then its log rows. A batch whose
        counts differ stops the run after it is logged."""
        if not self.item.get("move_data", False):
            log.warning("move_data is not set: planned only")
            return self.log.read()
        open_ = durable(self.open_batches(), "open")
        waiting = {r["trg_table"] for r in open_.select("trg_table").distinct().collect()}
        for entry in self.tables():
            table = entry["table"]
            _, target = self._names(table)
            if target not in waiting:
                continue
            todo = open_.filter(F.col("trg_table") == target)
            moved = self._move_table(table, entry.get("column"), todo)
            if self.log.exists():
                self.log.append(moved)
            else:
                self.log.replace(moved)
            deliver.require_complete(moved)
            for sql in self.item.get("post_load_per_tbl_sql") or []:
                text = bind_sql(fill_templates(sql, {"table_name": target}), None, None, None)
                if text is not None:
                    self.spark.sql(text)
        return self.log.read()

    def _move_table(self, table: str, column: str | None, todo: DataFrame) -> DataFrame:
        started = F.current_timestamp().cast("timestamp_ntz")
        rows = self.source(table)
        value = F.lit(deliver.WHOLE) if column is None else deliver.batch_value(F.col(column))
        keyed = rows.withColumn("batch_value", value)
        hashes = todo.select("batch_value", F.col("src_sql_hash").alias(BATCH))
        batch = lookup_join(keyed, hashes, ["batch_value"], stored=True).drop("batch_value")
        # Truncation happens once, before the first batch of a table is complete; a resumed run
        # replaces only the partitions it moves.
        begun = not self.log.read().filter((F.col("trg_table") == self._names(table)[1]) & (F.col("status") == "Completed")).isEmpty()
        truncate = self.item["db"]["target_db"].get("truncate_target", False) and not begun
        mode = "static" if truncate else "dynamic"
        path = self.path(table)
        # A whole table is one batch: a rebalance by it would only shuffle the table.
        dealt, tally = deliver.tallied(batch if column is None else batch.hint("rebalance", F.col(BATCH)), BATCH)
        (
            dealt.write.mode("overwrite")
            .option("partitionOverwriteMode", mode).partitionBy(BATCH).parquet(path)
        )
        loaded = self.spark.read.schema(batch.schema).parquet(path)
        keep = self.item.get("retain_data_file_path")
        if keep:
            kept = lookup_join(loaded, todo.select(F.col("src_sql_hash").alias(BATCH)), [BATCH], "left_semi", stored=True)
            dump_csv(kept.select(*rows.columns), f"{keep.rstrip('/')}/{table}")
        open_ids = todo.select(F.col("src_sql_hash").alias(BATCH))
        counted = deliver.batch_log(batch, loaded, open_ids, BATCH, tally)
        return durable(
            counted.join(todo, F.col(BATCH) == F.col("src_sql_hash")).select(
                "src_sql_hash", "trg_table", "src_sql", "rows_dumped", "rows_loaded", "status",
                started.alias("start_time"), F.current_timestamp().cast("timestamp_ntz").alias("end_time"),
            ),
            "log",
        )

    def deliver(self, mode: str) -> DataFrame:
        """The single-table modes. Every table of the item is created like its
        source where it is missing: a folder of versions, or with ``distributed_by`` a table of the
        catalog in buckets of that column. ``source_sql`` may stand for the source. The mode's own
        settings come with the table, else with the item."""
        for entry in self.tables():
            have = {**self.item, **entry}
            table = have["table"]
            rows = self.spark.sql(have["source_sql"]) if have.get("source_sql") else self.source(table)
            target = VersionedTable(self.spark, self.path(table), rows.schema, have.get("keep_versions"))
            if not self.item.get("move_data", False):
                log.warning("move_data is not set: %s is not moved", table)
                continue
            if have.get("distributed_by"):
                target = CatalogTable(self.spark, self._names(table)[1], rows, have["distributed_by"], have.get("buckets", 16))
            if not target.exists() and isinstance(target, CatalogTable):
                target.create()
            elif not target.exists():
                target.replace(rows.limit(0))
            started = F.current_timestamp().cast("timestamp_ntz")
            statement = have.get("source_sql") or f"select * from {self._names(table)[0]}"
            catalog = self.spark.table(have["catalog_table"]) if have.get("catalog_table") else self.catalog
            before = target.read().count()
            written = run_delivery(
                mode, rows, target, catalog, have.get("project"), have.get("keys"),
                have.get("time_column", "cdo_last_update"), have.get("tie_column"), have.get("file_id_column", "file_id"),
            )
            after = target.read().count()
            moved = after if mode in (deliver.KILLFILL, deliver.LAST_UPDATE) else after - before
            status = "Completed" if moved == written else "Failed"
            row = self.spark.range(1).select(
                F.md5(F.lit(f"{mode} {statement}")).alias("src_sql_hash"), F.lit(self._names(table)[1]).alias("trg_table"),
                F.lit(statement).alias("src_sql"), F.lit(written).cast("long").alias("rows_dumped"),
                F.lit(moved).cast("long").alias("rows_loaded"), F.lit(status).alias("status"),
                started.alias("start_time"), F.current_timestamp().cast("timestamp_ntz").alias("end_time"),
            )
            self.log.append(row)
            deliver.require_complete(row)
        return self.log.read()

    def run(self) -> DataFrame:
        """Plan, then move what is open; the modes of single tables deliver at once."""
        if not self.item.get("enabled", True):
            return self.log.read()
        mode = self.item.get("delivery_type", deliver.SCHEMA)
        if mode not in (deliver.SCHEMA, *SINGLE):
            raise ValueError(f"unknown delivery mode {mode}")
        for sql in self.item.get("trg_pre_action_sql") or []:
            text = bind_sql(fill_templates(sql, self.item), None, None, None)
            if text is not None:
                self.spark.sql(text)
        if mode in SINGLE:
            return self.deliver(mode)
        self.plan()
        return self.move()


def run_delivery(
    mode: str, source: DataFrame, target: VersionedTable | CatalogTable, catalog: DataFrame | None = None,
    project: str | None = None, keys: list[str] | None = None, time: str = "cdo_last_update",
    tie: str | None = None, file_id: str = "file_id",
) -> int:
    """the single-table delivery modes, applied to a versioned target; the rows that the write
    itself counted."""
    seen = Observation()

    def counted(rows: DataFrame) -> DataFrame:
        return rows.observe(seen, F.count(F.lit(1)).alias("rows"))

    if mode == deliver.KILLFILL:
        target.replace(counted(source))
    elif mode == deliver.FILE_ID:
        target.append(counted(deliver.deliver_file_id(source, target.read(), file_id)))
    elif mode == deliver.LAST_UPDATE:
        if not keys:
            raise ValueError("delivery by time needs keys")
        if not tie:
            raise ValueError("delivery by time needs a column that decides between equal times")
        merged = deliver.deliver_last_update(source, target.read(), keys, time, tie, stored=True)
        target.replace(counted(merged.drop("action")))
    elif mode == deliver.PROJECT:
        if catalog is None or project is None:
            raise ValueError("delivery by project needs a catalog and a project")
        mine = deliver.deliver_project(source, catalog, project, file_id)
        target.append(counted(deliver.deliver_file_id(mine, target.read(), file_id)))
    else:
        raise ValueError(f"unknown delivery mode {mode}")
    return seen.get["rows"]
