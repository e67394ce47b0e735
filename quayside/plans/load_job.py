"""The load: list, catalog, map, run the steps of each mapping, append to tables, keep states."""

from __future__ import annotations

import logging
import re
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions import paths
from quayside.operators import catalog as cat
from quayside.operators.mapping import first_match
from quayside.operators.skew import lookup_join
from quayside.plans.config import MappingRow, bind_sql, each_file, over_files, read_mappings
from quayside.plans.load_steps import MARKERS, STEPS, StepContext, fail_where, short, target_names, target_table
from quayside.plans.logs import Logs
from quayside.session import durable
from quayside.sources.listing import list_files
from quayside.sources.storage import folder_exists
from quayside.sources.tables import VersionedTable

log = logging.getLogger(__name__)

KEPT_CATALOGS = 20  # versions of the catalog that stay
NO_MAPPING = "No Matching Configuration Found"


class LoadJob:
    """One run over the configured folders. State lives in the catalog table, so a run that was
    cut off goes on with what is still RAW."""

    def __init__(
        self, spark: SparkSession, mappings: Sequence[MappingRow], work_dir: str, data_schema: str = "default"
    ):
        self.spark, self.mappings, self.work_dir = spark, list(mappings), work_dir.rstrip("/")
        self.data_schema = data_schema
        self.catalog = VersionedTable(
            spark, f"{self.work_dir}/logging/meta_source_files", cat.CATALOG_SCHEMA, KEPT_CATALOGS
        )
        if not self.catalog.exists():
            self.catalog.replace(spark.createDataFrame([], cat.CATALOG_SCHEMA))

    @classmethod
    def from_yaml(cls, spark: SparkSession, text: str, work_dir: str, data_schema: str = "default") -> LoadJob:
        return cls(spark, read_mappings(text), work_dir, data_schema)

    def find_files(self) -> DataFrame | None:
        """The files of every configured folder with the first entry that lists them."""
        listings = []
        for folder in dict.fromkeys(m.path for m in self.mappings):
            if not folder_exists(self.spark, folder):
                log.error("folder of the configuration does not exist: %s", folder)
                continue
            rows = [m for m in self.mappings if m.path == folder]
            found = list_files(self.spark, folder)
            hit = first_match(F.col("path"), [m.file_regex for m in rows], ignore_case=False)
            kind = F.array(*[F.lit(m.file_type) for m in rows])
            project = F.array(*[F.lit(m.project_name) for m in rows])
            order = F.array(*[F.lit(m.order) for m in rows])
            listings.append(
                found.withColumn("_hit", hit).filter("_hit is not null").select(
                    "file_path", "file_name", "file_size",
                    F.when(F.get(kind, "_hit") == "DATA", paths.extension(F.col("file_name")))
                    .otherwise(F.get(kind, "_hit")).alias("file_type"),
                    F.get(project, "_hit").alias("project_name"),
                    F.get(order, "_hit").alias("order"),
                )
            )
        return reduce(DataFrame.unionByName, listings) if listings else None

    def add_new(self) -> None:
        found = self.find_files()
        if found is None:
            return
        known = self.catalog.read()
        fresh = durable(cat.add_files(known, found), "new-files")
        if not fresh.isEmpty():
            self.catalog.append(fresh)

    def tag_dates(self) -> None:
        """The date in the name, once for all files of the projects that ask for it."""
        catalog = self.catalog.read()
        rules = {
            m.project_name: (m.extract_file_name_data, m.format_extracted_date)
            for m in self.mappings if m.extract_file_name_data is not None
        }
        if not rules:
            return
        for project, (pattern, fmt) in rules.items():
            mine = F.col("project_name") == project
            dated = cat.file_dates(catalog.filter(mine), pattern, fmt, "id").select(*catalog.columns)
            catalog = catalog.filter(~mine).unionByName(dated)
        self.catalog.replace(catalog)

    def run(self, reset_failed: bool = True) -> DataFrame:
        """Work until no file is left; returns the catalog."""
        if reset_failed:
            self.catalog.replace(cat.reset_files(self.catalog.read(), "FAILED"))
        self.add_new()
        while self._one_pass():
            pass
        return self.catalog.read()

    def _one_pass(self) -> bool:
        """All open files at once, step position by step position."""
        projects = sorted({m.project_name for m in self.mappings})
        if cat.open_work(self.catalog.read()).filter(F.col("project_name").isin(*projects)).isEmpty():
            return False
        self.tag_dates()
        before = self.catalog.read()
        path = F.concat_ws("/", "file_path", "file_name")
        work = (
            cat.open_work(before).filter(F.col("project_name").isin(*projects))
            .withColumn("path", path)
            .withColumn("mapping", first_match(path, [m.file_regex for m in self.mappings]))
            .withColumn("ok", F.lit(True)).withColumn("message", F.lit(None).cast("string"))
            .withColumn("process_start_dtm", F.current_timestamp().cast("timestamp_ntz"))
            .withColumn("last_error_msg", F.lit(None).cast("string"))
        )
        again = F.get(F.array(*[F.lit(bool(m.reprocess)) for m in self.mappings]), "mapping")
        work = work.withColumn("reprocess", F.coalesce(again, F.col("reprocess")))
        work = durable(fail_where(work, F.col("mapping").isNull(), NO_MAPPING), "work")
        context = StepContext(self.spark, self.mappings, self.catalog, self.work_dir, self.data_schema)

        work = self._actions(work, "pre_action")
        for position in range(max((len(m.steps) for m in self.mappings), default=0)):
            for name in dict.fromkeys(m.steps[position] for m in self.mappings if position < len(m.steps)):
                at_step = [m.order for m in self.mappings if position < len(m.steps) and m.steps[position] == name]
                here = F.col("ok") & F.col("mapping").isin(*at_step)
                trail = F.concat(F.lit(f"{name};\n"), F.coalesce("process_msg_trail", F.lit("")))
                if name in MARKERS:
                    # nothing to compute: the step only shows in the trail
                    shown = F.when(F.coalesce(here, F.lit(False)), trail).otherwise(F.col("process_msg_trail"))
                    work = work.withColumn("process_msg_trail", shown)
                    continue
                active = work.filter(here)
                if active.isEmpty():
                    continue
                log.info("step %s", name)
                rest = work.filter(~F.coalesce(here, F.lit(False)))

                def told(done: DataFrame, name=name, trail=trail, rest=rest) -> DataFrame:
                    why = F.concat(F.lit(f"{name}\n"), F.coalesce("message", F.lit("")))
                    done = done.withColumn("process_msg_trail", trail)
                    done = done.withColumn("message", F.when(F.col("ok"), F.col("message")).otherwise(why))
                    return durable(rest.unionByName(done.select(*rest.columns)), "work")

                # Steps fail single files themselves. What they can't lay on one file fails those of
                # the step; the others go on.
                try:
                    if name not in STEPS:
                        raise ValueError(f"unknown step {name}")
                    work = told(STEPS[name](context, active))
                except Exception as e:  # noqa: BLE001  whatever a step raises, the run goes on
                    log.exception("step %s", name)
                    work = told(fail_where(active, F.lit(True), short(e)))
        self._close(self._actions(work, "post_action"))
        return True

    def _actions(self, work: DataFrame, kind: str) -> DataFrame:
        """M7: configured statements, once per table. One that names the file runs once for all files
        of the table where that gives the same rows; an insertion that looks at the rows of a file as
        a whole does so too, by a lateral join; others run once per file, and the log says why.
        A failing statement fails the files of its mapping."""
        for row in self.mappings:
            statements = row.settings.get(kind) or []
            mine = F.col("ok") & (F.col("mapping") == row.order)
            if not statements or work.filter(mine).isEmpty():
                continue
            named = target_names(row, work.filter(mine)).select("id", "_table")
            tables = [r["_table"] for r in named.select("_table").distinct().collect()]
            try:
                for item in statements:
                    for table in tables:
                        sql = bind_sql(item["sql"], row.schema_name, table, row.columns)
                        if sql is None:
                            log.warning("skipped: %s", item["sql"][:50])
                        elif ":file_id" in sql:
                            self._for_files(sql, named.filter(F.col("_table") == table))
                        else:
                            self.spark.sql(sql)
            except Exception as e:  # noqa: BLE001
                work = durable(fail_where(work, F.coalesce(mine, F.lit(False)), f"{kind}: {e}"), "work")
        return work

    def _for_files(self, sql: str, files: DataFrame) -> None:
        """A statement that names the file, for all files of a table."""
        ids = f"files_{uuid.uuid4().hex}"
        wide, why = over_files(sql, ids)
        named = files.select(F.col("id").alias("file_id" if wide else ids))
        (named if wide else durable(named, "ids")).createOrReplaceTempView(ids)
        try:
            wide = wide or self._lateral(sql, ids)
            if wide is not None:
                self.spark.sql(wide)
                return
        finally:
            self.spark.catalog.dropTempView(ids)
        log.warning("once per file, %s: %s", why, sql[:80])
        for r in files.orderBy("id").toLocalIterator():
            self.spark.sql(sql, {"file_id": r["id"]})

    def _lateral(self, sql: str, ids: str) -> str | None:
        """An insertion for each file of the view in one statement, if Spark can plan it and what one file
        inserts is not read for the next: the target is named nowhere in the plan of the query."""
        parts = each_file(sql, ids)
        if parts is None:
            return None
        target, insertion, query = parts
        try:
            self.spark.sql(query)  # fails here if Spark can't
            plan = self.spark.sql(f"EXPLAIN EXTENDED {query}").first()[0]
        except PySparkException:
            return None
        name = target.split(".")[-1].strip("`")
        if plan.startswith("Error occurred") or re.search(rf"(?i)\b{re.escape(name)}\b", plan):
            return None
        return f"{insertion} {query}"

    def _same_fate(self, work: DataFrame) -> DataFrame:
        """Copies of a file that failed, of the same mapping and target, fail with its message in
        the same pass: their content is the same and the same steps would work on it."""
        table = F.lit("")
        for m in self.mappings:
            table = F.when(F.col("mapping") == m.order, target_table(m)).otherwise(table)
        key, copy = ["project_name", "crc", "mapping", "_table"], F.coalesce("duplicate_file", F.lit(False))
        marked = work.withColumn("_table", F.coalesce(table, F.lit("")))
        first = marked.filter(~F.col("ok") & ~copy & F.col("crc").isNotNull() & F.col("mapping").isNotNull())
        if first.isEmpty() or work.filter(copy).isEmpty():
            return work
        failed = durable(first.groupBy(*key).agg(F.min_by("message", "id").alias("_why")), "failed")
        bound = copy & ~F.col("ok") & F.col("_why").isNotNull()
        return durable(lookup_join(marked, failed, key, "left", stored=True).withColumns({
            "message": F.when(bound, F.col("_why")).otherwise(F.col("message")),
            "duplicate_file": copy & ~F.coalesce(bound, F.lit(False)),
        }).select(*work.columns), "work")

    def _close(self, work: DataFrame) -> None:
        """Final states, and failures to the error log; a copy whose first copy failed to load is
        opened again, unless it is bound to fail alike."""
        work = self._same_fate(work)
        state = F.when(F.col("ok"), cat.PROCESSED).otherwise(cat.FAILED)
        closed = (
            work.withColumn("file_process_state", state)
            .withColumn("last_error_msg", F.col("message"))
            .withColumn("process_end_dtm", F.current_timestamp().cast("timestamp_ntz"))
            .select(*[f.name for f in cat.CATALOG_SCHEMA])
        )
        Logs(self.spark, f"{self.work_dir}/logging").add_errors(work.filter("not ok").select(
            F.col("id").alias("file_id"), F.col("message").alias("error_message"),
            F.split("message", "\n")[0].alias("program_unit"),
        ))
        catalog = self.catalog.read()
        rest = catalog.join(work.select("id"), "id", "left_anti")
        after = durable(rest.unionByName(closed), "catalog")
        loaded = (
            after.filter(F.col("file_process_state") == cat.PROCESSED)
            .select("project_name", "crc").distinct().withColumn("_has", F.lit(True))
        )
        orphan = (
            (F.col("file_process_state") == cat.FAILED) & F.col("duplicate_file") & F.col("_has").isNull()
        )
        judged = lookup_join(after, loaded, ["project_name", "crc"], "left")
        self.catalog.replace(
            judged.withColumns({
                "file_process_state": F.when(orphan, cat.RAW).otherwise(F.col("file_process_state")),
                "duplicate_file": F.col("duplicate_file") & ~orphan,
            }).select(*catalog.columns)
        )

    def reset(self, option: str, where: str | None = None) -> None:
        self.catalog.replace(cat.reset_files(self.catalog.read(), option, None if where is None else F.expr(where)))
