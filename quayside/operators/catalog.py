"""The file catalog: unseen files, states, duplicates, lineage and work order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.functions import paths
from quayside.operators.numbering import number_rows
from quayside.operators.skew import lookup_join

# States of a file.
RAW, STARTED, PROCESSED, FAILED = "RAW", "Processing Started", "Processed", "FAILED"
# File types that hold rows.
DATA_TYPES = ("CSV", "DATA")

CATALOG_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("project_name", T.StringType(), False),
        T.StructField("file_name", T.StringType(), False),
        T.StructField("file_path", T.StringType(), False),
        T.StructField("file_name_data", T.StringType()),
        T.StructField("file_type", T.StringType()),
        T.StructField("file_process_state", T.StringType()),
        T.StructField("process_start_dtm", T.TimestampNTZType()),
        T.StructField("process_end_dtm", T.TimestampNTZType()),
        T.StructField("rows_inserted", T.LongType()),
        T.StructField("data_appended", T.StringType()),
        T.StructField("file_size", T.LongType()),
        T.StructField("total_rows", T.LongType()),
        T.StructField("total_files", T.IntegerType()),
        T.StructField("total_files_processed", T.IntegerType()),
        T.StructField("last_error_msg", T.StringType()),
        T.StructField("database_table", T.StringType()),
        T.StructField("parent_file_id", T.LongType()),
        T.StructField("crc", T.StringType()),
        T.StructField("upsert_time", T.TimestampNTZType()),
        T.StructField("publish_time", T.TimestampNTZType()),
        T.StructField("upsert_function_name", T.StringType()),
        T.StructField("reprocess", T.BooleanType()),
        T.StructField("process_msg_trail", T.StringType()),
        T.StructField("duplicate_file", T.BooleanType()),
    ]
)

# What a new catalog row starts with.
CATALOG_DEFAULTS = {
    "file_process_state": RAW, "rows_inserted": 0, "file_size": 0, "total_rows": 0,
    "total_files": 0, "total_files_processed": 0, "parent_file_id": 0, "reprocess": True,
    "process_msg_trail": "", "duplicate_file": False,
}


def catalog_rows(found: DataFrame) -> DataFrame:
    """``found`` in the catalog's columns, with defaults where it has no value."""
    have = set(found.columns)
    return found.select(
        *[
            (
                F.coalesce(F.col(f.name), F.lit(CATALOG_DEFAULTS.get(f.name)))
                if f.name in have
                else F.lit(CATALOG_DEFAULTS.get(f.name))
            ).cast(f.dataType).alias(f.name)
            for f in CATALOG_SCHEMA
        ]
    )


def unseen_files(listing: DataFrame, catalog: DataFrame) -> DataFrame:
    """Listed files the catalog does not know by (file_name, file_path); the first project
    to list a file keeps it (F25)."""
    return listing.join(
        catalog.select("file_name", "file_path"), ["file_name", "file_path"], "left_anti"
    )


def add_files(catalog: DataFrame, listing: DataFrame) -> DataFrame:
    """Catalog rows for unseen files, ids continuing after the highest one."""
    fresh = unseen_files(listing, catalog)
    if "order" in fresh.columns:
        fresh = (
            fresh.groupBy("file_name", "file_path")
            .agg(F.min_by(F.struct(*[c for c in fresh.columns if c not in ("file_name", "file_path")]), "order").alias("r"))
            .select("file_name", "file_path", "r.*")
            .drop("order")
        )
    top = catalog.agg(F.coalesce(F.max("id"), F.lit(0)).alias("top"))
    numbered = number_rows(fresh.drop("id"), ["file_path", "file_name"], name="_n")
    return catalog_rows(numbered.withColumn("id", F.col("_n") + top.scalar()))


def work_order_keys() -> list[Column]:
    """O1: tag date, parent, path, name; missing tags last."""
    return [
        F.col("file_name_data").asc_nulls_last(), F.col("parent_file_id").asc(),
        F.col("file_path").asc(), F.col("file_name").asc(),
    ]


def open_work(catalog: DataFrame) -> DataFrame:
    """Files waiting to be processed (F36: only those marked for processing)."""
    return catalog.filter((F.col("file_process_state") == RAW) & F.col("reprocess"))


def work_order(catalog: DataFrame) -> DataFrame:
    """O1: the open files with their place in the work order."""
    return number_rows(open_work(catalog), work_order_keys(), name="position")


def file_dates(
    catalog: DataFrame, pattern: str, fmt: str | None = None, id_col: str = "file_id"
) -> DataFrame:
    """Tag each file with the date in its name; members take their archive's."""
    parents = catalog.select(
        F.col(id_col).alias("parent_file_id"),
        paths.file_date(F.col("file_name"), pattern, fmt).alias("_tag"),
    )
    own = paths.file_date(F.col("file_name"), pattern, fmt)
    top = catalog.filter(F.col("parent_file_id") == 0).withColumn("file_name_data", own)
    members = lookup_join(
        catalog.filter(F.col("parent_file_id") > 0).drop("file_name_data"),
        parents, ["parent_file_id"], "left",
    ).withColumnRenamed("_tag", "file_name_data")
    return top.unionByName(members)


def duplicate_files(catalog: DataFrame, id_col: str = "file_id") -> DataFrame:
    """Files whose content another, already processed file of the project has.

    Copies are reduced to the lowest and highest processed id of each (project, crc) before any
    join, so a group of copies is never paired with itself.
    """
    done = F.when(F.col("file_process_state") == PROCESSED, F.col(id_col))
    groups = (
        catalog.filter(F.col("crc").isNotNull()).groupBy("project_name", "crc")
        .agg(F.min(done).alias("_low"), F.max(done).alias("_high"), F.count(F.lit(1)).alias("_n"))
        .filter((F.col("_n") > 1) & F.col("_low").isNotNull())
        .drop("_n")
    )
    me = F.col(id_col)
    return (
        lookup_join(catalog, groups, ["project_name", "crc"])
        .filter((F.col("_low") != me) | (F.col("_high") != me))
        .drop("_low", "_high")
    )


def first_copies(
    catalog: DataFrame, order: Sequence[Column], id_col: str = "file_id"
) -> DataFrame:
    """F8: of the processed files with the same content in a project, the first in work order:
    the set whose rows are loaded. One aggregate per (project, crc), no join back. A file without a
    checksum is no copy of another."""
    place = F.struct(*[c.alias(f"k{i}") for i, c in enumerate(order)])
    return (
        catalog.filter(F.col("file_process_state") == PROCESSED)
        .groupBy("project_name", F.coalesce("crc", F.concat(F.lit("no checksum "), F.col(id_col).cast("string"))))
        .agg(F.min_by(id_col, place).alias(id_col))
        .select("project_name", id_col)
    )


def finished_imports(catalog: DataFrame, id_col: str = "file_id") -> DataFrame:
    """Processed top-level files without an unfinished member; duplicates do not count."""
    unfinished = (
        catalog.filter(
            (F.col("parent_file_id") > 0)
            & (F.col("file_process_state") != PROCESSED)
            & ~F.col("duplicate_file")
        )
        .select(F.col("parent_file_id").alias(id_col))
        .distinct()
    )
    parents = catalog.filter(
        (F.col("parent_file_id") == 0) & (F.col("file_process_state") == PROCESSED)
    )
    return parents.join(unfinished, id_col, "left_anti")


def finished_children(catalog: DataFrame, id_col: str = "file_id") -> DataFrame:
    """Members of finished top-level files."""
    done = finished_imports(catalog, id_col).select(
        F.col(id_col).alias("parent_file_id"), F.col("file_name").alias("parent_file_name")
    )
    return lookup_join(catalog.filter(F.col("parent_file_id") > 0), done, ["parent_file_id"])


def children_per_parent(catalog: DataFrame) -> DataFrame:
    """Members of each archive."""
    return (
        catalog.filter(F.col("parent_file_id") > 0)
        .groupBy("parent_file_id")
        .agg(F.count(F.lit(1)).alias("total_files"))
    )


def reset_files(catalog: DataFrame, option: str = "FAILED", where: Column | None = None) -> DataFrame:
    """M5: put files back to RAW. FAILED needs the reprocess mark (F36); RAW and DATA touch files
    that hold rows; ALL touches every file and marks it for processing (F24)."""
    state = F.upper("file_process_state")
    rules = {
        "ALL": F.lit(True),
        "FAILED": (state == FAILED) & F.col("reprocess"),
        "RAW": (state == RAW) & F.col("file_type").isin(*DATA_TYPES),
        "DATA": F.col("file_type").isin(*DATA_TYPES),
    }
    option = option.upper()
    if option not in rules:
        raise ValueError(f"unknown reset option {option}")
    hit = rules[option] if where is None else rules[option] & where
    new = {
        "file_process_state": F.lit(RAW), "duplicate_file": F.lit(False),
        "process_start_dtm": F.lit(None).cast("timestamp_ntz"),
        "process_end_dtm": F.lit(None).cast("timestamp_ntz"),
    }
    if option == "ALL":
        new |= {"reprocess": F.lit(True), "total_rows": F.lit(0).cast("long")}
    else:
        new |= {"last_error_msg": F.lit(None).cast("string")}
    return catalog.withColumns(
        {c: F.when(hit, v).otherwise(F.col(c)) for c, v in new.items() if c in catalog.columns}
    )


def latest(events: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """O2: the newest row of each key, by a partial aggregate instead of a ranked window."""
    rest = [c for c in events.columns if c not in key]
    return (
        events.groupBy(*key)
        .agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_r"))
        .select(*key, "_r.*")
    )


def latest_state(
    events: DataFrame, key: str, state: str, order: Sequence[str], message: str
) -> DataFrame:
    """M6: current state of each file. An event without a message keeps the former message."""
    at = F.struct(*order)
    return events.groupBy(key).agg(
        F.max_by(state, at).alias("state"),
        F.max_by(message, F.when(F.col(message).isNotNull(), at)).alias("last_message"),
        F.count(F.lit(1)).alias("changes"),
    )


def process_trail(events: DataFrame, key: str, step: str, order: Sequence[Column]) -> DataFrame:
    """The steps of each file, newest first, one row per step.

    The reference joins them into one growing text per file. Rows say the same without one value
    that grows with the number of events; ``order`` is newest first and ends in a unique column.
    """
    return number_rows(events, order, [key], "trail_pos").select(key, "trail_pos", step)


def publish_errors(publish_log: DataFrame) -> DataFrame:
    """Files tried more than once without a row ever published."""
    named = publish_log.groupBy("data_id", "file_name", "file_path").agg(
        F.count(F.lit(1)).alias("_n"), F.max("row_counts").alias("_rows")
    )
    bad = (
        named.groupBy("data_id")
        .agg(F.sum("_n").alias("_n"), F.max("_rows").alias("_rows"))
        .filter((F.col("_n") > 1) & (F.col("_rows") == 0))
        .select("data_id")
    )
    return named.join(bad, "data_id", "left_semi").select("data_id", "file_name", "file_path")


def size_mb(size: Column) -> Column:
    """Bytes as megabytes, two places."""
    return F.round(size / 1024 / 1024, 2)
