"""Publishing: batch plans, the delivery modes, moved batches and their logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.operators.merge import merge_rows, merge_stored
from quayside.operators.skew import lookup_join
from quayside.session import durable, scratch_path

# Delivery modes.
KILLFILL, FILE_ID, LAST_UPDATE, PROJECT, SCHEMA = (
    "KILLFILL", "FILE_ID", "CDO_LAST_UPDATE", "PROJECT", "SCHEMA",
)

# Mark the batch of rows whose batch column is NULL, and the single batch of a whole table.
NULL_BATCH, WHOLE = "\u0000", "\u0001"


def sql_literal(value: Column, kind: T.DataType) -> Column:
    """A value as a literal of its type; texts quoted."""
    text = value.cast("string")
    if isinstance(kind, (T.NumericType, T.BooleanType)):
        return text
    quoted = F.concat(F.lit("'"), F.replace(text, F.lit("'"), F.lit("''")), F.lit("'"))
    if isinstance(kind, T.DateType):
        return F.concat(F.lit("DATE "), quoted)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.concat(F.lit("TIMESTAMP "), quoted)
    return quoted


def batch_value(column: Column) -> Column:
    """The value of a batch as text; a missing value is a batch of its own."""
    return F.coalesce(column.cast("string"), F.lit(NULL_BATCH))


def plan_batches(
    source: DataFrame, source_table: str, target_table: str, method: str = "ALL",
    column: str | None = None, chunk: DataFrame | None = None,
) -> DataFrame:
    """L1: the batches of a table: one for ALL, one per distinct value for COLUMN.

    A batch's key is the MD5 of its own statement (F18). A NULL value is a batch of its own (F19).
    ``chunk`` gives the values from elsewhere, such as the file ids of a catalog.
    """
    select = f"select * from {source_table}"
    spark = source.sparkSession
    if method == "ALL":
        plan = spark.range(1).select(F.lit(select).alias("src_sql"), F.lit(WHOLE).alias("batch_value"))
    elif method == "COLUMN":
        if column is None:
            raise ValueError("batch method COLUMN needs a column")
        values = (chunk if chunk is not None else source).select(column).distinct()
        value = F.col(column)
        where = F.when(value.isNull(), F.lit(f"{column} IS NULL")).otherwise(
            F.concat(F.lit(f"{column}="), sql_literal(value, values.schema[column].dataType))
        )
        plan = values.select(
            F.concat(F.lit(f"{select} where "), where).alias("src_sql"),
            batch_value(value).alias("batch_value"),
        )
    else:
        raise ValueError(f"unknown batch method {method}")
    return plan.select(
        F.md5("src_sql").alias("src_sql_hash"), "src_sql", F.lit(target_table).alias("trg_table"),
        "batch_value",
    )


def new_batches(plan: DataFrame, work_table: DataFrame) -> DataFrame:
    """K10 on the work table: batches not planned before. The plan is stored first: its statements
    are constants to the optimizer, which would compare them row by row instead of by key."""
    return durable(plan, "plan").join(work_table.select("src_sql_hash"), "src_sql_hash", "left_anti")


def tables_to_move(source_tables: Sequence[str], listed: Sequence[str]) -> list[str]:
    """The tables of a schema that the configuration does not name itself."""
    return sorted(set(source_tables) - set(listed))


def move_batches(
    source: DataFrame, batch: str, open_batches: DataFrame, target_path: str | None = None
) -> DataFrame:
    """Move every open batch of a table in one job and report dumped and loaded rows.

    The open batches are a lookup join, so a hot batch is not one task. The write is rebalanced by
    batch: adaptive execution splits a large batch over several files and merges small ones.
    Each batch is a partition directory that is replaced as a whole, so a rerun repeats no row.
    Rows without a batch value are moved when the open batches hold NULL.
    """
    spark = source.sparkSession
    path = target_path or scratch_path(spark, "moved")
    # open batches are distinct values of one column
    moved = lookup_join(source, open_batches.select(batch).distinct(), [batch], "left_semi")
    if not open_batches.filter(F.col(batch).isNull()).isEmpty():
        moved = moved.unionByName(source.filter(F.col(batch).isNull()))
    dealt, tally = tallied(moved.hint("rebalance", F.col(batch)), batch)
    (
        dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(batch).parquet(path)
    )
    loaded = spark.read.schema(source.schema).parquet(path)
    return batch_log(moved, loaded, open_batches, batch, tally)


def _tally(batch: str, rows: Column) -> list[Column]:
    """A count and two sums of batch hashes: equal for two sets of rows only if every batch has as
    many rows in both (but for a chance of about 2**-64)."""
    hashes = [F.coalesce(F.xxhash64(F.lit(salt), F.col(batch)), F.lit(0)).cast("decimal(20,0)") for salt in (1, 2)]
    return [F.coalesce(F.sum(rows), F.lit(0)).alias("rows"), *[
        F.coalesce(F.sum((h * rows).cast("decimal(38,0)")), F.lit(0)).alias(f"sum_{i}") for i, h in enumerate(hashes)]]


def tallied(rows: DataFrame, batch: str) -> tuple[DataFrame, Observation]:
    """The rows, counted by the job that writes them."""
    seen = Observation()
    return rows.observe(seen, *_tally(batch, F.lit(1).cast("long"))), seen


def batch_log(
    dumped: DataFrame, loaded: DataFrame, open_batches: DataFrame, batch: str, tally: Observation | None = None
) -> DataFrame:
    """One row per batch; differing counts make the batch fail.

    Loaded rows are counted per batch folder, for which Spark reads the files' footers alone. The
    rows that the write dumped were counted by it (``tally``); where they agree with the loaded
    ones no source is run again. Otherwise, or without a tally, the dump is counted per batch.
    """
    def counted(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(batch).agg(F.count(F.lit(1)).alias(name))

    ids = open_batches.select(batch).distinct()
    # the target holds older batches too: only the partitions of the open ones are read
    key = ids.withColumnRenamed(batch, "_open")
    same_batch = F.col("_open").eqNullSafe(F.col(batch))
    fresh = durable(counted(loaded.select(batch).join(F.broadcast(key), same_batch, "left_semi"), "rows_loaded"), "loaded")
    if tally is not None and tuple(fresh.agg(*_tally(batch, F.col("rows_loaded"))).first()) == tuple(
            tally.get[k] for k in ("rows", "sum_0", "sum_1")):
        counts = key.join(fresh, same_batch, "left").drop(batch).withColumn("rows_dumped", F.col("rows_loaded"))
    else:
        counts = (
            key.join(counted(dumped, "rows_dumped"), same_batch, "left").drop(batch)
            .join(fresh, same_batch, "left").drop(batch)
        )
    counts = counts.withColumnRenamed("_open", batch).fillna(0, ["rows_dumped", "rows_loaded"]).select(
        batch, "rows_dumped", "rows_loaded")
    same = F.col("rows_dumped") == F.col("rows_loaded")
    return counts.withColumn("status", F.when(same, "Completed").otherwise("Failed"))


def require_complete(log: DataFrame) -> None:
    """Stop when a batch lost or gained rows."""
    bad = log.filter(F.col("status") == "Failed").limit(1).collect()
    if bad:
        raise ValueError(f"rows loaded do not match rows dumped: {bad[0].asDict()}")


def id_delta(source: DataFrame, target: DataFrame, column: str) -> DataFrame:
    """Ids of the source that the target lacks; a missing id counts as one value. Both sides
    are made distinct first, so that a frequent id is combined before it is shuffled."""
    return source.select(column).distinct().subtract(target.select(column).distinct())


def deliver_file_id(source: DataFrame, target: DataFrame, column: str = "file_id") -> DataFrame:
    """L3: the rows of every file that the target has no row of.

    Ids are made distinct on both sides before they meet; the rows then join the open ids as a
    lookup, because one file may hold a large part of all rows.
    """
    todo = id_delta(source, target, column)
    return lookup_join(source, todo, [column], "left_semi")


def newest_rows(
    source: DataFrame, target: DataFrame, keys: Sequence[str], time: str, tie: str
) -> DataFrame:
    """L4: source rows newer than the newest target row, the newest per key."""
    newest = target.agg(F.max(time).alias("t"))
    fresh = source.filter(F.col(time) > F.coalesce(newest.scalar(), F.lit("0001-01-01").cast("timestamp")))
    rest = [c for c in target.columns if c not in keys]
    return (
        fresh.groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), F.struct(time, tie)).alias("_r"))
        .select(*keys, "_r.*")
    )


def deliver_last_update(
    source: DataFrame, target: DataFrame, keys: Sequence[str], time: str, tie: str, stored: bool = False
) -> DataFrame:
    """L4: the target with the newest source rows over it; ``stored`` as a table, the target read
    once for the merge and once for its newest time."""
    merge = merge_stored if stored else merge_rows
    return merge(target, newest_rows(source, target, keys, time, tie), keys, check_changes=False, unique=True)


def deliver_project(rows: DataFrame, catalog: DataFrame, project: str, column: str = "file_id") -> DataFrame:
    """Every row of a project, by the ids of its files."""
    ids = catalog.filter(F.col("project_name") == project).select(column).distinct()
    return lookup_join(rows, ids, [column], "left_semi")


def publish_log(batches: DataFrame, catalog: DataFrame, column: str = "file_id") -> DataFrame:
    """One row per moved file with its name and path; a file without a catalog row keeps
    empty names."""
    names = catalog.select(column, "file_name", "file_path")
    return batches.join(names, column, "left")
