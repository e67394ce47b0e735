"""Keyed merges on plain files: upsert with change detection, insert-ignore, versioned tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.operators.skew import BROADCAST_BYTES, BROADCAST_ROWS, fits_broadcast
from quayside.session import durable, durable_sized, scratch_path

# Columns left out of the change comparison (M1).
TECHNICAL = ("file_id", "cdo_last_update")

INSERT, UPDATE, UNCHANGED, TARGET_ONLY = "insert", "update", "unchanged", "target_only"


def one_per_key(staging: DataFrame, keys: Sequence[str], dedupe_by: str | None = None) -> DataFrame:
    """Staging rows with a unique key. A repeated key fails the job (F27), unless a column says
    which row wins; two winners fail it as well. The check is an aggregate on the merge key, so it
    shares the join's shuffle."""
    rest = [c for c in staging.columns if c not in keys]
    levels = [*keys] if dedupe_by is None else [*dict.fromkeys([*keys, dedupe_by])]
    grouped = staging.groupBy(*levels).agg(F.first(F.struct(*rest)).alias("_r"), F.count(F.lit(1)).alias("_n"))
    if dedupe_by is not None:
        best = F.max_by(F.struct("_r", "_n"), F.col(dedupe_by))
        # without any value of that column no row wins: all of them count
        total = F.when(F.max(dedupe_by).isNull(), F.sum("_n"))
        grouped = grouped.groupBy(*keys).agg(best.alias("_b"), F.first("_r").alias("_any"), total.alias("_all")).select(
            *keys, F.coalesce("_b._r", "_any").alias("_r"), F.coalesce("_all", "_b._n").alias("_n")
        )
    return grouped.withColumn(
        "_r",
        F.when(F.col("_n") == 1, F.col("_r")).otherwise(
            F.raise_error(F.concat(F.lit("staging key is not unique: "), F.to_json(F.struct(*keys))))
        ),
    ).select(*keys, "_r.*")


def _changed(columns: Sequence[str], check: bool) -> Column:
    if not check:
        return F.lit(True)
    compared = [c for c in columns if c not in TECHNICAL]
    return reduce(
        lambda a, b: a | b,
        [~F.col(f"s.{c}").eqNullSafe(F.col(f"t.{c}")) for c in compared],
        F.lit(False),
    )


def merge_rows(
    target: DataFrame,
    staging: DataFrame,
    keys: Sequence[str],
    check_changes: bool = True,
    dedupe_by: str | None = None,
    unique: bool = False,
) -> DataFrame:
    """The merged table with an ``action`` column.

    New keys are inserted; existing ones take the staging row when a non-technical column differs
    (always, without ``check_changes``); unchanged rows keep their old ``file_id`` (F28).

    * Staging counted small: its rows are stored once and broadcast, the target is not shuffled. It
      is read for its rows and once more for its keys alone; ``merge_stored`` needs one read.
    * Otherwise one full outer join on the unique keys. ``unique`` skips the key check for staging
      that is unique by construction.
    """
    keys = list(keys)
    fresh = unique_rows(target, staging, keys, dedupe_by, unique)
    if fits_broadcast(staging.select(*target.columns)):
        fresh = durable(fresh, "staging")
        # The target keys that staging holds: no more rows than staging has.
        known = target.select(*keys).join(F.broadcast(fresh.select(*keys)), keys, "left_semi")
        return kept_rows(target, fresh, keys, check_changes).unionByName(new_rows(fresh, known, keys))
    return _merge_all(target, fresh, keys, check_changes)


def unique_rows(
    target: DataFrame, staging: DataFrame, keys: list[str], dedupe_by: str | None = None, unique: bool = False
) -> DataFrame:
    """The staging rows in the target's columns, one per key."""
    if unique:
        return staging.select(*target.columns)
    columns = dict.fromkeys([*target.columns, *([dedupe_by] if dedupe_by else [])])
    return one_per_key(staging.select(*columns), keys, dedupe_by).select(*target.columns)


def _on_keys(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys])


def kept_rows(target: DataFrame, fresh: DataFrame, keys: list[str], check_changes: bool) -> DataFrame:
    """The target's rows after the merge with a small staging, with their action; one read."""
    rest = [c for c in target.columns if c not in keys]
    marked = fresh.withColumn("_s", F.lit(True)).alias("s")
    joined = target.alias("t").join(F.broadcast(marked), _on_keys(keys), "left")
    action = F.when(F.col("s._s").isNull(), TARGET_ONLY).when(_changed(rest, check_changes), UPDATE).otherwise(UNCHANGED)
    take = action == UPDATE
    return joined.select(
        *[F.col(f"t.{c}").alias(c) if c in keys else F.when(take, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c)
          for c in target.columns],
        action.alias("action"),
    )


def new_rows(fresh: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    """The staging rows whose key the target lacks; ``known`` are the keys that both have."""
    return fresh.join(known, keys, "left_anti").select(*fresh.columns).withColumn("action", F.lit(INSERT))


def merge_stored(
    target: DataFrame, staging: DataFrame, keys: Sequence[str], check_changes: bool = True,
    dedupe_by: str | None = None, unique: bool = False,
) -> DataFrame:
    """``merge_rows`` as a stored table, as jobs need it: staging and target are read once.

    With a small staging the target's merged rows are written first; their actions tell which
    staged keys they met, and the rows of the others are added to the same table.
    """
    keys, spark = list(keys), target.sparkSession
    path = scratch_path(spark, "merged")
    fresh, count, size = durable_sized(unique_rows(target, staging, keys, dedupe_by, unique), "staging")
    if count > BROADCAST_ROWS or size > BROADCAST_BYTES:
        whole = _merge_all(target, fresh, keys, check_changes)
        whole.write.parquet(path)
        return spark.read.schema(whole.schema).parquet(path)
    kept = kept_rows(target, fresh, keys, check_changes)
    kept.write.parquet(path)
    met = spark.read.schema(kept.schema).parquet(path).filter(F.col("action").isin(UPDATE, UNCHANGED)).select(*keys)
    new_rows(fresh, met, keys).write.mode("append").parquet(path)
    return spark.read.schema(kept.schema).parquet(path)


def _merge_all(target: DataFrame, fresh: DataFrame, keys: list[str], check_changes: bool) -> DataFrame:
    changed = _changed([c for c in target.columns if c not in keys], check_changes)
    marked, on_keys = fresh.withColumn("_s", F.lit(True)).alias("s"), _on_keys(keys)
    joined = target.withColumn("_t", F.lit(True)).alias("t").join(marked, on_keys, "full_outer")
    action = (
        F.when(F.col("t._t").isNull(), INSERT)
        .when(F.col("s._s").isNull(), TARGET_ONLY)
        .when(changed, UPDATE)
        .otherwise(UNCHANGED)
    )
    take = action.isin(INSERT, UPDATE)
    return joined.select(
        *[
            F.coalesce(F.col(f"t.{k}"), F.col(f"s.{k}")).alias(k)
            if k in keys
            else F.when(take, F.col(f"s.{k}")).otherwise(F.col(f"t.{k}")).alias(k)
            for k in target.columns
        ],
        action.alias("action"),
    )


def load_from_staging(
    target: DataFrame, staging: DataFrame, keys: Sequence[str], file_id: int | Column, **options
) -> DataFrame:
    """M2: stamp the file id, then upsert when the target has a key, else append."""
    stamp = F.lit(file_id).cast("long") if isinstance(file_id, int) else file_id
    stamped = staging.withColumn("file_id", stamp)
    if keys:
        return merge_rows(target, stamped, keys, **options).drop("action")
    return target.unionByName(stamped.select(*target.columns))


def insert_ignore(target: DataFrame, fresh: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows to append: one per key, and only keys the target lacks.

    Of rows with equal keys the smallest by the other columns' values stays. A key with a NULL equals no other, so all
    such rows are appended, as a database's conflict rule has it.
    """
    keys, others = list(keys), [c for c in fresh.columns if c not in keys]
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    keyed = fresh.filter(whole)
    if others:
        keyed = keyed.groupBy(*keys).agg(F.min(F.struct(*others)).alias("_row")).select(*keys, "_row.*")
    else:
        keyed = keyed.distinct()
    new = keyed.join(target.select(*keys), keys, "left_anti").select(*fresh.columns)
    return new.unionByName(fresh.filter(~whole))


def set_where(df: DataFrame, column: str, value: Column, predicate: Column) -> DataFrame:
    """M8: update one column where a predicate holds."""
    return df.withColumn(
        column, F.when(predicate, value).otherwise(F.col(column)).cast(df.schema[column].dataType)
    )


# The types add_column knows (M9).
ADDABLE = {"Integer": "int", "String": "string", "uuid": "string"}


def add_column(df: DataFrame, name: str, kind: str) -> DataFrame:
    """M9: an empty column of a known type."""
    if kind not in ADDABLE:
        raise ValueError(f"unknown column type {kind}")
    return df.withColumn(name, F.lit(None).cast(ADDABLE[kind]))


def load_status(
    target: DataFrame, merged: DataFrame, table_name: str, program_unit: str, unit_type: str = "UPSERT"
) -> DataFrame:
    """One status row: records before, after, inserted, updated, deleted."""
    def acted(what: str) -> Column:
        return F.count_if(F.col("action") == what)

    after = merged.agg(
        acted(INSERT).alias("records_inserted"),
        acted(UPDATE).alias("records_updated"),
        F.count(F.lit(1)).alias("current_record_count"),
    )
    before = target.agg(F.count(F.lit(1)).alias("n"))
    return after.select(
        F.lit(table_name).alias("table_name"),
        F.lit(program_unit).alias("program_unit"),
        F.lit(unit_type).alias("program_unit_type_code"),
        F.lit("Y").alias("success"),
        before.scalar().alias("previous_record_count"),
        "records_inserted",
        "records_updated",
        F.lit(0).cast("long").alias("records_deleted"),
        "current_record_count",
    )
