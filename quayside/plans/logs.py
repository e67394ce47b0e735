"""Error log and load status tables, and the upsert that writes them."""

from __future__ import annotations

import getpass

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.operators import merge
from quayside.session import durable
from quayside.sources.tables import VersionedTable

# Longest error text, and longest statement.
ERROR_LENGTH, STATEMENT_LENGTH = 256, 2000

ERROR_SCHEMA = T.StructType([
    T.StructField("file_id", T.LongType()), T.StructField("error_code", T.StringType()),
    T.StructField("error_message", T.StringType()), T.StructField("error_timestamp", T.TimestampNTZType()),
    T.StructField("user_name", T.StringType()), T.StructField("program_unit", T.StringType()),
    T.StructField("sql_statement", T.StringType()),
])
STATUS_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType()), T.StructField("program_unit", T.StringType()),
    T.StructField("program_unit_type_code", T.StringType()), T.StructField("file_path", T.StringType()),
    T.StructField("created_date", T.TimestampNTZType()), T.StructField("created_by", T.StringType()),
    T.StructField("success", T.StringType()), T.StructField("start_date", T.TimestampNTZType()),
    T.StructField("end_date", T.TimestampNTZType()), T.StructField("previous_record_count", T.LongType()),
    T.StructField("records_inserted", T.LongType()), T.StructField("records_deleted", T.LongType()),
    T.StructField("records_updated", T.LongType()), T.StructField("current_record_count", T.LongType()),
])


class Logs:
    """The two log tables below a folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.errors = VersionedTable(spark, f"{folder.rstrip('/')}/error_log", ERROR_SCHEMA)
        self.status = VersionedTable(spark, f"{folder.rstrip('/')}/load_status", STATUS_SCHEMA)

    def _fill(self, rows: DataFrame, schema: T.StructType) -> DataFrame:
        defaults = {
            "user_name": F.lit(getpass.getuser()), "created_by": F.lit(getpass.getuser()),
            "error_timestamp": F.current_timestamp(), "created_date": F.current_timestamp(),
        }
        return rows.select(*[
            (F.col(f.name) if f.name in rows.columns else defaults.get(f.name, F.lit(None)))
            .cast(f.dataType).alias(f.name) for f in schema
        ])

    def add_errors(self, rows: DataFrame) -> None:
        cut = self._fill(rows, ERROR_SCHEMA).withColumns({
            "error_message": F.substring("error_message", 1, ERROR_LENGTH),
            "sql_statement": F.substring("sql_statement", 1, STATEMENT_LENGTH),
        })
        self.errors.append(cut)

    def add_status(self, rows: DataFrame) -> None:
        self.status.append(self._fill(rows, STATUS_SCHEMA))

    def last_success(self, table_name: str, program_unit: str):
        """When the last good run of a program on a table started."""
        mine = self.status.read().filter(
            (F.col("table_name") == table_name) & (F.col("program_unit") == program_unit) & (F.col("success") == "Y")
        )
        return mine.agg(F.max("start_date").alias("t")).first()["t"]


def run_upsert(
    target: VersionedTable, staging: DataFrame, keys: list[str], table_name: str, logs: Logs, **options
) -> bool:
    """M4: upsert a staged load into a table, with its status row; on failure an error row is
    written, the status says so and the table stays as it was."""
    spark, unit = staging.sparkSession, f"{table_name}_upsert"
    start = spark.range(1).select(F.current_timestamp().cast("timestamp_ntz").alias("t")).first()["t"]
    before = target.read()
    stamps = {"start_date": F.lit(start), "end_date": F.current_timestamp().cast("timestamp_ntz")}
    try:
        merged = merge.merge_stored(before, staging, keys, **options)
        status = durable(merge.load_status(before, merged, table_name, unit), "status")
        target.replace(merged.drop("action"))
    except PySparkException as e:
        failure = spark.createDataFrame(
            [(type(e).__name__, str(e), unit, "upsert")],
            "error_code string, error_message string, program_unit string, sql_statement string",
        )
        logs.add_errors(failure)
        failed = spark.createDataFrame(
            [(table_name, unit, "UPSERT", "N")],
            "table_name string, program_unit string, program_unit_type_code string, success string",
        )
        logs.add_status(failed.withColumns(stamps))
        return False
    logs.add_status(status.withColumns(stamps))
    return True
