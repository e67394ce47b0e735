"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_LOCAL_ROOTS: dict[str, str] = {}


def get_session(app_name: str = "quayside", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs in this package expect.

    Only what differs from Spark's defaults and what matters for results is set; sizes such as
    executor memory and shuffle partitions belong to the cluster.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.ui.enabled", "false")
        # The state of streams on executors' disks, not in their heaps.
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a local master without that setting a temporary folder stands in. On a cluster the setting
    is required, because a machine-local folder would be lost with its executor.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[app] = tempfile.mkdtemp(prefix="quayside-")
    return _LOCAL_ROOTS[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below this application's part of the shared folder."""
    app = spark.sparkContext.applicationId
    return f"{scratch_root(spark)}/{app}/{label}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Remove what this application wrote to the shared folder, once its results are stored."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(
        f"{scratch_root(spark)}/{spark.sparkContext.applicationId}"
    )
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def row_bytes(df: DataFrame) -> Column:
    """About how many bytes a row takes: texts and binaries by their length, nested values by
    their JSON, anything else eight."""
    parts = [F.lit(8)]
    for f in df.schema:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            parts.append(F.coalesce(F.octet_length(f"`{f.name}`"), F.lit(0)))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            parts.append(F.coalesce(F.length(F.to_json(F.struct(f"`{f.name}`"))), F.lit(0)))
        else:
            parts.append(F.lit(8))
    return reduce(lambda a, b: a + b, parts).cast("long")


def durable(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Used where a result is read more than once and must be the same each time (positions handed
    out by a sort) or where recomputing it would repeat side effects (files written by a task).
    A lost executor costs only the tasks that read the table again.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Remove a table that ``durable`` wrote and that nothing reads any more, so that a long job keeps
    only what it still needs on disk. What lies outside the shared folder is left alone."""
    jvm, spark = df.sparkSession.sparkContext._jvm, df.sparkSession
    folder = jvm.org.apache.hadoop.fs.Path(f"{scratch_root(spark)}/{spark.sparkContext.applicationId}")
    storage = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    inside = storage.makeQualified(folder).toString() + "/"
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        table = storage.makeQualified(jvm.org.apache.hadoop.fs.Path(path))
        if table.toString().startswith(inside):
            storage.delete(table, True)


def durable_sized(df: DataFrame, label: str) -> tuple[DataFrame, int, int]:
    """``durable`` with the number of rows and bytes, counted while they are written."""
    path, size = scratch_path(df.sparkSession, label), Observation()
    counted = df.observe(
        size, F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(row_bytes(df)), F.lit(0)).alias("bytes")
    )
    counted.write.parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    return stored, size.get["rows"], size.get["bytes"]

