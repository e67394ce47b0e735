"""Tables as folders of versions, exports and dumps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.functions import render
from quayside.operators.merge import merge_stored
from quayside.operators.skew import lookup_join
from quayside.session import durable
from quayside.sources.storage import hadoop_children, hadoop_delete, metadata_path


class VersionedTable:
    """A Parquet table whose content is replaced by a new version folder and extended by additions.

    A version, and an addition to one, counts once its write has left the ``_SUCCESS`` mark, so
    readers see the old content or the new one, never half of it, and a failed write leaves the
    table as it was. Two writers that take the same number can't both write: the second one fails.
    With ``keep`` only so many of the newest versions stay. After ``ADDITIONS`` of them the next
    addition writes the table anew, so that reading does not list ever more folders.
    """

    ADDITIONS = 50

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType | None = None, keep: int | None = None):
        if keep is not None and keep < 1:
            raise ValueError("at least one version must stay")
        self.spark, self.path, self.schema, self.keep = spark, path.rstrip("/"), schema, keep

    def _folder(self, version: int) -> str:
        return f"{self.path}/v={version:08d}"

    def _complete(self, prefix: str) -> list[str]:
        """Complete folders of a kind, oldest first."""
        found = sorted(n for n in hadoop_children(self.spark, self.path) if n.startswith(prefix))
        return [n for n in found if "_SUCCESS" in hadoop_children(self.spark, f"{self.path}/{n}")]

    def versions(self) -> list[int]:
        return [int(n[2:]) for n in self._complete("v=")]

    def exists(self) -> bool:
        return bool(self.versions())

    def _additions(self, version: int) -> list[str]:
        return self._complete(f"a={version:08d}-")

    def read(self) -> DataFrame:
        versions = self.versions()
        if not versions:
            if self.schema is None:
                raise FileNotFoundError(self.path)
            return self.spark.createDataFrame([], self.schema)
        reader = self.spark.read if self.schema is None else self.spark.read.schema(self.schema)
        added = [f"{self.path}/{n}" for n in self._additions(versions[-1])]
        return reader.parquet(self._folder(versions[-1]), *added)

    def _next(self) -> int:
        taken = [int(n[2:]) for n in hadoop_children(self.spark, self.path) if n.startswith("v=")]
        return max(taken, default=0) + 1

    def replace(self, df: DataFrame) -> None:
        """K2: the new content, as a whole."""
        df.write.mode("errorifexists").parquet(self._folder(self._next()))
        if self.keep is not None:
            self._forget(self.versions()[:-self.keep])

    def _forget(self, versions: Sequence[int]) -> None:
        for v in versions:
            for name in [n for n in hadoop_children(self.spark, self.path) if n.startswith(f"a={v:08d}-")]:
                hadoop_delete(self.spark, f"{self.path}/{name}")
            hadoop_delete(self.spark, self._folder(v))

    def append(self, df: DataFrame) -> None:
        """K1: rows added to the current version as one addition, columns matched by name."""
        versions = self.versions()
        if not versions:
            self.replace(df)
            return
        now = self.read()
        prefix = f"a={versions[-1]:08d}-"
        taken = [int(n[len(prefix):]) for n in hadoop_children(self.spark, self.path) if n.startswith(prefix)]
        if len(taken) >= self.ADDITIONS:
            self.replace(now.unionByName(df.select(*now.columns)))
            return
        df.select(*now.columns).write.mode("errorifexists").parquet(f"{self.path}/{prefix}{max(taken, default=0) + 1:06d}")


def upsert_partitions(
    spark: SparkSession, path: str, schema: T.StructType, staging: DataFrame, keys: Sequence[str],
    partition: str, **options,
) -> DataFrame:
    """M1 on a partitioned table: read, merge and rewrite only the partitions that staging touches.

    Touched are the partitions staged rows go to and those that hold their keys now. The merged rows
    are written aside before the partitions are replaced, because the merge reads them. A partition
    that all rows left is removed. Returns the merged rows with their action.
    """
    target = spark.read.schema(schema).parquet(path)
    staged_keys = staging.select(*keys).distinct()
    touched = durable(
        lookup_join(target.select(*keys, partition), staged_keys, keys, "left_semi").select(partition)
        .unionByName(staging.select(partition)).distinct(),
        "touched",
    )
    old = lookup_join(target, touched, [partition], "left_semi", stored=True).select(*schema.names)
    merged = merge_stored(old, staging, keys, **options)
    folder = F.regexp_extract(metadata_path(), "^(.*)/[^/]*$", 1).alias("folder")
    left = durable(
        touched.join(merged.select(partition).distinct(), partition, "left_anti").join(
            target.select(partition, folder).distinct(), partition
        ), "left",
    )
    (
        merged.drop("action").hint("rebalance", F.col(partition))
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition).parquet(path)
    )
    for row in left.select("folder").toLocalIterator():
        hadoop_delete(spark, row["folder"])
    return merged


def _flat(df: DataFrame) -> DataFrame:
    """Arrays, maps and structs as JSON, since delimited text has no such values."""
    nested = (T.ArrayType, T.MapType, T.StructType)
    return df.select(
        *[F.to_json(f.name).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name)
          for f in df.schema]
    )


def dump_csv(df: DataFrame, path: str, header: bool = False, delimiter: str = ",") -> None:
    """K3: a query as delimited text, without a header unless asked. Quotes are doubled, blanks at
    the ends of a text stay."""
    _flat(df).write.csv(
        path, header=header, sep=delimiter, escape='"', quoteAll=False,
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def dump_named(df: DataFrame, path: str, names: str) -> None:
    """K5: a query under the given comma-separated column names."""
    dump_csv(df.toDF(*names.split(",")), path, header=True)


def export_tables(tables: dict[str, DataFrame], folder: str) -> DataFrame:
    """Every table as a folder of CSV files with a header, and one catalog row for each."""
    if not tables:
        raise ValueError("no tables to export")
    spark = next(iter(tables.values())).sparkSession
    for name, df in tables.items():
        dump_csv(df, f"{folder}/{name}.csv", header=True)
    found = [(name, f"{name}.csv", folder, "CSV", len(df.columns)) for name, df in tables.items()]
    return spark.createDataFrame(
        found, "table_name string, file_name string, file_path string, file_type string, columns int"
    )


def read_query(spark: SparkSession, sql: str, jdbc: dict[str, str] | None = None) -> DataFrame:
    """The rows of a query, from Spark's own catalog or over a database connection."""
    if jdbc is None:
        return spark.sql(sql)
    return spark.read.format("jdbc").options(**jdbc).option("query", sql).load()


def read_query_batches(spark: SparkSession, table: str, predicates: Sequence[str], jdbc: dict[str, str]) -> DataFrame:
    """A database table, one task per batch predicate."""
    return spark.read.jdbc(jdbc["url"], table, predicates=list(predicates), properties=jdbc)


def create_like(spark: SparkSession, name: str, source: DataFrame, bucket_by: str | None = None,
                buckets: int = 16, replace: bool = False) -> None:
    """An empty table with the schema of the source, distributed by a column when asked."""
    if replace:
        spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:t)", {"t": name})
    writer = source.limit(0).write.format("parquet").mode("ignore")
    if bucket_by:
        writer = writer.bucketBy(buckets, bucket_by)
    writer.saveAsTable(name)


class CatalogTable:
    """A target in the session's catalog, created like its source and distributed by a column.

    Rows with equal values of that column lie in files of one bucket, so joins and aggregates on it
    need no shuffle. Writers don't gather a bucket in one task: a frequent value may fill many files.
    """

    def __init__(self, spark: SparkSession, name: str, source: DataFrame, bucket_by: str, buckets: int = 16):
        self.spark, self.name, self.source, self.bucket_by, self.buckets = spark, name, source, bucket_by, buckets

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    def create(self) -> None:
        self.spark.sql("CREATE DATABASE IF NOT EXISTS IDENTIFIER(:d)", {"d": self.name.split(".")[0]})
        create_like(self.spark, self.name, self.source, self.bucket_by, self.buckets)

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def _write(self, df: DataFrame, overwrite: bool) -> None:
        df.select(*self.read().columns).write.insertInto(self.name, overwrite=overwrite)
        self.spark.catalog.refreshTable(self.name)

    def replace(self, df: DataFrame) -> None:
        """K2: the new content, as a whole; readers may see the table empty for a moment."""
        self._write(df, True)

    def append(self, df: DataFrame) -> None:
        self._write(df, False)


def _dump_document(head: str, rows: DataFrame, tail: str, between: str, path: str) -> None:
    """Lines of text written by the executors: ``head``, every row, ``tail``; the part files in the
    order of their names are the document. ``rows`` has one column; ``between`` goes before each
    row but the first."""
    spark, name = rows.sparkSession, rows.columns[0]
    stored = durable(rows.withColumn("_at", F.monotonically_increasing_id()), "document")
    first = stored.agg(F.min("_at")).first()[0]
    lead = F.when(F.col("_at") == F.lit(first), "").otherwise(between) if first is not None else F.lit("")
    body = stored.orderBy("_at").select(F.concat(lead, F.col(name)).alias("value"))  # files are read in no order
    edge = lambda text: spark.createDataFrame([(text,)], "value string").coalesce(1)
    edge(head).union(body).union(edge(tail)).write.mode("overwrite").text(path)


def dump_json(df: DataFrame, path: str) -> None:
    """K6: ``{"data": [[text, ...], ...]}`` of all rows."""
    _dump_document('{"data": [', df.select(render.json_row(df.columns).alias("value")), "]}", ", ", path)


def dump_html(df: DataFrame, path: str, sortable: Sequence[int] = ()) -> None:
    """K7: an HTML table of all rows, chosen header cells marked for sorting."""
    head = f"<table><thead><tr>{render.html_header(df.columns, sortable)}</tr></thead><tbody>"
    _dump_document(head, df.select(render.html_row(df.columns).alias("value")), "</tbody></table>", "", path)


def dump_markdown(df: DataFrame, path: str) -> None:
    """K8: a Markdown table of all rows; cells hold no line ends."""
    lines = render.markdown_header(df.columns)
    _dump_document("\n".join(lines), df.select(render.markdown_row(df.columns).alias("value")), "", "", path)
