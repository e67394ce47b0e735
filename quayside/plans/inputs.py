"""Input tables and the file catalog derived from ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def files(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    """One catalog row per document: ten in a row are an archive and its nine members. Short texts
    stand for failed files, one source for files still to do, one for copies, one language for
    files that are not to be processed. ``extra`` names columns of the document to carry along."""
    d = table(spark, sf_dir, "documents")
    doc = F.col("doc_id")
    archive = doc % 10 == 0
    return d.select(
        (doc + 1).alias("file_id"),
        F.concat_ws(
            "_", "source", (F.lit(2015) + doc % 8).cast("string"),
            F.concat(doc.cast("string"), F.when(archive, ".zip").otherwise(".csv")),
        ).alias("file_name"),
        F.concat(F.lit("/data/"), F.col("lang")).alias("file_path"),
        F.col("lang").alias("project_name"),
        F.when(archive, "ZIP").otherwise("CSV").alias("file_type"),
        F.when(archive, F.lit(0).cast("long")).otherwise(doc - doc % 10 + 1).alias("parent_file_id"),
        F.md5("text").alias("crc"),
        F.col("n_chars").alias("file_size"),
        F.when(F.col("n_chars") < 300, "FAILED").when(F.col("source") == "src13", "RAW")
        .otherwise("Processed").alias("file_process_state"),
        (F.col("lang") != "de").alias("reprocess"),
        (F.col("source") == "src5").alias("duplicate_file"),
        *extra,
    )


FILES_SQL = """files AS (
  SELECT doc_id + 1 AS file_id,
         source || '_' || CAST(2015 + doc_id % 8 AS VARCHAR) || '_' || CAST(doc_id AS VARCHAR)
           || CASE WHEN doc_id % 10 = 0 THEN '.zip' ELSE '.csv' END AS file_name,
         '/data/' || lang AS file_path,
         lang AS project_name,
         CASE WHEN doc_id % 10 = 0 THEN 'ZIP' ELSE 'CSV' END AS file_type,
         CASE WHEN doc_id % 10 = 0 THEN 0 ELSE doc_id - doc_id % 10 + 1 END AS parent_file_id,
         md5(text) AS crc,
         n_chars AS file_size,
         CASE WHEN n_chars < 300 THEN 'FAILED' WHEN source = 'src13' THEN 'RAW'
              ELSE 'Processed' END AS file_process_state,
         lang <> 'de' AS reprocess,
         source = 'src5' AS duplicate_file
  FROM documents)"""
