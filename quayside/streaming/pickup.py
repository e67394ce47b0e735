"""Files that arrive in a folder are loaded once, duplicates by content left out."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from quayside.session import discard, durable
from quayside.sources.delimited import read_delimited
from quayside.sources.storage import digests, hadoop_children, literal, plain_path

SEEN_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()), T.StructField("crc", T.StringType()),
    T.StructField("duplicate_file", T.BooleanType()), T.StructField("epoch", T.LongType()),
])
FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def stream_files(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """The files as they appear, by path alone; the checkpoint of the query remembers them."""
    reader = spark.readStream.format("binaryFile").schema(FILE_SCHEMA).option("recursiveFileLookup", "true")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(folder).select(plain_path(F.col("path")).alias("path"))


def judged(files: DataFrame) -> DataFrame:
    """Each file of a stream with its checksum and whether its content came before.

    The checksums seen are state, keyed by checksum: a batch reads and writes the state of its own
    checksums only, however many were seen. Of equal files in one batch the first by path counts. A
    file that can't be read stops the batch, which is then delivered again.
    """
    broken = F.raise_error(F.concat_ws(": ", "path", "error"))
    summed = digests(files).select("path", F.coalesce("crc", broken).alias("crc"))

    def judge(key: tuple, parts: Iterator, state: GroupState) -> Iterator:
        import pandas as pd

        best = None
        for part in parts:
            paths = part["path"].tolist()
            if not state.exists:
                # The smallest path so far is held back, whatever it beats is a copy.
                best, *paths = sorted([*([best] if best is not None else []), *paths])
            if paths:
                yield pd.DataFrame({"path": paths, "crc": key[0], "duplicate_file": True})
        if best is not None:
            state.update((best,))
            yield pd.DataFrame({"path": [best], "crc": key[0], "duplicate_file": False})

    return summed.groupBy("crc").applyInPandasWithState(
        judge, "path string, crc string, duplicate_file boolean", "path string", "append", GroupStateTimeout.NoTimeout)


def load_batch(
    spark: SparkSession, names: Sequence[str], target: str, seen: str, **options
) -> Callable[[DataFrame, int], None]:
    """What to do with a batch of judged files: read those whose content is new, and write rows and
    verdicts into folders of the batch's own number.

    A batch that is delivered again after a failure overwrites the same folders, with the verdicts
    of the state before it, so nothing is loaded twice and nothing is lost.
    """
    def write(files: DataFrame, epoch: int) -> None:
        marked = durable(files, "judged")
        marked.write.mode("overwrite").parquet(f"{seen}/epoch={epoch}")
        fresh = [literal(r["path"]) for r in marked.filter("not duplicate_file").select("path").toLocalIterator()]
        if fresh:
            read_delimited(spark, fresh, names, **options).write.mode("overwrite").parquet(f"{target}/epoch={epoch}")
        discard(marked)

    return write


def read_seen(spark: SparkSession, seen: str) -> DataFrame:
    if not any(n.startswith("epoch=") for n in hadoop_children(spark, seen)):
        return spark.createDataFrame([], SEEN_SCHEMA)
    return spark.read.schema(SEEN_SCHEMA).option("basePath", seen).parquet(seen)


def load_available(
    spark: SparkSession, folder: str, names: Sequence[str], target: str, seen: str, checkpoint: str,
    max_files: int | None = None, **options,
) -> StreamingQuery:
    """Load every file the checkpoint has not seen, then stop. ``options`` are those of
    ``read_delimited``."""
    return (
        judged(stream_files(spark, folder, max_files))
        .writeStream.foreachBatch(load_batch(spark, names, target, seen, **options))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
