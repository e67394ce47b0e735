"""Paths and streams, on the driver and inside tasks."""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.session import durable

CHUNK = 8 << 20


def plain_path(path: Column) -> Column:
    """``file:///a`` and ``file:/a`` as ``/a``; other schemes unchanged."""
    return F.regexp_replace(path, "^file:/+", "/")


def metadata_path() -> Column:
    """The path of the file a row was read from, in the form listings use: percent-decoded. A plus
    sign is kept from being read as a blank."""
    raw = F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))
    return plain_path(F.url_decode(raw))


def task_filesystem(uri: str):
    """The file system and path of a URI, for streaming inside a task."""
    from pyarrow import fs

    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[len("file:"):].lstrip("/")
    return fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


def literal(path: str) -> str:
    """A path for Spark's readers, which take paths as patterns: what is special there is escaped."""
    return re.sub(r"([{}\[\]*?\\])", r"\\\1", path)


def hadoop_children(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder, hidden ones included; empty when it does not exist."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    storage = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not storage.exists(folder):
        return []
    return [status.getPath().getName() for status in storage.listStatus(folder)]


def folder_exists(spark: SparkSession, path: str) -> bool:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)


def hadoop_delete(spark: SparkSession, path: str) -> None:
    """Remove a folder with what it holds."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def hidden(path: Column) -> Column:
    """Whether Spark's readers pass over a file for its name."""
    return F.substring_index(path, "/", -1).rlike("^[_.]")


def visible_copies(files: DataFrame, folder: str, path: str = "path") -> tuple[DataFrame, bool]:
    """Each file's path and the one to read it by (``shown``), and whether any differ: its own, or that
    of a copy below ``folder`` where its name is one that Spark's readers pass over. A copy is
    written under a temporary name and then renamed, so a repeated task leaves whole files."""
    if files.filter(hidden(F.col(path))).isEmpty():
        return files.select(F.col(path).alias("path"), F.col(path).alias("shown")), False

    def copy(batches: Iterator) -> Iterator:
        import hashlib
        import shutil
        import uuid

        import pandas as pd

        for batch in batches:
            out = []
            for uri in batch[path]:
                name = uri.rsplit("/", 1)[1].lstrip("_.") or "file"
                shown = f"{folder}/{hashlib.md5(uri.encode()).hexdigest()}/{name}"
                source, there = task_filesystem(uri)
                sink, place = task_filesystem(shown)
                sink.create_dir(place.rsplit("/", 1)[0], recursive=True)
                part = f"{place.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}"
                with source.open_input_stream(there, compression=None) as content, \
                        sink.open_output_stream(part, compression=None) as target:
                    shutil.copyfileobj(content, target, CHUNK)
                sink.move(part, place)
                out.append((uri, place if "://" not in shown or shown.startswith("file:") else shown))
            yield pd.DataFrame(out, columns=["path", "shown"])

    plain = files.filter(~hidden(F.col(path))).select(F.col(path).alias("path"), F.col(path).alias("shown"))
    copied = spread(files.filter(hidden(F.col(path))), path).mapInPandas(copy, "path string, shown string")
    return plain.unionByName(durable(copied, "visible")), True


def checked_folder(folder: str) -> str:
    """A folder in the form listings use. Tasks reach files by other means than Spark's readers, so
    a scheme they do not know fails here, before any work."""
    from pyarrow import lib

    if folder.startswith("file:"):
        folder = "/" + folder[len("file:"):].lstrip("/")
    try:
        task_filesystem(folder)
    except (lib.ArrowInvalid, lib.ArrowNotImplementedError) as e:
        raise ValueError(f"tasks cannot read {folder}: {e}") from e
    return folder.rstrip("/") or "/"


def move_files(spark: SparkSession, folder: str, target: str) -> None:
    """Rename the data files of a folder into another one of the same storage; their names are unique."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    storage = path(target).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    storage.mkdirs(path(target))
    for name in hadoop_children(spark, folder):
        if not name.startswith(("_", ".")) and not storage.rename(path(folder, name), path(target, name)):
            raise OSError(f"cannot move {folder}/{name} to {target}")


CHECKSUM_SCHEMA = "path string, crc string, error string"


# Work that takes a whole file at a time: a task gets about this many files and bytes.
FILES_PER_TASK, BYTES_PER_TASK = 100, 256 << 20


def spread(files: DataFrame, column: str, *extra: str) -> DataFrame:
    """Files over tasks by number and, where ``file_size`` is known, by bytes; few files are one per
    task. The number of tasks is explicit: rows of paths are so small that adaptive execution would
    merge them into one."""
    size = F.sum("file_size") if "file_size" in files.columns else F.lit(0)
    count, total = files.agg(F.count(F.lit(1)), F.coalesce(size, F.lit(0))).first()
    wanted = max(
        4 * files.sparkSession.sparkContext.defaultParallelism,
        count // FILES_PER_TASK, total // BYTES_PER_TASK,
    )
    return files.select(column, *extra).repartition(max(1, min(count, wanted)), column)


HEAD_SCHEMA = "path string, line_no long, line string"


def head_lines(
    files: DataFrame, count: int, encoding: str = "UTF-8", keep_cr: bool = False, path: str = "path",
    skip_blank: bool = False,
) -> DataFrame:
    """The first ``count`` lines of each file with their numbers from 0; the rest of a file is not
    read. For headers and samples, where a scan of all lines would read everything for a few. A file
    that is gone has no lines."""
    def read(batches: Iterator) -> Iterator:
        import io
        import itertools

        import pandas as pd

        for batch in batches:
            for uri in batch[path]:
                storage, name = task_filesystem(uri)
                out = []
                if storage.get_file_info(name).size is None:
                    continue
                with storage.open_input_stream(name, compression=None, buffer_size=1 << 16) as stream:
                    text = io.TextIOWrapper(
                        io.BufferedReader(stream), encoding=encoding, errors="replace",
                        newline="\n" if keep_cr else None,
                    )
                    shown = (line for line in text if line.strip()) if skip_blank else text
                    for number, line in enumerate(itertools.islice(shown, count)):
                        out.append((uri, number, line.removesuffix("\n")))
                yield pd.DataFrame(out, columns=["path", "line_no", "line"])

    return spread(files, path).mapInPandas(read, HEAD_SCHEMA)


def digests(files: DataFrame, path: str = "path") -> DataFrame:
    """MD5 of whole files, read as a stream, so a file may be larger than a row can hold; for streams
    of files too. A file that can't be read has no checksum, but an ``error``."""
    def digest(batches: Iterator) -> Iterator:
        import hashlib

        import pandas as pd

        for batch in batches:
            out = []
            for uri in batch[path]:
                h = hashlib.md5()
                try:
                    storage, name = task_filesystem(uri)
                    with storage.open_input_stream(name, compression=None, buffer_size=CHUNK) as stream:
                        while chunk := stream.read(CHUNK):
                            h.update(chunk)
                    out.append((uri, h.hexdigest(), None))
                except OSError as e:
                    out.append((uri, None, str(e)))
            yield pd.DataFrame(out, columns=["path", "crc", "error"], dtype=object)

    return files.select(path).mapInPandas(digest, CHECKSUM_SCHEMA)


def file_md5(files: DataFrame, path: str = "path") -> DataFrame:
    """MD5 of whole files. One file is read by one task, as MD5 needs its bytes in order."""
    return digests(spread(files, path), path)
