"""Directory listings and first lines."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions import paths
from quayside.session import durable
from quayside.sources.storage import checked_folder, head_lines, spread, task_filesystem

LISTING = "path string, is_folder boolean, file_size long, modified timestamp, error string"
ROWS_AT_ONCE = 10_000


def folder_entries(uri: str) -> Iterator[tuple]:
    """What lies directly in a folder, hidden names included: path, is_folder, size, time (seconds).

    A link to a folder is neither followed nor listed, so a listing ends."""
    import os

    from pyarrow import fs

    storage, name = task_filesystem(uri)
    if isinstance(storage, fs.LocalFileSystem):
        with os.scandir(name) as found:
            for entry in found:
                if entry.is_dir():
                    if not entry.is_symlink():
                        yield f"{name.rstrip('/')}/{entry.name}", True, None, None
                elif entry.is_file():
                    status = entry.stat()
                    yield f"{name.rstrip('/')}/{entry.name}", False, status.st_size, status.st_mtime
        return
    scheme = uri.split("://")[0]
    for info in storage.get_file_info(fs.FileSelector(name, recursive=False)):
        folder = info.type == fs.FileType.Directory
        yield f"{scheme}://{info.path}", folder, None if folder else info.size, info.mtime and info.mtime.timestamp()


def _entries(folders: DataFrame) -> DataFrame:
    """One round: the folders of the frontier listed by tasks, in batches of bounded rows."""
    def read(batches: Iterator) -> Iterator:
        import itertools

        import pandas as pd

        for batch in batches:
            for uri in batch["path"]:
                try:
                    rows = ((path, folder, size, at, None) for path, folder, size, at in folder_entries(uri))
                    while part := list(itertools.islice(rows, ROWS_AT_ONCE)):
                        out = pd.DataFrame(part, columns=["path", "is_folder", "file_size", "modified", "error"])
                        out["file_size"] = out["file_size"].astype("Int64")
                        out["modified"] = pd.to_datetime(out["modified"].astype("float64"), unit="s").dt.floor("ms")
                        yield out
                except OSError as e:
                    yield pd.DataFrame({"path": [uri], "is_folder": [None], "file_size": [None], "modified": [pd.NaT],
                                        "error": [str(e)]})

    return spread(folders, "path").mapInPandas(read, LISTING)


def list_folders(spark: SparkSession, folder: str) -> DataFrame:
    """All files below a folder, and the folders that could not be read with their ``error``.

    Rounds: tasks list the folders of the frontier, the folders found there are the next one. The
    frontier is a stored table, so its size does not matter, and there are as many rounds as the
    tree is deep. A folder's own listing is one task's, as storage hands it out in order.
    """
    frontier = spark.createDataFrame([(checked_folder(folder),)], "path string")
    rounds = []
    while not frontier.isEmpty():
        found = durable(_entries(frontier), "listing")
        rounds.append(found.filter("not coalesce(is_folder, false)"))
        frontier = found.filter("is_folder").select("path")
    return reduce(DataFrame.unionByName, rounds)


def list_files(spark: SparkSession, folder: str, pattern: str | None = None) -> DataFrame:
    """Files below a folder or object-store prefix, however deep, whose full path matches
    from its start, in this letter case; names that start with ``_`` or ``.`` are files like any
    other. Only names, sizes and times are read, no content. A folder that can't be read fails the
    listing, as files would be missing from it without a word."""
    listed = list_folders(spark, folder)
    broken = listed.filter("error is not null").select("path", "error").first()
    if broken:
        raise OSError(f"cannot list {broken['path']}: {broken['error']}")
    found = listed.select("path", "file_size", "modified")
    if pattern is not None:
        found = found.filter(paths.matches(F.col("path"), pattern))
    return found.withColumns(
        {"file_path": paths.directory(F.col("path")), "file_name": paths.base_name(F.col("path"))}
    )


def first_lines(files: DataFrame) -> DataFrame:
    """The first line of every listed file next to its path; nothing else is read."""
    return head_lines(files, 1).select("path", F.col("line").alias("first_line"))
