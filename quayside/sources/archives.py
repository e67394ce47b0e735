"""Members of archives as files of their own."""

from __future__ import annotations

import tarfile
import zipfile
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions import paths
from quayside.session import durable
from quayside.sources.storage import CHUNK, spread, task_filesystem

MEMBER_SCHEMA = "parent_path string, member string, path string, file_size long, error string"


# What reading a broken, cut or protected archive raises; a storage error also fails only its file.
UNREADABLE = (OSError, EOFError, ValueError, RuntimeError, KeyError, zipfile.BadZipFile, tarfile.TarError, zlib.error)


def open_members(stream, name: str) -> Iterator[tuple[str, object]]:
    """(member name, readable stream) of a zip, tar, tar.gz or single gz file."""
    import gzip
    import posixpath

    lower = name.lower()
    if lower.endswith(".zip"):
        with zipfile.ZipFile(stream) as archive:
            for info in archive.infolist():
                if not info.is_dir():
                    with archive.open(info) as member:
                        yield info.filename, member
    elif lower.endswith((".tar", ".tar.gz", ".tgz")):
        with tarfile.open(fileobj=stream, mode="r:*") as archive:
            for info in archive:
                if info.isfile():
                    yield info.name, archive.extractfile(info)
    elif lower.endswith(".gz"):
        with gzip.open(stream) as member:
            yield posixpath.basename(name)[: -len(".gz")], member
    else:
        raise ValueError(f"not an archive: {name}")


def member_path(target: str, parent: str, crc: str | None, member: str) -> str:
    """Where a member goes: below the archive's name and checksum, never outside ``target``."""
    import posixpath

    clean = posixpath.normpath("/" + member.replace("\\", "/")).lstrip("/")
    return "/".join([target.rstrip("/"), posixpath.basename(parent), str(crc), clean])


def expand_archives(archives: DataFrame, target: str, skip_existing: bool = False) -> DataFrame:
    """Write the members of each archive below ``target`` and list them with the archive.

    ``archives`` has path and crc, and an id where equal archives must stay apart. An archive is read by one task as a stream and a member is
    written as a stream, so neither has to fit in memory.
    A member is written under a temporary name and then renamed, so a repeated task leaves whole
    files. The listing is written out, so that reading it twice does not unpack twice.
    ``skip_existing`` keeps members that were written before. An archive that can't be read whole
    gives one row with an ``error`` and no member.
    """
    key = F.col("crc").cast("string")
    if "id" in archives.columns:
        key = F.concat_ws("-", F.col("id").cast("string"), key)

    def unpack(batches: Iterator) -> Iterator:
        import shutil
        import uuid

        import pandas as pd
        from pyarrow import fs

        for batch in batches:
            for parent, crc in zip(batch["path"], batch["crc"], strict=True):
                out = []
                try:
                    storage, name = task_filesystem(parent)
                    with storage.open_input_file(name) as stream:
                        for member, content in open_members(stream, name):
                            path = member_path(target, parent, crc, member)
                            sink, place = task_filesystem(path)
                            there = sink.get_file_info(place)
                            if not (skip_existing and there.type == fs.FileType.File):
                                sink.create_dir(place.rsplit("/", 1)[0], recursive=True)
                                part = f"{place}.{uuid.uuid4().hex}.part"
                                with sink.open_output_stream(part, compression=None) as copy:
                                    shutil.copyfileobj(content, copy, CHUNK)
                                sink.move(part, place)
                            out.append((parent, member, path, sink.get_file_info(place).size, None))
                except UNREADABLE as e:
                    out = [(parent, None, None, None, f"{type(e).__name__}: {e}")]
                frame = pd.DataFrame(out, columns=["parent_path", "member", "path", "file_size", "error"], dtype=object)
                yield frame.astype({"file_size": "Int64"})

    listed = spread(archives.withColumn("crc", key), "path", "crc").mapInPandas(unpack, MEMBER_SCHEMA)
    return durable(listed, "members")


def profile_members(
    archives: DataFrame, member_pattern: str, min_bytes: int = 0, max_bytes: int | None = None,
    delimiter: str = ",",
) -> DataFrame:
    """The number of columns of the members that match, in archives of a given size; only the
    first line of a member is read. An archive that can't be read whole gives one row with an
    ``error`` and no member."""
    chosen = archives.filter(F.col("file_size") >= min_bytes)
    if max_bytes is not None:
        chosen = chosen.filter(F.col("file_size") <= max_bytes)
    pattern = paths.java_regex(member_pattern)

    def peek(batches: Iterator) -> Iterator:
        import csv
        import re

        import pandas as pd

        wanted = re.compile(pattern)
        for batch in batches:
            out = []
            for parent in batch["path"]:
                own = []
                try:
                    storage, name = task_filesystem(parent)
                    with storage.open_input_file(name) as stream:
                        for member, content in open_members(stream, name):
                            if wanted.search(member):
                                line = content.readline().decode("iso-8859-1").rstrip("\r\n")
                                fields = next(csv.reader([line], delimiter=delimiter), [])
                                own.append((parent, member, len(fields), None))
                except UNREADABLE as e:
                    own = [(parent, None, None, f"{type(e).__name__}: {e}")]
                out += own
            frame = pd.DataFrame(out, columns=["parent_path", "member", "columns", "error"], dtype=object)
            yield frame.astype({"columns": "Int32"})

    return spread(chosen, "path").mapInPandas(
        peek, "parent_path string, member string, columns int, error string"
    )
