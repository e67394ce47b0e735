"""The steps a mapping can name. Each works on all files of a pass that are at it, as a
DataFrame to DataFrame function; a file that fails is marked, the others go on."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.functions import paths, text
from quayside.operators import catalog as cat
from quayside.operators import merge
from quayside.operators.skew import lookup_join
from quayside.plans.config import MappingRow
from quayside.plans.logs import Logs
from quayside.session import durable, scratch_path
from quayside.sources import archives, delimited, lines, storage, workbooks
from quayside.sources.tables import VersionedTable


@dataclass
class StepContext:
    """What a step may use beside the files it is given."""

    spark: SparkSession
    mappings: list[MappingRow]
    catalog: VersionedTable
    work_dir: str
    data_schema: str = "default"


Step = Callable[[StepContext, DataFrame], DataFrame]
STEPS: dict[str, Step] = {}
# Steps whose work is done elsewhere: sizes come with the listing, ids and quoted prefixes with the
# import (P1, P9, A15).
MARKERS = ("log_file_size", "append_file_id", "append_file_id_w_header", "sed_modify_file")
ID_STEPS = ("append_file_id", "append_file_id_w_header", "upsert_table_from_stg")


def step(name: str) -> Callable[[Step], Step]:
    """Register a step under the name configurations use. ``files`` has the catalog's columns and
    path, mapping, ok and message; the step returns the same rows and columns."""
    def add(fn: Step) -> Step:
        STEPS[name] = fn
        return fn

    return add


def fail_where(files: DataFrame, bad: Column, message: str | Column) -> DataFrame:
    text_ = F.lit(message) if isinstance(message, str) else message
    return files.withColumn(
        "message", F.when(bad, text_).otherwise(F.col("message"))
    ).withColumn("ok", F.col("ok") & ~F.coalesce(bad, F.lit(False)))


def _set(files: DataFrame, values: DataFrame, columns: list[str], key: str = "path") -> DataFrame:
    """Replace columns of the files by those found for the key; unmatched files keep theirs. Both
    sides have one row per file, so a plain join is even."""
    renamed = values.select(key, *[F.col(c).alias(f"_{c}") for c in columns])
    joined = files.join(renamed, key, "left")
    kinds = {f.name: f.dataType for f in files.schema}
    return joined.select(
        *[F.coalesce(F.col(f"_{c}"), F.col(c)).cast(kinds[c]).alias(c) if c in columns else F.col(c)
          for c in files.columns]
    )


@step("generate_checksum")
def generate_checksum(ctx: StepContext, files: DataFrame) -> DataFrame:
    """Only files without a checksum are read."""
    sums = durable(storage.file_md5(files.filter("crc is null")), "sums")
    return _fail(_set(files, sums, ["crc"]), sums)


def _fail(files: DataFrame, found: DataFrame) -> DataFrame:
    """Fail the files with an error in ``found`` (one row per path)."""
    errors = found.filter("error is not null").select("path", F.col("error").alias("_error"))
    marked = files.join(errors, "path", "left")
    return fail_where(marked, F.col("_error").isNotNull(), F.col("_error")).select(*files.columns)


def _paths(files: DataFrame, column: str = "path") -> list[str]:
    """The paths of the files to read, safe from patterns: Spark's readers take them from the driver."""
    return [storage.literal(r[0]) for r in files.select(column).toLocalIterator()]


@step("count_file_linux_wc")
def count_lines(ctx: StepContext, files: DataFrame) -> DataFrame:
    """A1: lines of each file, by one text scan over all of them."""
    shown, _ = storage.visible_copies(files, f"{ctx.work_dir}/visible")
    found = _paths(shown, "shown")
    if not found:
        return files
    counts = lines.lines_per_file(lines.read_lines(ctx.spark, found)).withColumnRenamed("path", "shown")
    named = shown.join(counts, "shown").withColumnRenamed("lines", "total_rows")
    return _set(files, named, ["total_rows"])


@step("row_count_excel")
def row_count_excel(ctx: StepContext, files: DataFrame) -> DataFrame:
    cells, broken = workbooks.readable(durable(workbooks.read_cells(files), "cells"))
    sizes = workbooks.sheet_size(cells)
    return _fail(_set(files, sizes.withColumnRenamed("rows", "total_rows"), ["total_rows"]), broken)


@step("abort_if_duplicate")
def abort_if_duplicate(ctx: StepContext, files: DataFrame) -> DataFrame:
    """A file fails when a processed file of the project, or an earlier one of this pass in
    work order, has its content. (project, crc) is reduced to one row before it is joined."""
    done = (
        ctx.catalog.read().filter(F.col("file_process_state") == cat.PROCESSED)
        .groupBy("project_name", "crc").agg(F.lit(True).alias("_done"))
    )
    place = F.struct(*[c.alias(f"k{i}") for i, c in enumerate(
        [F.col("file_name_data").isNull(), F.col("file_name_data"), F.col("parent_file_id"),
         F.col("file_path"), F.col("file_name")])])
    first = files.filter("ok").groupBy("project_name", "crc").agg(F.min_by("id", place).alias("_first"))
    groups = first.join(done, ["project_name", "crc"], "left")
    marked = lookup_join(files, groups, ["project_name", "crc"], "left")
    bad = F.col("ok") & F.col("crc").isNotNull() & (
        F.coalesce("_done", F.lit(False)) | (F.col("_first") != F.col("id"))
    )
    return fail_where(
        marked.withColumn("duplicate_file", F.coalesce(bad, F.lit(False))), bad, "Duplicate File Found"
    ).select(*files.columns)


@step("extract_compressed_file")
def extract_compressed_file(ctx: StepContext, files: DataFrame) -> DataFrame:
    """Members become catalog rows below their archive, waiting for the next pass. The
    archive's id is in the path of a member, so equal archives have members of their own. An
    archive that can't be read whole fails and has no members."""
    target = f"{ctx.work_dir}/extracted"
    listed = _union([
        archives.expand_archives(group.filter("ok"), target, skip_existing=not row.unzip_again)
        for row, group in _by_mapping(ctx, files)
    ])
    broken = listed.filter("error is not null").select(F.col("parent_path").alias("path"), "error")
    members = listed.filter("error is null")
    parents = files.select(F.col("path").alias("parent_path"), F.col("id").alias("parent_file_id"), "project_name")
    listing = lookup_join(members, parents, ["parent_path"]).select(
        paths.directory(F.col("path")).alias("file_path"),
        paths.base_name(F.col("path")).alias("file_name"),
        paths.extension(paths.base_name(F.col("path"))).alias("file_type"),
        "file_size", "parent_file_id", "project_name",
    )
    known = ctx.catalog.read()
    ctx.catalog.append(cat.add_files(known, listing))
    counts = members.groupBy(F.col("parent_path").alias("path")).agg(F.count(F.lit(1)).alias("total_files"))
    return _fail(_set(files, counts, ["total_files"]), broken)


def _by_mapping(ctx: StepContext, files: DataFrame) -> Iterator[tuple[MappingRow, DataFrame]]:
    """The files of each mapping that occurs; there are no more mappings than the configuration has."""
    used = {r["mapping"] for r in files.select("mapping").distinct().collect()}
    for row in ctx.mappings:
        if row.order in used:
            yield row, files.filter(F.col("mapping") == row.order)


def target_table(row: MappingRow) -> Column:
    """The target table of a file: extracted from its name, configured, or its name."""
    name = F.col("file_name")
    if row.table_name_extract:
        table = paths.table_from_name(name, row.table_name_extract)
    elif row.table_name and row.table_name != "None":
        table = F.lit(row.table_name)
    else:
        table = paths.table_from_name(name)
    return F.lower(table)


def target_names(row: MappingRow, files: DataFrame) -> DataFrame:
    return files.withColumn("_table", target_table(row))


def append_rows(ctx: StepContext, rows: DataFrame, target: str) -> list[str]:
    """K1: append to a catalog table, columns by name; returns the columns the table lacks."""
    spark = ctx.spark
    if not spark.catalog.tableExists(target):
        database = target.split(".")[0]
        spark.sql("CREATE DATABASE IF NOT EXISTS IDENTIFIER(:d)", {"d": database})
        rows.write.format("parquet").saveAsTable(target)
        return []
    have = spark.table(target).schema
    extra = [c for c in rows.columns if c not in have.names]
    if not extra:
        rows.select(
            *[(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in have]
        ).write.format("parquet").mode("append").saveAsTable(target)
    return extra


RESULT = "path string, rows_inserted long, database_table string, error string"


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _finish(files: DataFrame, results: list[DataFrame]) -> DataFrame:
    """Put the outcome of the loads on the files; a file no load spoke of had nothing to read."""
    empty = files.sparkSession.createDataFrame([], RESULT)
    found = _union([empty, *results]).toDF("path", "_rows", "_target", "_error")
    done = files.join(found, "path", "left").withColumns({
        "rows_inserted": F.when(F.col("ok"), F.coalesce("_rows", F.lit(0))).otherwise(F.col("rows_inserted")).cast("long"),
        "database_table": F.coalesce("_target", "database_table"),
        "_error": F.coalesce("_error", F.when(F.col("_rows").isNull(), F.lit("No columns to parse from file"))),
    })
    bad = F.col("ok") & F.col("_error").isNotNull()
    return fail_where(done, bad, F.col("_error")).select(*files.columns)


def _layouts(heads: DataFrame) -> list[tuple]:
    """The (table, column layout) pairs of a mapping, the one of the oldest file first."""
    kind = "_kind" if "_kind" in heads.columns else "_head"
    found = heads.groupBy("_table", kind).agg(F.min("id").alias("i")).orderBy("i").collect()
    return [(r["_table"], r[kind]) for r in found]


def _heads(row: MappingRow, ctx: StepContext, files: DataFrame) -> DataFrame:
    """The files with what decides their columns: the number of fields of the header line when the
    names are configured, else the line itself. Only the heads of the files are read."""
    encoding = delimited.spark_encoding(row.file_encoding)
    found = storage.head_lines(files, row.header_row + 1, encoding, skip_blank=True)
    found = found.filter(F.col("line_no") == row.header_row)
    kind = F.rtrim("line")
    if row.columns and not row.use_header:
        kind = text.field_count(kind, row.delimiter).cast("string")
    return durable(
        files.select("path", "id", "_table").join(found.select("path", kind.alias("_kind")), "path"),
        "heads",
    )


def _names(row: MappingRow, kind: str, table_columns: list[str] | None) -> list[str]:
    """Column names of a layout: configured, or by position from a table that exists (copies), or
    from the header."""
    if row.columns and not row.use_header:
        return delimited.choose_columns(int(kind), row.columns, delimited.parse_list(row.column_list2))
    names = delimited.split_header(kind, row.delimiter)
    if table_columns is not None and not row.use_header:
        return lines.header_columns(table_columns, len(names), False, False)
    return names if row.has_header else [f"column_{i + 1}" for i in range(len(names))]


def _import(ctx: StepContext, files: DataFrame, nulls: str, strict: bool) -> DataFrame:
    """Read the files of each mapping and append them to their tables.

    Files whose columns have the same names are one read and one write, whatever tables they go to:
    rows are written aside by table first, so a file is in its table as a whole or not at all, and
    tables then take over their part. Jobs follow the column layouts, not the tables.
    """
    out = []
    for row, group in _by_mapping(ctx, files):
        good = target_names(row, group.filter("ok"))
        results = []
        if not good.isEmpty():
            heads = _heads(row, ctx, good)
            layouts: dict[tuple, list[tuple[str, str]]] = {}
            refused = []
            for table, kind in _layouts(heads):
                target = f"{row.schema_name}.{table}"
                try:
                    have = ctx.spark.table(target).columns if strict and ctx.spark.catalog.tableExists(target) else None
                    layout = (tuple(_names(row, kind, have)), _with_id(ctx, row, target))
                    layouts.setdefault(layout, []).append((table, kind))
                except ValueError as e:
                    refused.append((table, kind, -1, str(e)))
            numbered = [(t, k, n, None) for n, pairs in enumerate(layouts.values()) for t, k in pairs]
            plan = ctx.spark.createDataFrame(numbered + refused, "_table string, _kind string, _layout int, _why string")
            placed = heads.join(F.broadcast(plan), ["_table", "_kind"])
            if refused:
                results.append(placed.filter("_layout < 0").select(
                    "path", F.lit(0).cast("long"), F.concat(F.lit(f"{row.schema_name}."), "_table"), "_why"))
            for n, (names, with_id) in enumerate(layouts):
                members = placed.filter(F.col("_layout") == n).select("path", "id", "_table")
                tables = list(dict.fromkeys(t for t, _ in layouts[names, with_id]))
                try:
                    results.append(_load(ctx, row, members, tables, list(names), with_id, nulls, strict))
                except PySparkException as e:
                    # rows are appended last, so none of these files is in a table
                    results.append(members.select(
                        "path", F.lit(0).cast("long"), F.concat(F.lit(f"{row.schema_name}."), "_table"), F.lit(short(e))))
        out.append(_finish(group, [r.toDF(*RESULT_NAMES) for r in results]))
    return durable(_union(out), "imported")


def short(error: Exception) -> str:
    """The first line of an error."""
    return f"{type(error).__name__}: {str(error).strip().splitlines()[0] if str(error).strip() else ''}"


def _rewrite(row: MappingRow, fields: int) -> Callable[[Column], Column] | None:
    """What the mapping does to raw lines before they are taken apart."""
    prefixes, quotes = "sed_modify_file" in row.steps, bool(row.new_delimiter)
    if not (prefixes or quotes):
        return None

    def change(line: Column) -> Column:
        line = text.quote_prefixes(line) if prefixes else line
        return text.requote_where_it_fits(line, row.delimiter, fields) if quotes else line

    return change


def _with_id(ctx: StepContext, row: MappingRow, target: str) -> bool:
    """Whether rows carry their file's id: when the mapping asks for it, or merges what it staged
    and the staging table can hold it."""
    if row.append_file_id:
        return True
    asked = any(s in row.steps for s in ID_STEPS)
    return asked and (not ctx.spark.catalog.tableExists(target) or "file_id" in ctx.spark.table(target).columns)


RESULT_NAMES = ("path", "rows_inserted", "database_table", "error")


def _load(
    ctx: StepContext, row: MappingRow, members: DataFrame, tables: list[str], names: list[str], with_id: bool,
    nulls: str, strict: bool,
) -> DataFrame:
    """The files of one column layout into their tables: path, rows, table and error of each."""
    shown, copied = storage.visible_copies(members, f"{ctx.work_dir}/visible")
    files, rewrite = _paths(shown, "shown"), _rewrite(row, len(names))
    by_line = bool(row.append_crc) or rewrite is not None
    quoted = not by_line and delimited.has_quoted_newlines(ctx.spark, files, row.delimiter, row.file_encoding)
    rows = delimited.read_delimited(
        ctx.spark, files, names, row.delimiter, encoding=row.file_encoding,
        has_header=bool(row.has_header), header_row=row.header_row, limit_rows=row.limit_rows,
        nulls=nulls, flag_bad=True, append_crc=bool(row.append_crc), rewrite=rewrite, multi_line=quoted,
    )
    if copied:
        kept = rows.columns
        back = shown.filter("path <> shown").select(F.col("shown").alias("path"), F.col("path").alias("_own"))
        rows = lookup_join(rows, back, ["path"], "left").withColumn("path", F.coalesce("_own", "path")).select(*kept)
    staged = durable(rows, "staged")
    # a row that lacks fields is only bad for a strict load, one with surplus fields always
    wrong = F.col("_bad").isNotNull()
    if not strict:
        wrong = wrong & (text.field_count(F.col("_bad"), row.delimiter) > len(names))
    bad = F.concat(F.lit("malformed row: "), F.max(F.when(wrong, F.col("_bad"))))
    counts = staged.groupBy("path").agg(F.count(F.lit(1)).alias("n"), bad.alias("error"))
    target = F.concat(F.lit(f"{row.schema_name}."), "_table")
    results = durable(
        members.join(counts, "path", "left").select(
            "path",
            F.when(F.col("error").isNull(), F.coalesce("n", F.lit(0))).otherwise(F.lit(0)).alias("rows_inserted"),
            target.alias("database_table"), "error", "id", "_table",
        ),
        "loaded",
    )
    taken = results.filter("error is null").select("path", F.col("id").alias("file_id"), "_table")
    columns = [c for c in staged.columns if c not in ("_bad", "path")]
    clean = lookup_join(staged.select("path", *[F.col(c).alias(f"c_{c}") for c in columns]), taken, ["path"], stored=True)
    clean = clean.select(
        *([F.col("file_id").alias("file_id")] if with_id else []), *[F.col(f"c_{c}").alias(c) for c in columns], "_table")
    extra = _append_to(ctx, clean, [f"{row.schema_name}.{t}" for t in tables], tables)
    for name, found in extra.items():
        message = F.lit(f"columns not in {name}: {','.join(found)}")
        here = F.col("database_table") == name
        results = results.withColumns({
            "error": F.when(here, message).otherwise(F.col("error")),
            "rows_inserted": F.when(here, F.lit(0)).otherwise(F.col("rows_inserted")),
        })
    return results.select(*RESULT_NAMES)


def _append_to(ctx: StepContext, rows: DataFrame, targets: list[str], tables: list[str]) -> dict[str, list[str]]:
    """K1 for several tables: rows with the name of their table in ``_table`` are written once, by
    table, and each table takes over the files of its part. Returns the columns that tables lack."""
    plain = rows.drop("_table")
    if len(tables) == 1:
        extra = append_rows(ctx, plain, targets[0])
        return {targets[0]: extra} if extra else {}
    path, found = scratch_path(ctx.spark, "by-table"), {}
    number = F.create_map(*[x for k, t in enumerate(tables) for x in (F.lit(t), F.lit(k))])
    dealt = rows.withColumn("t", number[F.col("_table")]).drop("_table")
    dealt.hint("rebalance", F.col("t")).write.partitionBy("t").parquet(path)
    for k, target in enumerate(targets):
        extra = adopt_files(ctx, f"{path}/t={k}", plain.schema, target)
        if extra:
            found[target] = extra
    return found


def adopt_files(ctx: StepContext, folder: str, schema: T.StructType, target: str) -> list[str]:
    """Add the Parquet files of a folder to a catalog table without a job: they move into its folder.

    A table that is partitioned or bucketed, or whose columns have other types, takes the rows by
    an append. Returns the columns the table lacks; then it takes nothing.
    """
    spark = ctx.spark
    if not storage.folder_exists(spark, folder):  # all files of this table were empty or refused
        folder = None
    if not spark.catalog.tableExists(target):
        spark.sql("CREATE DATABASE IF NOT EXISTS IDENTIFIER(:d)", {"d": target.split(".")[0]})
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        spark.sql(f"CREATE TABLE IDENTIFIER(:t) ({columns}) USING parquet", {"t": target})
    have = {f.name: f.dataType for f in spark.table(target).schema}
    extra = [c for c in schema.names if c not in have]
    if extra or folder is None:
        return extra
    about = {r[0]: r[1] for r in spark.sql("DESCRIBE EXTENDED IDENTIFIER(:t)", {"t": target}).collect()}
    same = all(have[f.name] == f.dataType for f in schema)
    if about.get("Provider") != "parquet" or "# Partition Information" in about or "Num Buckets" in about or not same:
        return append_rows(ctx, spark.read.schema(schema).parquet(folder), target)
    storage.move_files(spark, folder, about["Location"])
    spark.catalog.refreshTable(target)
    return []


def _refuse_extra(results: DataFrame, extra: list[str], target: str) -> DataFrame:
    if not extra:
        return results
    message = f"columns not in {target}: {','.join(extra)}"
    return results.withColumns({"error": F.lit(message), "rows_inserted": F.lit(0).cast("long")})


@step("pandas_import")
def pandas_import(ctx: StepContext, files: DataFrame) -> DataFrame:
    """Delimited files, and workbooks by their first sheet."""
    books = [m.order for m in ctx.mappings if m.file_type.upper() in ("XLS", "XLSX")]
    flat = files.filter(~F.col("mapping").isin(books))
    sheets = files.filter(F.col("mapping").isin(books))
    parts = []
    if not flat.isEmpty():
        parts.append(_import(ctx, flat, "pandas", strict=False))
    if not sheets.isEmpty():
        parts.append(_import_sheets(ctx, sheets))
    return _union(parts) if parts else files


@step("client_copy")
def client_copy(ctx: StepContext, files: DataFrame) -> DataFrame:
    """A bad row keeps its whole file out; an empty text is missing, quoted or not."""
    return _import(ctx, files, "force_null", strict=True)


@step("pg_bulk_copy")
def pg_bulk_copy(ctx: StepContext, files: DataFrame) -> DataFrame:
    """As S4, but a quoted empty text stays a text."""
    return _import(ctx, files, "copy", strict=True)


def _import_sheets(ctx: StepContext, files: DataFrame) -> DataFrame:
    """Workbooks that share a table and a header row are one append."""
    cells, broken = workbooks.readable(durable(workbooks.read_cells(files.filter("ok")), "cells"))
    files = durable(_fail(files, broken), "sheets")
    first = cells.filter((F.col("sheet_no") == 0) & (F.col("row") == 0))
    heads = first.groupBy("path").agg(
        F.array_sort(F.collect_list(F.struct("col", "value"))).alias("head")
    ).select("path", F.col("head.value").alias("_head"))
    out = []
    for row, group in _by_mapping(ctx, files):
        named = target_names(row, group.filter("ok")).select("path", "id", "_table")
        kinds = durable(lookup_join(named, heads, ["path"]), "heads")
        results = []
        for table, head in _layouts(kinds):
            target = f"{row.schema_name}.{table}"
            members = kinds.filter(
                (F.col("_table") == table) & (F.col("_head") == F.array(*[F.lit(h) for h in head]))
            )
            mine = lookup_join(cells, members.select("path"), ["path"], "left_semi", stored=True)
            rows = durable(workbooks.sheet_rows(mine, [delimited.snake_name(h) for h in head]).drop("row"), "sheet")
            counts = lookup_join(
                members.select("path"), rows.groupBy("path").agg(F.count(F.lit(1)).alias("n")), ["path"], "left"
            )
            if _with_id(ctx, row, target):
                ids = members.select("path", F.col("id").alias("file_id"))
                rows = lookup_join(rows, ids, ["path"], stored=True)
            extra = append_rows(ctx, rows.drop("path"), target)
            done = counts.select(
                "path", F.coalesce("n", F.lit(0)).alias("rows_inserted"), F.lit(target).alias("database_table"),
                F.lit(None).cast("string").alias("error"),
            )
            results.append(_refuse_extra(done, extra, target))
        out.append(_finish(group, results))
    return durable(_union(out), "imported")


@step("wyman")
def data_pack(ctx: StepContext, files: DataFrame) -> DataFrame:
    """Every block of a data pack in long form."""
    out = []
    for row, group in _by_mapping(ctx, files):
        cells, broken = workbooks.readable(durable(workbooks.read_cells(group.filter("ok")), "cells"))
        long = workbooks.block_rows(cells, workbooks.toc_blocks(cells))
        tagged = durable(
            lookup_join(long, group.select("path", F.col("id").cast("string").alias("file_id")), ["path"]), "pack"
        )
        target = f"{row.schema_name}.{row.table_name}"
        append_rows(ctx, tagged.drop("path"), target)
        counts = tagged.groupBy("path").agg(F.count(F.lit(1)).alias("total_rows"))
        done = _set(group, counts, ["total_rows"]).withColumn("database_table", F.lit(target))
        out.append(_fail(done, broken))
    return _union(out)


def unchanged(ctx: StepContext, files: DataFrame) -> DataFrame:
    return files


STEPS |= dict.fromkeys(MARKERS, unchanged)


@step("upsert_table_from_stg")
def upsert_from_staging(ctx: StepContext, files: DataFrame) -> DataFrame:
    """M2, M4: what this pass staged goes to the table of the same name in the data schema: an
    upsert by the configured keys, else an append. Rows keep the id of their own file; of a key in
    several files the newest file counts, a key twice in one file fails that file. An upsert leaves
    a status row. Staging tables without a file id are taken whole, under the newest id."""
    spark, out = ctx.spark, []
    logs = Logs(spark, f"{ctx.work_dir}/logging")
    for row, group in _by_mapping(ctx, files):
        good = durable(target_names(row, group.filter("ok")).select("id", "_table"), "named")
        newest = {r["_table"]: r["i"] for r in good.groupBy("_table").agg(F.max("id").alias("i")).collect()}
        for table, last in newest.items():
            staged = spark.table(f"{row.schema_name}.{table}")
            if "file_id" in staged.columns:
                ids = good.filter(F.col("_table") == table).select(F.col("id").alias("file_id"))
                staged = staged.withColumn("file_id", F.col("file_id").cast("long"))
                staged = lookup_join(staged, ids, ["file_id"], "left_semi").select(*staged.columns)
            else:
                staged = staged.withColumn("file_id", F.lit(last).cast("long"))
            target = f"{row.target_schema or ctx.data_schema}.{table}"
            if not spark.catalog.tableExists(target):
                append_rows(ctx, staged.limit(0), target)
            if not row.keys:
                append_rows(ctx, staged.select(*spark.table(target).columns), target)
                continue
            repeated = staged.groupBy(*row.keys, "file_id").count().filter("count > 1")
            repeats = durable(repeated.select("file_id").distinct(), "repeats")
            group = group.join(repeats.withColumnRenamed("file_id", "id").withColumn("_twice", F.lit(True)), "id", "left")
            twice = F.coalesce("_twice", F.lit(False))
            group = fail_where(group, twice, "staging key is not unique").select(*files.columns)
            staged = lookup_join(staged, repeats, ["file_id"], "left_anti", stored=True)
            before = spark.table(target)
            merged = merge.merge_stored(before, staged, row.keys, dedupe_by="file_id")
            logs.add_status(durable(merge.load_status(before, merged, target, "upsert_table_from_stg"), "status"))
            replace_table(ctx, merged.drop("action"), target)
        out.append(group)
    return durable(_union(out), "merged")


def replace_table(ctx: StepContext, rows: DataFrame, target: str) -> None:
    """New content for a catalog table: written to a folder of its own, then the table is pointed
    there, so readers see the old rows or the new ones."""
    path = f"{ctx.work_dir}/tables/{target}/{uuid.uuid4().hex}"
    rows.write.parquet(path)
    ctx.spark.sql(f"ALTER TABLE {target} SET LOCATION '{path}'")
    ctx.spark.catalog.refreshTable(target)
