"""Queries that write the given tables as files of many kinds and take them in again."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import yaml
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions import paths
from quayside.plans.inputs import table
from quayside.plans.load_job import LoadJob
from quayside.plans.registry import query
from quayside.session import durable, scratch_path
from quayside.sources import delimited, html, listing, storage, tables, workbooks


def run_load(spark: SparkSession, config: list[dict], tables_: list[str], work: str) -> tuple[DataFrame, list[DataFrame]]:
    """The load job in a database of its own: its catalog, and copies of the tables it loaded."""
    schema = f"load_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {schema} LOCATION '{scratch_path(spark, 'database')}'")
    filled = yaml.safe_dump(config).replace("SCHEMA_HERE", schema)
    job = LoadJob.from_yaml(spark, filled, work)
    job.data_schema = schema
    catalog = durable(job.run(), "catalog")
    loaded = [durable(spark.table(f"{schema}.{t}"), "loaded") for t in tables_]
    spark.sql(f"DROP DATABASE {schema} CASCADE")
    return catalog, loaded


@query(
    "multiline_run",
    """SELECT doc_id, md5(text) AS digest, CAST(length(text) AS BIGINT) AS chars, lang FROM documents
WHERE text IS NOT NULL AND trim(text) <> ''""",
)
def multiline_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3, A2: all texts, with the newlines, quotes and delimiters they hold, as delimited files that
    the load job reads in splits; missing texts are left out, as a reader can't tell them apart."""
    folder = scratch_path(spark, "texts")
    docs = table(spark, sf_dir, "documents").filter("text IS NOT NULL AND trim(text) <> ''")
    tables.dump_csv(docs.select("doc_id", "text", "lang"), folder, header=True)
    config = [{
        "path": folder, "project_name": "texts",
        "mapping": [{
            "file_regex": r".*\.csv$", "file_type": "CSV", "schema_name": "SCHEMA_HERE", "table_name": "texts",
            "process_logic": [{"logic": "pandas_import"}],
        }],
    }]
    _, (loaded,) = run_load(spark, config, ["texts"], scratch_path(spark, "work"))
    return loaded.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.md5("text").alias("digest"),
        F.length("text").cast("long").alias("chars"), "lang")


@query(
    "multiline_counts",
    """SELECT CAST(count(*) AS BIGINT) AS n_rows, 3 AS n_columns FROM documents""",
)
def multiline_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2: rows of files whose fields hold newlines, counted in splits."""
    folder = scratch_path(spark, "texts")
    tables.dump_csv(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), folder, header=True)
    return delimited.count_rows(spark, folder).agg(
        F.sum("rows").alias("n_rows"), F.max("columns").alias("n_columns"))


ELEMENT_TAGS = ("div", "table", "li", "p")
# Tags of a page in order, and the depth after each; an element's end is the first later place whose
# depth is lower than its own.
ELEMENTS_SQL = " UNION ALL ".join(
    f"""SELECT * FROM (
  WITH bodies AS (
    SELECT page_id, regexp_replace(html, '(?is)<!--.*?-->|<script\\b.*?</script\\s*>|<style\\b.*?</style\\s*>', '', 'g') AS body FROM pages),
  cut AS (
    SELECT page_id, regexp_extract_all(body, '(?is)<{t}(?:[\\s/][^>]*)?>|</{t}\\s*>') AS tags,
           regexp_split_to_array(body, '(?is)<{t}(?:[\\s/][^>]*)?>|</{t}\\s*>') AS texts FROM bodies),
  marks AS (SELECT page_id, unnest(range(1, len(tags) + 1)) AS i, tags, texts FROM cut WHERE len(tags) > 0),
  deep AS (
    SELECT page_id, i, tags, texts, CASE WHEN starts_with(tags[i], '</') THEN -1 ELSE 1 END AS turn,
           sum(CASE WHEN starts_with(tags[i], '</') THEN -1 ELSE 1 END) OVER (PARTITION BY page_id ORDER BY i) AS depth
    FROM marks),
  ends AS (
    SELECT a.page_id, a.i, (SELECT min(b.i) FROM deep b WHERE b.page_id = a.page_id AND b.i > a.i
                            AND {'true' if t in html.IMPLIED_END else 'b.depth < a.depth'}) AS j, tags, texts
    FROM deep a WHERE turn = 1)
  SELECT page_id, '{t}' AS tag, CAST(row_number() OVER (PARTITION BY page_id ORDER BY i) - 1 AS INTEGER) AS pos,
         md5(texts[i + 1] || array_to_string(list_transform(range(i + 1, coalesce(j, len(tags) + 1)),
             lambda k: tags[k] || texts[k + 1]), '')) AS digest
  FROM ends)""" for t in ELEMENT_TAGS
)


@query("element_contents", ELEMENTS_SQL)
def element_contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The content of every element of some kinds, nested ones and ones without an end tag."""
    from functools import reduce

    pages = table(spark, sf_dir, "pages")
    return reduce(DataFrame.unionByName, [
        html.elements(pages, t).select("page_id", F.lit(t).alias("tag"), "pos", F.md5("content").alias("digest"))
        for t in ELEMENT_TAGS
    ])


# Folders and names of the files that pages are written to: plain, in hidden folders, hidden themselves.
PLACE_SQL = """CASE page_id % 4 WHEN 0 THEN 'site/' WHEN 1 THEN '.cache/old/' WHEN 2 THEN 'site/_parts/' ELSE '' END"""
NAME_SQL = """CASE page_id % 4 WHEN 0 THEN '_' WHEN 3 THEN '.' ELSE '' END"""


def write_texts(rows: DataFrame, folder: str) -> DataFrame:
    """Each row's ``text`` as a file of its ``place`` below the folder: fixtures of the queries here."""
    def write(batches: Iterator) -> Iterator:
        for batch in batches:
            for place, text in zip(batch["place"], batch["text"], strict=True):
                sink, name = storage.task_filesystem(f"{folder}/{place}")
                sink.create_dir(name.rsplit("/", 1)[0], recursive=True)
                with sink.open_output_stream(name, compression=None) as out:
                    out.write((text or "").encode())
            yield batch[["place"]]

    return durable(rows.select("place", "text").mapInPandas(write, "place string"), "written")


@query(
    "listing_run",
    f"""SELECT {PLACE_SQL} AS folder, {NAME_SQL} || CAST(page_id AS VARCHAR) || '.html' AS file_name,
       CAST(strlen(html) AS BIGINT) AS file_size, md5(html) AS crc FROM pages""",
)
def listing_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a file, in nested and hidden folders and under hidden names,
    listed round by round and checksummed."""
    folder = scratch_path(spark, "pages")
    pages = table(spark, sf_dir, "pages").select(
        F.concat(F.expr(PLACE_SQL), F.expr(NAME_SQL), F.col("page_id").cast("string"), F.lit(".html")).alias("place"),
        F.col("html").alias("text"))
    write_texts(pages, folder)
    found = durable(listing.list_files(spark, folder, r".*\.html$"), "found")
    root = storage.checked_folder(folder)
    inside = F.substring("file_path", F.lit(len(root) + 2), F.length("file_path"))
    return found.join(storage.file_md5(found).drop("error"), "path").select(
        F.when(inside == "", "").otherwise(F.concat(inside, F.lit("/"))).alias("folder"), "file_name", "file_size", "crc")


@query(
    "hidden_load",
    """SELECT CAST(page_id % 4 AS BIGINT) AS kind, count(*) AS n, CAST(sum(page_id) AS BIGINT) AS ids FROM pages GROUP BY page_id % 4""",
)
def hidden_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files in hidden folders and under hidden names go through the whole load job: counted,
    checksummed and loaded with their file id."""
    folder = scratch_path(spark, "hidden")
    kind = F.col("page_id") % 4
    body = table(spark, sf_dir, "pages").groupBy(kind.alias("kind"), F.floor(F.col("page_id") / 5000).alias("part")).agg(
        F.concat(F.lit("page_id,kind\n"), F.array_join(F.sort_array(F.collect_list(
            F.concat_ws(",", F.col("page_id").cast("string"), kind.cast("string")))), "\n")).alias("text"))
    place = F.concat(
        F.element_at(F.array(*[F.lit(p) for p in ("a/", ".h/b/", "c/_", ".")]), (F.col("kind") + 1).cast("int")),
        F.concat_ws("-", F.col("kind").cast("string"), F.col("part").cast("string")), F.lit(".csv"))
    write_texts(body.select(place.alias("place"), "text"), folder)
    config = [{
        "path": folder, "project_name": "hidden",
        "process_logic": [{"logic": s} for s in ("generate_checksum", "count_file_linux_wc", "abort_if_duplicate")],
        "mapping": [{
            "file_regex": r".*\.csv$", "file_type": "CSV", "schema_name": "SCHEMA_HERE", "table_name": "hidden",
            "append_file_id": True, "process_logic": [{"logic": "pandas_import"}],
        }],
    }]
    catalog, (loaded,) = run_load(spark, config, ["hidden"], scratch_path(spark, "work"))
    # total_rows counts the header line too; a file whose counts disagree has no rows here.
    whole = catalog.filter("rows_inserted = total_rows - 1 AND crc IS NOT NULL").select(F.col("id").alias("file_id"))
    return loaded.withColumn("file_id", F.col("file_id").cast("long")).join(whole, "file_id", "left_semi").groupBy(
        F.col("kind").cast("long").alias("kind")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("page_id").cast("long")).alias("ids"))


def write_workbook(out, sheets: dict[str, tuple[list[list], dict[str, str]]]) -> None:
    """A workbook of sheets, each with its rows (None is an empty cell) and links by cell: fixtures
    of the queries here. Texts of even rows are shared, those of odd rows stand in the cell."""
    import zipfile
    from xml.sax.saxutils import escape, quoteattr

    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rel = 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    shared: dict[str, int] = {}

    def letters(col: int) -> str:
        name = ""
        while col >= 0:
            name, col = chr(65 + col % 26) + name, col // 26 - 1
        return name

    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as book:
        for number, (rows, links) in enumerate(sheets.values(), 1):
            with book.open(f"xl/worksheets/sheet{number}.xml", "w") as part:
                part.write(f"<worksheet {main}><sheetData>".encode())
                for r, row in enumerate(rows, 1):
                    cells = []
                    for c, value in enumerate(row):
                        if value is None:
                            continue
                        ref = f"{letters(c)}{r}"
                        if not isinstance(value, str):
                            cells.append(f'<c r="{ref}"><v>{value}</v></c>')
                        elif r % 2:
                            cells.append(f'<c r="{ref}" t="inlineStr"><is><t>{escape(value)}</t></is></c>')
                        else:
                            at = shared.setdefault(value, len(shared))
                            cells.append(f'<c r="{ref}" t="s"><v>{at}</v></c>')
                    part.write(f'<row r="{r}">{"".join(cells)}</row>'.encode())
                part.write(b"</sheetData>")
                if links:
                    inner = "".join(f"<hyperlink ref={quoteattr(k)} location={quoteattr(v)}/>" for k, v in links.items())
                    part.write(f"<hyperlinks>{inner}</hyperlinks>".encode())
                part.write(b"</worksheet>")
        texts = "".join(f"<si><t>{escape(t)}</t></si>" for t in shared)
        book.writestr("xl/sharedStrings.xml", f"<sst {main}>{texts}</sst>")
        names = "".join(f"<sheet name={quoteattr(n)} sheetId=\"{k}\" r:id=\"rId{k}\"/>" for k, n in enumerate(sheets, 1))
        book.writestr("xl/workbook.xml", f"<workbook {main} {rel}><sheets>{names}</sheets></workbook>")
        rels = "".join(f'<Relationship Id="rId{k}" Target="worksheets/sheet{k}.xml"/>' for k in range(1, len(sheets) + 1))
        book.writestr("xl/_rels/workbook.xml.rels", f"<Relationships>{rels}</Relationships>")


BOOK_ROWS = 5000


def _books(spark: SparkSession, sf_dir: str, folder: str, build) -> DataFrame:
    """Customers as workbooks of at most BOOK_ROWS rows each, so there are more with more rows."""
    def pack(batch):
        import pandas as pd

        number = int(batch["book"].iloc[0])
        path = f"{folder}/{number}.xlsx"
        sink, name = storage.task_filesystem(path)
        sink.create_dir(name.rsplit("/", 1)[0], recursive=True)
        with sink.open_output_stream(name, compression=None) as out:
            write_workbook(out, build(batch.sort_values("c_custkey")))
        return pd.DataFrame({"path": [path], "book": [number]})

    customers = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_mktsegment", F.round(F.col("c_acctbal") * 100).cast("long").alias("cents"),
        F.col("c_nationkey").cast("long").alias("c_nationkey"), F.floor(F.col("c_custkey") / BOOK_ROWS).alias("book"))
    return durable(customers.groupBy("book").applyInPandas(pack, "path string, book long"), "books")


@query(
    "sheet_rows",
    """SELECT CAST(c_custkey // 5000 AS BIGINT) AS book, CAST(c_custkey AS VARCHAR) AS cust_key, c_name AS full_name,
       c_mktsegment AS market_segment, CAST(CAST(round(c_acctbal * 100) AS BIGINT) AS VARCHAR) AS cents FROM customer""",
)
def sheet_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customers as workbooks, their first sheets read back under the header's names."""
    def build(batch):
        rows = [["Cust Key", "FullName", "market-segment", "CENTS"]]
        rows += [list(r) for r in batch[["c_custkey", "c_name", "c_mktsegment", "cents"]].itertuples(index=False)]
        return {"Customers": ([[v if isinstance(v, str) else int(v) for v in r] for r in rows], {}), "Notes": ([["x"]], {})}

    books = _books(spark, sf_dir, scratch_path(spark, "sheets"), build)
    cells, _ = workbooks.readable(durable(workbooks.read_cells(books), "cells"))
    names = workbooks.sheet_header(cells.filter(F.col("path") == books.agg(F.min("path")).scalar()))
    found = workbooks.sheet_rows(cells, names).join(books, "path")
    return found.select("book", *names)


@query(
    "sheet_sizes",
    """SELECT CAST(c_custkey // 5000 AS BIGINT) AS book, count(*) AS n_rows, CAST(2 AS BIGINT) AS n_columns
FROM customer GROUP BY c_custkey // 5000""",
)
def sheet_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3: rows and columns of the first sheet of each workbook."""
    def build(batch):
        rows = [["key", "name"], *([int(k), n] for k, n in zip(batch["c_custkey"], batch["c_name"]))]
        return {"S": (rows, {})}

    books = _books(spark, sf_dir, scratch_path(spark, "sizes"), build)
    cells, _ = workbooks.readable(durable(workbooks.read_cells(books), "cells"))
    sizes = workbooks.sheet_size(cells).join(books, "path")
    return sizes.select("book", F.col("rows").alias("n_rows"), F.col("columns").alias("n_columns"))


@query(
    "pack_rows",
    """SELECT CAST(c_custkey // 5000 AS BIGINT) AS book, 'Accounts' AS sheetname, c_mktsegment || ' balances' AS figure,
       'cents' AS units, c_name AS dimension, m.measure,
       CASE m.measure WHEN 'balance' THEN CAST(CAST(round(c_acctbal * 100) AS BIGINT) AS VARCHAR)
            ELSE CAST(c_nationkey AS VARCHAR) END AS stat_value
FROM customer, (VALUES ('balance'), ('nation')) AS m(measure)
UNION ALL
SELECT CAST(c_custkey // 5000 AS BIGINT), 'Snapshots', c_mktsegment || ' rows', 'None', 'all', 'rows', CAST(count(*) AS VARCHAR)
FROM customer GROUP BY c_custkey // 5000, c_mktsegment""",
)
def pack_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customers as data packs: a contents sheet with links, a block per market
    segment on a sheet with units and on one without, all brought to the long form."""
    def build(batch):
        toc, links, accounts, snaps = [["Accounts"]], {}, [], []
        for segment, rows in batch.groupby("c_mktsegment"):
            toc.append([f"{segment} balances"])
            links[f"A{len(toc)}"] = f"Accounts!$B${len(accounts) + 1}"
            accounts += [[None, f"{segment} balances"], [None, "cents"], [None, None, "balance", "nation"]]
            accounts += [[None, r.c_name, int(r.cents), int(r.c_nationkey)] for r in rows.itertuples()]
            accounts += [[], []]
        toc.append(["Snapshots"])
        for segment, rows in batch.groupby("c_mktsegment"):
            toc.append([f"{segment} rows"])
            links[f"A{len(toc)}"] = f"Snapshots!$B${len(snaps) + 1}"
            snaps += [[None, f"{segment} rows"], [None, None, "rows"], [None, "all", len(rows)], [], []]
        return {"Contents": (toc, links), "Accounts": (accounts, {}), "Snapshots": (snaps, {})}

    books = _books(spark, sf_dir, scratch_path(spark, "packs"), build)
    cells, _ = workbooks.readable(durable(workbooks.read_cells(books), "cells"))
    long = workbooks.block_rows(cells, workbooks.toc_blocks(cells)).join(books, "path")
    return long.select("book", "sheetname", "figure", "units", "dimension", "measure", "stat_value")


@query(
    "first_lines",
    """SELECT CAST(page_id AS VARCHAR) || '.html' AS file_name, string_split(html, chr(10))[1] AS first_line
FROM pages WHERE html IS NOT NULL AND html <> ''""",
)
def first_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first line of every page's file."""
    folder = scratch_path(spark, "heads")
    pages = table(spark, sf_dir, "pages").filter("html IS NOT NULL AND html <> ''")
    write_texts(pages.select(F.concat(F.col("page_id").cast("string"), F.lit(".html")).alias("place"), F.col("html").alias("text")), folder)
    found = listing.first_lines(listing.list_files(spark, folder))
    return found.select(paths.base_name(F.col("path")).alias("file_name"), "first_line")
