"""Workbooks as cells, sheets as rows, and data packs with a table of contents."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quayside.functions.names import snake_name
from quayside.operators import reshape
from quayside.operators.numbering import block_ranges
from quayside.operators.skew import lookup_join
from quayside.session import durable
from quayside.sources.archives import UNREADABLE
from quayside.sources.storage import spread, task_filesystem

BIN = 4096  # rows of a sheet that meet their blocks together
CELL_SCHEMA = "path string, sheet_no int, sheet string, row int, col int, value string, link string, error string"


# Fixed value: the rows of a sheet by the format.
SHEET_ROWS = 1_048_576
ROWS_AT_ONCE = 10_000
MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
RELATION = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


def cell_place(ref: str) -> tuple[int, int]:
    """Row and column, from 0, of a cell's name such as B7."""
    import re

    letters, digits = re.match(r"([A-Z]+)(\d+)", ref).groups()
    col = 0
    for letter in letters:
        col = col * 26 + ord(letter) - 64
    return int(digits) - 1, col - 1


def _parts(part, *wanted: str) -> Iterator:
    """The elements of a part with these names, one at a time; what was read is let go."""
    from xml.etree import ElementTree

    names = {f"{MAIN}{w}" for w in wanted}
    above = []
    for event, element in ElementTree.iterparse(part, ("start", "end")):
        if event == "start":
            above.append(element)
            continue
        above.pop()
        if element.tag in names:
            yield element
        if above and (element.tag in names or not any(e.tag in names for e in above)):
            above[-1].remove(element)


def _texts(element) -> str:
    return "".join(t.text or "" for t in element.iter(f"{MAIN}t"))


def workbook_cells(stream) -> Iterator[tuple]:
    """(sheet number, sheet, row, column, text, link target) of the cells that hold something;
    rows and columns count from 0.

    Sheets are read element by element, so memory follows the texts that cells share and the links
    of one sheet (at most 65 530 by format), not the cells.
    """
    import zipfile
    from xml.etree import ElementTree

    import pyarrow as pa

    with zipfile.ZipFile(stream) as book:
        shared = pa.chunked_array([], pa.large_string())
        if "xl/sharedStrings.xml" in set(book.namelist()):
            with book.open("xl/sharedStrings.xml") as part:
                chunks, held = [], []
                for item in _parts(part, "si"):
                    held.append(_texts(item))
                    if len(held) == ROWS_AT_ONCE:
                        chunks.append(pa.array(held, pa.large_string()))
                        held = []
                shared = pa.array([], pa.large_string()) if not chunks and not held else pa.concat_arrays(
                    [*chunks, pa.array(held, pa.large_string())])
        targets = {}
        with book.open("xl/_rels/workbook.xml.rels") as part:
            for r in ElementTree.parse(part).getroot():
                targets[r.get("Id")] = "xl/" + r.get("Target").removeprefix("/xl/").removeprefix("xl/")
        with book.open("xl/workbook.xml") as part:
            sheets = [(s.get("name"), targets[s.get(RELATION)])
                      for s in ElementTree.parse(part).getroot().iter(f"{MAIN}sheet")]
        for number, (sheet, part_name) in enumerate(sheets):
            with book.open(part_name) as part:  # links stand behind the cells they belong to
                links = {cell_place(h.get("ref").split(":")[0]): h.get("location") for h in _parts(part, "hyperlink")}
            with book.open(part_name) as part:
                for cell in _parts(part, "c"):
                    raw = cell.find(f"{MAIN}v")
                    if cell.get("t") == "s":
                        value = shared[int(raw.text)].as_py()
                    elif cell.get("t") == "inlineStr":
                        value = _texts(cell)
                    else:
                        value = None if raw is None else raw.text
                    if value is not None:
                        at = cell_place(cell.get("r"))
                        yield number, sheet, *at, value, links.get(at)


def read_cells(files: DataFrame, path: str = "path") -> DataFrame:
    """The cells of each workbook, every value a text. A workbook is read by one task as a
    stream and handed on in batches of bounded rows. Everything after this is DataFrame work on
    cells. A workbook that can't be read to its end has a row with an ``error`` and no sheet,
    whatever came before it; ``readable`` leaves such workbooks out."""
    def cells(batches: Iterator) -> Iterator:
        import itertools

        import pandas as pd

        columns = ["path", "sheet_no", "sheet", "row", "col", "value", "link", "error"]
        numbers = {"sheet_no": "Int32", "row": "Int32", "col": "Int32"}
        for batch in batches:
            for uri in batch[path]:
                try:
                    storage, name = task_filesystem(uri)
                    with storage.open_input_file(name) as stream:
                        rows = ((uri, *c, None) for c in workbook_cells(stream))
                        while part := list(itertools.islice(rows, ROWS_AT_ONCE)):
                            yield pd.DataFrame(part, columns=columns, dtype=object).astype(numbers)
                except (*UNREADABLE, SyntaxError, AttributeError, IndexError, TypeError, ValueError) as e:
                    broken = [(uri, *[None] * 6, f"{type(e).__name__}: {e}")]
                    yield pd.DataFrame(broken, columns=columns, dtype=object).astype(numbers)

    return spread(files, path).mapInPandas(cells, CELL_SCHEMA)


def readable(cells: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The cells of the workbooks that could be read whole, and (path, error) of the others."""
    broken = cells.filter("error is not null").select("path", "error")
    return lookup_join(cells.filter("error is null").drop("error"), broken.select("path"), ["path"], "left_anti"), broken


def sheet_size(cells: DataFrame, sheet_no: int = 0) -> DataFrame:
    """A3: data rows (without the header) and columns of a sheet of each workbook."""
    return cells.filter(F.col("sheet_no") == sheet_no).groupBy("path").agg(
        F.max("row").cast("long").alias("rows"), (F.max("col") + 1).cast("long").alias("columns")
    )


def sheet_header(cells: DataFrame, sheet_no: int = 0) -> list[str]:
    """Column names of one workbook's sheet: its first row, in snake case."""
    first = cells.filter((F.col("sheet_no") == sheet_no) & (F.col("row") == 0))
    return [snake_name(r["value"]) for r in first.orderBy("col").collect()]


def sheet_rows(cells: DataFrame, names: Sequence[str], sheet_no: int = 0) -> DataFrame:
    """The rows below the header as columns of texts, one aggregate per (workbook, row)."""
    body = cells.filter((F.col("sheet_no") == sheet_no) & (F.col("row") > 0))
    return body.groupBy("path", "row").agg(
        *[F.max(F.when(F.col("col") == i, F.col("value"))).alias(n) for i, n in enumerate(names)]
    )


def toc_blocks(cells: DataFrame) -> DataFrame:
    """The blocks named by the links of the first sheet. A cell without a link starts a
    category, which is the sheet the links below it point into. The window walks one sheet, whose
    size the format bounds."""
    walk = Window.partitionBy("path").orderBy("row", "col")
    toc = cells.filter(F.col("sheet_no") == 0).select(
        "path", "row", "col", "link",
        F.last(F.when(F.col("link").isNull(), F.col("value")), ignorenulls=True)
        .over(walk.rowsBetween(Window.unboundedPreceding, 0)).alias("sheet"),
    )
    start = F.regexp_extract("link", r"^(.+)!\$[A-Z]+\$(\d+)", 2).cast("int") - 1
    starts = toc.filter(F.col("link").isNotNull()).withColumn("start_row", start)
    return block_ranges(starts, "start_row", ["row", "col"], ["path", "sheet"])


def block_rows(cells: DataFrame, blocks: DataFrame, no_units: Sequence[str] = ("Snapshots",)) -> DataFrame:
    """The long form of every block of a data pack.

    The non-empty rows of a block are its header, its unit (not on the sheets ``no_units``), its
    columns, then data. The first filled cell of a data row is the dimension, the next ones follow
    the columns. Cells without a value are dropped. A cell takes the block that started last above
    it, so cells and blocks are never paired; a window walks one sheet, bounded by its format.
    """
    bin_ = F.floor(F.col("row") / BIN).cast("int")
    key = ["path", "sheet", "block"]
    last = F.coalesce("end_row", F.lit(SHEET_ROWS))
    ranges = blocks.select(*key, "start_row", last.alias("end_row")).filter(F.col("start_row") < F.col("end_row")).withColumn(
        "_bin", F.explode(F.sequence(*[F.floor(row / BIN).cast("int") for row in (F.col("start_row"), F.col("end_row") - 1)])))
    inside = cells.select("path", "sheet", "row", "col", "value", bin_.alias("_bin")).join(
        ranges, ["path", "sheet", "_bin"]
    ).filter((F.col("row") >= F.col("start_row")) & (F.col("row") < F.col("end_row")))
    lines = durable(inside.groupBy(*key, "row").agg(
        F.array_sort(F.collect_list(F.struct("col", "value"))).alias("cells")), "block-lines")
    columns_at = F.when(F.col("sheet").isin(*no_units), 1).otherwise(2)
    joined = F.array_join(F.col("cells.value"), ",")
    # Only the first three rows of a block are numbered; Spark limits the rows before it ranks them.
    top = lines.withColumn("line", F.row_number().over(Window.partitionBy(*key).orderBy("row")) - 1).filter("line < 3")
    heads = top.groupBy(*key).agg(
        F.max(F.when(F.col("line") == 0, joined)).alias("figure"),
        F.coalesce(F.max(F.when((F.col("line") == 1) & (columns_at == 2), joined)), F.lit("None")).alias("units"),
        F.max_by("cells.value", F.when(F.col("line") == columns_at, F.col("line"))).alias("measures"),
        F.max(F.when(F.col("line") == columns_at, F.col("row"))).alias("_columns_row"),
    ).filter("_columns_row is not null")
    data = lookup_join(lines, heads, key).filter(F.col("row") > F.col("_columns_row"))
    first = F.col("cells")[0]["col"]
    long = data.select(
        *key, "row", "figure", "units", "measures",
        F.col("cells")[0]["value"].alias("dimension"), first.alias("_first"),
        F.explode("cells").alias("cell"),
    ).filter((F.col("cell.col") > F.col("_first"))
             & (F.col("cell.col") - F.col("_first") <= F.size("measures")))
    plain = {c: F.replace(F.col(c), F.lit('"'), F.lit("")) for c in ("figure", "units", "dimension")}
    return long.select(
        "path", F.col("sheet").alias("sheetname"), *[v.alias(c) for c, v in plain.items()],
        F.replace(F.element_at("measures", F.col("cell.col") - F.col("_first")), F.lit('"'), F.lit("")).alias("measure"),
        F.replace(F.col("cell.value"), F.lit('"'), F.lit("")).alias("stat_value"),
    ).filter(F.col("stat_value") != reshape.NULL_TEXT)
