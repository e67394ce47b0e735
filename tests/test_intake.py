"""Listings, elements and workbooks at sizes and in shapes that the queries do not have."""

import os
import random
import re
import resource
import time

import pytest
from pyspark.sql import functions as F

from quayside.plans import intake_queries
from quayside.plans.load_job import LoadJob
from quayside.sources import html, listing, storage, workbooks


def tree(root, names):
    for name in names:
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(f"a,b\n{name},1\n")


NAMES = ["a.csv", "_b.csv", ".c.csv", "x/d e+%20.csv", "x/_y/z/.e.csv", ".h/f.csv", "deep/1/2/3/4/5/g.csv", "x/note.txt"]


def test_listing_sees_what_a_walk_sees(spark, tmp_path):
    root = tmp_path / "r"
    tree(root, NAMES)
    (root / "empty" / "er").mkdir(parents=True)
    os.symlink(root, root / "x" / "loop")
    os.symlink(root / "a.csv", root / "x" / "link.csv")
    want = {os.path.join(d, f) for d, _, files in os.walk(root) for f in files}
    got = {r.path: r for r in listing.list_files(spark, f"file://{root}/").collect()}
    assert set(got) == want and len(want) == len(NAMES) + 1
    for path, r in got.items():
        assert (r.file_path, r.file_name, r.file_size) == (*os.path.split(path), os.path.getsize(path))
        assert abs(r.modified.timestamp() - os.path.getmtime(path)) < 2
    assert {r.file_name for r in listing.list_files(spark, str(root), r".*/[_.].*\.csv$").collect()} == {"_b.csv", ".c.csv", ".e.csv", "f.csv"}


def test_unreadable_folders_fail_the_listing(spark, tmp_path):
    with pytest.raises(OSError, match="cannot list"):
        listing.list_files(spark, str(tmp_path / "none"))
    with pytest.raises(ValueError, match="cannot read"):
        listing.list_files(spark, "nosuch://host/folder")
    assert listing.list_files(spark, str(tmp_path)).count() == 0


def test_many_files_of_a_folder_come_in_batches(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(listing, "ROWS_AT_ONCE", 7)
    tree(tmp_path, [f"{k}.csv" for k in range(40)])
    assert listing.list_files(spark, str(tmp_path)).count() == 40


def test_hidden_files_are_loaded(spark, tmp_path):
    tree(tmp_path / "in", [n for n in NAMES if n.endswith(".csv")])
    name = "hidden_files_db"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/db'")
    config = f"""
- path: {tmp_path}/in
  project_name: p
  process_logic: [{{logic: generate_checksum}}, {{logic: count_file_linux_wc}}]
  mapping:
    - {{file_regex: '.*csv$', file_type: CSV, schema_name: {name}, table_name: t, append_file_id: true,
       process_logic: [{{logic: pandas_import}}]}}
"""
    catalog = LoadJob.from_yaml(spark, config, str(tmp_path / "work")).run()
    files = {r.id: r for r in catalog.collect()}
    assert len(files) == len(NAMES) - 1
    assert {(r.file_process_state, r.total_rows, r.rows_inserted) for r in files.values()} == {("Processed", 2, 1)}
    loaded = {r.a: int(r.file_id) for r in spark.table(f"{name}.t").collect()}
    assert set(loaded) == {n for n in NAMES if n.endswith(".csv")}
    assert all(files[i].file_name == os.path.basename(n) for n, i in loaded.items())
    assert {os.path.basename(r[0]) for r in spark.createDataFrame([("/x/_a",), ("/x/a_",), ("/_x/a",)], "p string").filter(
        storage.hidden(F.col("p"))).collect()} == {"_a"}
    spark.sql(f"DROP DATABASE {name} CASCADE")


# ---- elements


def by_stack(page, tag):
    """Contents by a stack over the tags; stray end tags are passed over."""
    marks = list(re.finditer(rf"(?is)<{tag}(?=[\s/>])[^>]*>|</{tag}\s*>", page))
    out, open_ = {}, []
    for m in marks:
        if m[0].startswith("</"):
            if open_:
                at, start = open_.pop()
                out[at] = page[start:m.start()]
        else:
            open_.append((m.start(), m.end()))
    for at, start in open_:
        out[at] = page[start:]
    return [out[k] for k in sorted(out)]


def test_nested_elements_match_a_stack(spark):
    rng = random.Random(4)
    bits = ["<div>", "<DIV class='x'>", "</div>", "</div >", "<div/>", "t", "é<b>", "<divx>", "", "\n"]
    pages = [(k, "".join(rng.choice(bits) for _ in range(rng.randint(0, 40)))) for k in range(80)]
    pages += [(None, "<div>a</div>"), (5, pages[5][1]), (200, None)]
    frame = spark.createDataFrame(pages, "page_id long, html string").withColumn("_page", F.lit(1)).repartition(3)
    got = sorted((r.page_id if r.page_id is not None else -1, r.pos, r.content) for r in html.elements(frame, "div").collect())
    want = sorted((k if k is not None else -1, pos, c) for k, page in pages for pos, c in enumerate(by_stack(page or "", "div")))
    assert got == want and len(want) > 300


def test_time_follows_the_number_of_elements(spark):
    def seconds(n):
        frame = spark.createDataFrame([(1, "<table><tr>x</tr></table>" * n)], "page_id long, html string")
        start = time.perf_counter()
        assert html.elements(frame, "table").filter("content = '<tr>x</tr>'").count() == n
        return time.perf_counter() - start

    seconds(100)
    small, large = min(seconds(4000) for _ in range(2)), seconds(32_000)
    assert large < 8 * small + 2  # a square would be 64 times


# ---- workbooks


def book(path, rows):
    with open(path, "wb") as out:
        intake_queries.write_workbook(out, {"S": (rows, {}), "T": ([["only"]], {"A1": "S!$A$1"})})


def test_cells_come_as_a_stream(tmp_path):
    def lines(n):
        yield ["key", "text", None, "number"]
        for k in range(n):
            yield [k, f"text {k % 50}", None, k * 0.5]

    path = str(tmp_path / "large.xlsx")
    book(path, lines(120_000))
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    with open(path, "rb") as stream:
        count, last = 0, None
        for cell in workbooks.workbook_cells(stream):
            count, last = count + 1, cell
    grown = (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) / 1024
    assert count == 3 + 3 * 120_000 + 1 and last == (1, "T", 0, 0, "only", "S!$A$1")
    assert grown < 60  # MB; the sheet's tree would take several hundred


def test_a_workbook_that_breaks_off_has_no_cells(spark, tmp_path):
    good, bad = str(tmp_path / "good.xlsx"), str(tmp_path / "bad.xlsx")
    book(good, [["a"], [1], ["two"]])
    book(bad, [["a"], *[[k] for k in range(30_000)]])
    import zipfile

    with zipfile.ZipFile(bad) as z:
        parts = {n: z.read(n) for n in z.namelist()}
    parts["xl/worksheets/sheet1.xml"] = parts["xl/worksheets/sheet1.xml"][:-500]
    with zipfile.ZipFile(bad, "w") as z:
        for n, body in parts.items():
            z.writestr(n, body)
    (tmp_path / "none.xlsx").write_bytes(b"no workbook")
    cells, broken = workbooks.readable(workbooks.read_cells(listing.list_files(spark, str(tmp_path))).cache())
    assert {os.path.basename(r.path) for r in broken.collect()} == {"bad.xlsx", "none.xlsx"}
    assert sorted((r.row, r.value) for r in cells.filter("sheet_no = 0").collect()) == [(0, "a"), (1, "1"), (2, "two")]


def test_blocks_over_many_bins(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(workbooks, "BIN", 8)
    rows, toc, links = [], [["Loans"]], {}
    for b in range(12):
        toc.append([f"block {b}"])
        links[f"A{len(toc)}"] = f"Loans!$B${len(rows) + 1}"
        rows += [[None, f"figure {b}"], [None, "unit"], [None, None, "m"], *[[None, f"d{k}", k] for k in range(b * 3)], [], []]
    with open(tmp_path / "p.xlsx", "wb") as out:
        intake_queries.write_workbook(out, {"C": (toc, links), "Loans": (rows, {})})
    cells = workbooks.read_cells(listing.list_files(spark, str(tmp_path))).drop("error").cache()
    long = workbooks.block_rows(cells, workbooks.toc_blocks(cells)).collect()
    got = {(r.figure, r.units, r.dimension, r.measure, r.stat_value) for r in long}
    assert got == {(f"figure {b}", "unit", f"d{k}", "m", str(k)) for b in range(12) for k in range(b * 3)}
    assert len(long) == len(got)


def test_text_before_the_first_block_is_left_out(spark):
    cells = spark.createDataFrame(
        [("p", 1, "S", 0, 0, "title", None), ("p", 1, "S", 5, 1, "fig", None)],
        "path string, sheet_no int, sheet string, row int, col int, value string, link string")
    blocks = spark.createDataFrame([("p", "S", 1, 5, None)], "path string, sheet string, block int, start_row int, end_row int")
    assert workbooks.block_rows(cells, blocks).count() == 0


# ---- many tables in one pass


def run_tables(spark, tmp_path, count, name):
    root = tmp_path / f"in{count}"
    root.mkdir()
    for k in range(count):
        (root / f"tab{chr(97 + k)}_2020.csv").write_text("a,b\n" + "".join(f"{k},{j}\n" for j in range(k + 1)))
    (root / "tabz_2020.csv").write_text("a,b\n1,2,3\n")
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/{name}'")
    spark.sql(f"CREATE TABLE {name}.taba (b string, a int, extra string) USING parquet")  # taken by a cast
    spark.sql(f"CREATE TABLE {name}.tabb (a string) USING parquet")  # lacks a column
    spark.sql(f"CREATE TABLE {name}.tabc (b string, a string, file_id long) USING parquet")
    spark.sql(f"INSERT INTO {name}.tabc VALUES ('old', 'old', 0)")
    config = f"""
- path: {root}
  project_name: p
  mapping:
    - {{file_regex: '.*csv$', file_type: CSV, schema_name: {name}, table_name_extract: '(tab[a-z])_.*', append_file_id: false,
       process_logic: [{{logic: pandas_import}}]}}
"""
    tracker = spark.sparkContext.statusTracker()
    group = f"tables-{count}"
    spark.sparkContext.setJobGroup(group, group)
    catalog = LoadJob.from_yaml(spark, config, str(tmp_path / f"work{count}")).run()
    files = {r.file_name[:4]: r for r in catalog.collect()}
    jobs = len(tracker.getJobIdsForGroup(group))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return files, jobs


def test_jobs_do_not_follow_the_tables(spark, tmp_path, rows):
    few, jobs_few = run_tables(spark, tmp_path, 4, "many_a")
    more, jobs_more = run_tables(spark, tmp_path, 14, "many_b")
    for files, name, count in ((few, "many_a", 4), (more, "many_b", 14)):
        for k in range(count):
            table = f"tab{chr(97 + k)}"
            if table == "tabb":
                assert files[table].file_process_state == "FAILED" and "columns not in" in files[table].last_error_msg
                assert spark.table(f"{name}.tabb").isEmpty()
                continue
            assert files[table].file_process_state == "Processed" and files[table].rows_inserted == k + 1
            want = sorted((str(k), str(j)) for j in range(k + 1)) + ([("old", "old")] if k == 2 else [])
            assert rows(spark.table(f"{name}.{table}").selectExpr("cast(a as string) a", "b")) == sorted(want)
        assert files["tabz"].file_process_state == "FAILED" and spark.table(f"{name}.tabz").isEmpty()
        assert files["tabd"].database_table == f"{name}.tabd"
    assert jobs_more <= jobs_few + 4
    for name in ("many_a", "many_b"):
        spark.sql(f"DROP DATABASE {name} CASCADE")
