"""Readers and writers on files written here."""

import gzip
import hashlib
import io
import tarfile
import zipfile

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from quayside.plans import dictionary
from quayside.sources import archives, delimited, html, lines, listing, storage, tables, workbooks


def write(folder, files):
    folder.mkdir(parents=True, exist_ok=True)
    for name, content in files.items():
        path = folder / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(content if isinstance(content, bytes) else content.encode())
    return str(folder)


def test_listing_matches_from_the_start_in_this_case(spark, tmp_path, rows):
    root = write(tmp_path / "d", {"a.csv": "1", "sub/deep dir/b%20+.csv": "22", "C.CSV": "3", "x.txt": "4"})
    found = listing.list_files(spark, root, r".*\.csv$")
    assert rows(found, "file_name", "file_size") == [("a.csv", 1), ("b%20+.csv", 2)]
    assert rows(listing.list_files(spark, root, "a.csv"), "file_name") == []
    plan = found.select("path", "file_size")._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[-1]


def test_metadata_path_is_the_listed_path(spark, tmp_path):
    root = write(tmp_path / "d", {"sub dir/b%20+é.csv": "h\nx\n", "plain.csv": "h\n1\n"})
    listed = {r.path for r in listing.list_files(spark, root).collect()}
    read = {r.path for r in lines.read_lines(spark, root).collect()}
    assert listed == read


def test_file_md5_streams_whole_files(spark, tmp_path):
    big = b"0123456789abcdef" * (1 << 20)
    packed = gzip.compress(b"hello")
    root = write(tmp_path / "d", {"big.bin": big, "small.gz": packed})
    got = {r.path.rsplit("/", 1)[1]: r.crc for r in storage.file_md5(listing.list_files(spark, root)).collect()}
    assert got == {"big.bin": hashlib.md5(big).hexdigest(), "small.gz": hashlib.md5(packed).hexdigest()}


NULLS = 'a,b\n"",x\n,NA\nNULL,007\n'


@pytest.mark.parametrize("rule, want", [
    ("pandas", [(None, "x"), (None, None), (None, "007")]),
    ("copy", [("", "x"), (None, "NA"), ("NULL", "007")]),
    ("force_null", [(None, "x"), (None, "NA"), ("NULL", "007")]),
])
@pytest.mark.parametrize("limit", [None, 50])
def test_null_rules(spark, tmp_path, rule, want, limit):
    root = write(tmp_path / "d", {"n.csv": NULLS})
    file = root if limit is None else root + "/n.csv"
    df = delimited.read_delimited(spark, file, ["a", "b"], nulls=rule, limit_rows=limit)
    assert [tuple(r)[1:] for r in df.collect()] == want


def test_delimiters_quotes_encoding_crlf(spark, tmp_path):
    body = 'a|b\r\n"x|y"|caf\xe9\r\n"he said ""no"""|2'
    root = write(tmp_path / "d", {"e.csv": body.encode("iso-8859-1")})
    df = delimited.read_delimited(spark, root, ["a", "b"], delimiter="|", encoding="ISO-8859-1")
    assert [tuple(r)[1:] for r in df.collect()] == [("x|y", "café"), ('he said "no"', "2")]
    assert delimited.header_names(spark, root + "/e.csv", "|") == ["a", "b"]


def test_header_is_kept_when_there_is_none(spark, tmp_path):
    root = write(tmp_path / "d", {"h.csv": "1,2\n3,4\n"})
    df = delimited.read_delimited(spark, root, ["a", "b"], has_header=False)
    assert [tuple(r)[1:] for r in df.collect()] == [("1", "2"), ("3", "4")]


def test_titles_and_row_limit(spark, tmp_path):
    body = "".join(f"title {i}\n" for i in range(5)) + "a,b\n" + "".join(f"{i},x\n" for i in range(20))
    root = write(tmp_path / "d", {"1.csv": body, "2.csv": body})
    files = [f"{root}/1.csv", f"{root}/2.csv"]
    for limit in (7, None):
        df = delimited.read_delimited(spark, files, ["a", "b"], header_row=5, limit_rows=limit)
        per_file = {}
        for r in df.collect():
            per_file.setdefault(r.path, []).append(r.a)
        assert all(sorted(v, key=int) == [str(i) for i in range(limit or 20)] for v in per_file.values())
        assert len(per_file) == 2


def test_strict_read_fails_on_ragged_row(spark, tmp_path):
    root = write(tmp_path / "d", {"r.csv": "a,b\n1,2\n1,2,3\n"})
    with pytest.raises(Exception, match="(?i)malformed"):
        delimited.read_delimited(spark, root, ["a", "b"], strict=True).collect()
    flagged = delimited.read_delimited(spark, root, ["a", "b"], flag_bad=True).collect()
    assert sorted(r._bad or "" for r in flagged) == ["", "1,2,3"]


def test_second_column_list():
    assert delimited.choose_columns(2, ["a", "b"], None) == ["a", "b"]
    assert delimited.choose_columns(3, ["a", "b"], ["a", "b", "c"]) == ["a", "b", "c"]
    with pytest.raises(ValueError):
        delimited.choose_columns(3, ["a", "b"], None)


def test_count_rows_with_quoted_newline(spark, tmp_path, rows):
    root = write(tmp_path / "d", {"q.csv": 'a,b\n"x\ny",1\nz,2\n'})
    assert rows(delimited.count_rows(spark, root), "rows", "columns") == [(2, 2)]


def test_line_numbers_over_many_splits(spark, tmp_path):
    body = "".join(f"line {i}\n" for i in range(100))
    root = write(tmp_path / "d", {"a.txt": body, "b.txt": body[:-1]})
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    try:
        for limit in (10**6, 0):
            old = lines.fits_broadcast
            lines.fits_broadcast = lambda df, n=limit: n > 0
            try:
                numbered = lines.number_lines(lines.read_lines(spark, root)).collect()
            finally:
                lines.fits_broadcast = old
            assert len(numbered) == 200
            assert all(r.line == f"line {r.line_no}" for r in numbered)
        counts = {r.path: r.lines for r in lines.lines_per_file(lines.read_lines(spark, root)).collect()}
        assert set(counts.values()) == {100}
        firsts = {r.first_line for r in listing.first_lines(listing.list_files(spark, root)).collect()}
        assert firsts == {"line 0"}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_line_endings_and_quoted_header(spark, tmp_path):
    root = write(tmp_path / "d", {"w.csv": '"a","b"\r\n1,2\r\n', "u.csv": "a,b\n1,2\n"})
    got = {r.path.rsplit("/", 1)[1]: (r.windows, r.quoted_header)
           for r in lines.line_endings(storage.head_lines(listing.list_files(spark, root), 1, keep_cr=True)).collect()}
    assert got == {"w.csv": (True, True), "u.csv": (False, False)}


def test_median_column_count_on_a_sample(spark, tmp_path):
    root = write(tmp_path / "d", {"m.csv": "a,b,c\n" + "1,2,3\n" * 3 + "1,2\n" * 9})
    sample = storage.head_lines(listing.list_files(spark, root), 6)
    assert sample.count() == 6
    assert lines.column_counts(sample, sample_size=5).first().column_count == 3
    numbered = lines.number_lines(lines.read_lines(spark, root))
    assert lines.column_counts(numbered, sample_size=None).first().column_count == 2


def test_header_columns():
    assert lines.header_columns(["file_id", "a", "b", "c"], 2, True, True) == ["file_id", "crc", "a", "b"]
    with pytest.raises(ValueError):
        lines.header_columns(["a"], 2, False, False)


def test_rewrite_lines(spark, tmp_path):
    root = write(tmp_path / "d", {"f.csv": "1,2\n"})
    numbered = lines.number_lines(lines.read_lines(spark, root))
    catalog = listing.list_files(spark, root).select("path", F.lit(42).alias("file_id"))
    got = lines.rewrite_lines(numbered, catalog, append_crc=True).first().line
    assert got == f'"42",{hashlib.md5(b"1,2").hexdigest()},1,2'


def archive_bytes():
    z = io.BytesIO()
    with zipfile.ZipFile(z, "w") as f:
        f.writestr("a.csv", "x,y\n1,2\n")
        f.writestr("deep/b.csv", "x,y,z\n")
        f.writestr("../../escape.csv", "e\n")
    t = io.BytesIO()
    with tarfile.open(fileobj=t, mode="w") as f:
        info = tarfile.TarInfo("c.csv")
        info.size = 4
        f.addfile(info, io.BytesIO(b"q\n1\n"))
    return {"z.zip": z.getvalue(), "t.tar": t.getvalue(), "t.tar.gz": gzip.compress(t.getvalue()),
            "one.csv.gz": gzip.compress(b"k\n")}


def test_archives(spark, tmp_path, rows):
    root = write(tmp_path / "in", archive_bytes())
    files = listing.list_files(spark, root).withColumn("crc", F.lit("k"))
    out = tmp_path / "out"
    members = archives.expand_archives(files, str(out))
    got = rows(members.select(F.regexp_extract("parent_path", "([^/]*)$", 1).alias("p"), "member", "file_size"))
    assert got == [("one.csv.gz", "one.csv", 2), ("t.tar", "c.csv", 4), ("t.tar.gz", "c.csv", 4),
                   ("z.zip", "../../escape.csv", 2), ("z.zip", "a.csv", 8), ("z.zip", "deep/b.csv", 6)]
    for r in members.collect():
        assert r.path.startswith(str(out))
        assert "part" not in r.path
    assert (out / "z.zip/k/a.csv").read_text() == "x,y\n1,2\n"
    assert (out / "z.zip/k/escape.csv").exists()
    (out / "z.zip/k/a.csv").write_text("kept")
    archives.expand_archives(files, str(out), skip_existing=True)
    assert (out / "z.zip/k/a.csv").read_text() == "kept"
    profiled = archives.profile_members(files, r".*\.csv", min_bytes=1)
    assert ("z.zip", "deep/b.csv", 3) in rows(
        profiled.select(F.regexp_extract("parent_path", "([^/]*)$", 1), "member", "columns"))
    assert archives.profile_members(files, r".*", min_bytes=10**9).isEmpty()


def workbook(sheets):
    """xlsx bytes from {name: ({ref: text}, {ref: link location})}; A3 style references."""
    out = io.BytesIO()
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    shared, table = [], {}
    with zipfile.ZipFile(out, "w") as z:
        entries, rels = [], []
        for i, (name, (cells, links)) in enumerate(sheets.items(), 1):
            rows = {}
            for ref, value in cells.items():
                rows.setdefault(int("".join(c for c in ref if c.isdigit())), []).append((ref, value))
            body = ""
            for r in sorted(rows):
                body += f'<row r="{r}">'
                for ref, value in rows[r]:
                    if isinstance(value, str):
                        if value not in table:
                            table[value] = len(shared)
                            shared.append(value)
                        body += f'<c r="{ref}" t="s"><v>{table[value]}</v></c>'
                    else:
                        body += f'<c r="{ref}"><v>{value}</v></c>'
                body += "</row>"
            hyper = "".join(f'<hyperlink ref="{r}" location="{loc}"/>' for r, loc in links.items())
            hyper = f"<hyperlinks>{hyper}</hyperlinks>" if hyper else ""
            z.writestr(f"xl/worksheets/sheet{i}.xml", f"<worksheet {main}><sheetData>{body}</sheetData>{hyper}</worksheet>")
            entries.append(f'<sheet name="{name}" sheetId="{i}" r:id="rId{i}"/>')
            rels.append(f'<Relationship Id="rId{i}" Target="worksheets/sheet{i}.xml"/>')
        z.writestr("xl/workbook.xml", f'<workbook {main} xmlns:r="{rel}"><sheets>{"".join(entries)}</sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", f"<Relationships>{''.join(rels)}</Relationships>")
        z.writestr("xl/sharedStrings.xml", f"<sst {main}>{''.join(f'<si><t>{s}</t></si>' for s in shared)}</sst>")
    return out.getvalue()


def test_sheet_rows(spark, tmp_path):
    root = write(tmp_path / "w", {"b.xlsx": workbook({"S": ({"A1": "Loan ID", "B1": "Rate", "A2": "007", "B2": 1.5, "A3": "x"}, {})})})
    cells = workbooks.read_cells(listing.list_files(spark, root))
    assert workbooks.sheet_header(cells) == ["loan_id", "rate"]
    got = sorted((r.loan_id, r.rate) for r in workbooks.sheet_rows(cells, ["loan_id", "rate"]).collect())
    assert got == [("007", "1.5"), ("x", None)]
    size = workbooks.sheet_size(cells).first()
    assert (size.rows, size.columns) == (2, 2)


def test_data_pack(spark, tmp_path):
    toc = ({"A1": "Loans", "A2": "one", "A3": "two", "A4": "Snapshots", "A5": "three"},
           {"A2": "Loans!$B$2", "A3": "Loans!$B$9", "A5": "Snapshots!$B$1"})
    loans = ({
        "B2": "Figure 1", "B3": "USD", "C4": "2018", "D4": "2019",
        "B5": "north", "C5": 1, "D5": 2, "B6": "south", "D6": 4, "B7": "west", "C7": "NULL",
        "B9": "Figure 2", "B10": "pct", "C11": "rate", "B12": "all", "C12": 0.5,
    }, {})
    snaps = ({"B1": "Snap", "C2": "m", "B3": "now", "C3": 7}, {})
    root = write(tmp_path / "w", {"p.xlsx": workbook({"Contents": toc, "Loans": loans, "Snapshots": snaps})})
    cells = workbooks.read_cells(listing.list_files(spark, root)).cache()
    blocks = workbooks.toc_blocks(cells)
    got = sorted((r.sheet, r.start_row, r.end_row) for r in blocks.collect())
    assert got == [("Loans", 1, 7), ("Loans", 8, None), ("Snapshots", 0, None)]
    long = sorted(tuple(r)[1:] for r in workbooks.block_rows(cells, blocks).collect())
    assert long == [
        ("Loans", "Figure 1", "USD", "north", "2018", "1"),
        ("Loans", "Figure 1", "USD", "north", "2019", "2"),
        ("Loans", "Figure 1", "USD", "south", "2019", "4"),
        ("Loans", "Figure 2", "pct", "all", "rate", "0.5"),
        ("Snapshots", "Snap", "None", "now", "m", "7"),
    ]


PAGE = """<html><!-- <a href="/no">no</a> --><script>var x='<a href="/js">j</a>'</script>
<a class="k" href="/one">historical 1</a><A HREF="/two"><b>other</b></A>
<table><tr><td>1</td></tr><tr><td>2</td></tr></table></html>"""


def test_html(spark, rows):
    pages = spark.createDataFrame([(1, PAGE)], "page_id long, html string")
    found = html.links(pages)
    assert rows(found, "pos", "href", "text") == [(0, "/one", "historical 1"), (1, "/two", "<b>other</b>")]
    assert html.elements(pages, "tr").count() == 2 and html.elements(pages, "table").count() == 1
    known = spark.createDataFrame([("/two",)], "href string")
    assert rows(html.new_links(found, known, "historical"), "href") == [("/one",)]


def test_versioned_table(spark, tmp_path, rows):
    t = tables.VersionedTable(spark, str(tmp_path / "t"), spark.range(0).schema)
    assert not t.exists() and t.read().isEmpty()
    t.replace(spark.range(3))
    t.append(spark.range(3, 5))
    assert rows(t.read()) == [(i,) for i in range(5)]
    t.replace(t.read().filter("id > 3"))      # reads the version it replaces
    assert rows(t.read()) == [(4,)]
    with pytest.raises(PySparkException):
        t.replace(spark.range(2).select(F.raise_error(F.lit("x")).cast("long").alias("id")))
    assert rows(t.read()) == [(4,)]           # a failed write leaves the table as it was


def test_upsert_touches_only_its_partitions(spark, tmp_path, rows):
    path = str(tmp_path / "p")
    old = spark.createDataFrame([(1, "a", 1, "x"), (2, "b", 1, "y"), (3, "c", 1, "z")], "k long, v string, file_id long, d string")
    old.write.partitionBy("d").parquet(path)
    before = {p.name for p in (tmp_path / "p" / "d=z").iterdir()}
    staged = spark.createDataFrame([(1, "a2", 2, "x"), (2, "b", 2, "x"), (9, "n", 2, "new")], old.schema)
    tables.upsert_partitions(spark, path, old.schema, staged, ["k"], "d")
    got = rows(spark.read.schema(old.schema).parquet(path))
    assert got == [(1, "a2", 2, "x"), (2, "b", 2, "x"), (3, "c", 1, "z"), (9, "n", 2, "new")]
    assert {p.name for p in (tmp_path / "p" / "d=z").iterdir()} == before


def test_dumps(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "q"', [1, 2])], "i int, t string, xs array<int>")
    tables.dump_named(df, str(tmp_path / "x"), "First,Second,Third")
    lines_ = {x for p in (tmp_path / "x").glob("part*") for x in p.read_text().splitlines()}
    assert lines_ == {"First,Second,Third", '1,"a ""q""","[1,2]"'}
    out = tables.export_tables({"one": df, "two": df}, str(tmp_path / "exp"))
    assert {r.file_name for r in out.collect()} == {"one.csv", "two.csv"}
    assert tables.read_query(spark, "select 1 as x").first().x == 1


def test_dictionary(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS dict")
    spark.sql("CREATE TABLE IF NOT EXISTS dict.t (LoanID int, name string, amt decimal(12,4)) USING parquet")
    spark.sql("INSERT INTO dict.t VALUES (1, 'abc', 1.5)")
    got = {r.column_name: (r.type, r.data_type, r.length, r.ordinal_position)
           for r in dictionary.catalog_dictionary(spark, "dict", scan=True).collect()}
    assert got == {"LoanID": ("Table", "integer", 0, 1), "name": ("Table", "character varying", 3, 2),
                   "amt": ("Table", "numeric(12,4)", 0, 3)}
    text = dictionary.table_ddl(spark, "dict.t")
    assert "loan_id int" in text and "create table" in text
    made = dictionary.ddl(dictionary.catalog_dictionary(spark, "dict", scan=True), "new").first()
    assert made.create_sql == "create table new.t (LoanID integer, name varchar(3), amt numeric(12,4));"
    tables.create_like(spark, "dict.copy", spark.table("dict.t"), "LoanID", 2, replace=True)
    assert spark.table("dict.copy").isEmpty()
    assert "NUM BUCKETS" in spark.sql("DESCRIBE EXTENDED dict.copy")._jdf.showString(50, 0, False).upper()
