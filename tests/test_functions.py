"""Column functions against their plain meaning."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quayside.functions import checksums, names, paths, render, text

SLOW = settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))


def one(spark, column, value, ddl="v string"):
    return spark.createDataFrame([(value,)], ddl).select(column(F.col("v"))).first()[0]


@pytest.mark.parametrize("raw, want", [
    (" test2", "_test2"), ("HTTPServer Name (x)", "http_server_name_x_"), ("LoanID", "loan_id"),
    ("a.b-c~d?e", "a_b_c_d_e"), ("x:  y", "x_y"), ("Total $", "total_"),
])
def test_snake_name(spark, raw, want):
    assert names.snake_name(raw) == want
    assert one(spark, names.snake_column, raw) == want


TEXT = st.text(alphabet="aB9 _-(.)$~?{}\\/:XyZ", max_size=12)


@SLOW
@given(st.lists(TEXT, min_size=1, max_size=20))
def test_snake_column_equals_driver_side(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = [r[0] for r in df.select(names.snake_column(F.col("v"))).collect()]
    assert got == [names.snake_name(v) for v in values]


@given(TEXT)
def test_snake_name_is_stable(value):
    once = names.snake_name(value)
    again = names.snake_name(once)
    # only a shrinking run of underscores may change in a second pass
    assert again.replace("_", "") == once.replace("_", "")


def test_snake_names_and_ddl():
    assert names.snake_names(["Loan ID", "a/b'c", "x   y"]) == ["loan_id", "a_b_c", "x_y"]
    sql = 'CREATE TABLE t ("LoanID" varchar(3) COLLATE "SQL_Latin1_General_CP1_CI_AS", b int) ,'
    assert names.snake_ddl(sql, ["LoanID"]) == 'create table t ("loan_id" varchar(3), b int),'
    assert names.column_list("a, b,\n c") == ["a", "b", "c"]
    assert names.column_list("None") is None


def test_row_crc_tells_nulls_apart(spark):
    df = spark.createDataFrame([("a", None), (None, "a"), ("a", ""), ("", "a")], "x string, y string")
    assert df.select(checksums.row_crc(["x", "y"])).distinct().count() == 4


@pytest.mark.parametrize("body, lines, newlines", [("", 0, 0), ("a", 1, 0), ("a\n", 1, 1), ("a\nb", 2, 1), ("\n\n", 2, 2)])
def test_line_counts(spark, body, lines, newlines):
    assert one(spark, text.line_count, body) == lines
    assert one(spark, lambda c: text.line_count(c, True), body) == newlines
    assert one(spark, lambda c: F.size(text.lines_of(c)), body) == lines


def test_requote(spark):
    assert one(spark, lambda c: text.requote(c, ",", "|"), '"a "x" b","c"') == '"a ""x"" b"|"c"'
    assert one(spark, text.requote, "plain,text") == "plain,text"


def test_quote_prefixes(spark):
    line = 'First Mortgage, Grade "B" or "C",12,13'
    assert one(spark, text.quote_prefixes, line) == '"First Mortgage, Grade ""B"" or ""C""",12,13'
    assert one(spark, text.quote_prefixes, "CRA, House America,1") == '"CRA, House America",1'
    assert one(spark, text.quote_prefixes, "x CRA, House America,1") == "x CRA, House America,1"


@pytest.mark.parametrize("line, n", [("a,b", 2), ('"a,b",c', 2), ("", 1), ('a,"b""c,d",', 3)])
def test_field_count(spark, line, n):
    assert one(spark, text.field_count, line) == n


def test_paths(spark):
    p = "/a/b/file.x.csv"
    assert one(spark, paths.directory, p) == "/a/b"
    assert one(spark, paths.base_name, p) == "file.x.csv"
    assert one(spark, lambda c: paths.extension(paths.base_name(c)), p) == "CSV"
    assert one(spark, lambda c: paths.extract(c, r"(\w+)\.x"), p) == "file"
    assert one(spark, lambda c: paths.extract(c, r"\d+"), p) is None
    assert paths.date_pattern("YYYY-MM-DD") == "yyyy-MM-dd"
    assert one(spark, lambda c: paths.file_date(c, r"\d{4}", "YYYY"), "x_2018_9.csv") == "2018-01-01"
    assert one(spark, lambda c: paths.file_date(c, r"\d{8}", "YYYYMMDD"), "x_20181399.csv") is None
    assert one(spark, lambda c: paths.file_date(c, r"\d{4}"), "x_2018.csv") == "2018"
    assert one(spark, lambda c: paths.table_from_name(c, r"^(\w+)_\d"), "LoanMonth_2018.csv") == "loan_month"


WORDS = st.text(alphabet="abc é", max_size=8)


@SLOW
@given(st.lists(WORDS, min_size=1, max_size=10), st.integers(0, 9))
def test_padding_is_pythons(spark, values, width):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = df.select(
        render.padded("v", width), render.padded("v", width, "l"), render.padded("v", width, "c", "*")
    ).collect()
    for v, r in zip(values, got, strict=True):
        assert tuple(r) == (v.rjust(width), v.ljust(width), v.center(width, "*"))


def test_rendered_rows(spark):
    df = spark.createDataFrame([(1, "a<b", None)], "i int, t string, n string")
    assert df.select(render.json_row(["i", "t", "n"])).first()[0] == '["1","a<b","None"]'
    assert df.select(render.html_row(["i", "t"])).first()[0] == "<tr><td>1</td><td>a&lt;b</td></tr>"
    assert df.select(render.markdown_row(["i", "n"])).first()[0] == "| 1 | None |"
    assert render.html_header(["a", "b"], [1]) == '<th>a</th><th data-sort="string">b</th>'
    assert render.markdown_header(["a", "b"]) == ["| a | b |", "|-------------- | -------------- | "]
    assert df.select(render.padded_row(["i", "t"], [2, 3])).first()[0] == "  1 a<b"
