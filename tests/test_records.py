"""Quoted newlines in split files against a whole read, and against the parser of the standard library."""

import csv
import io
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quayside.sources import delimited, lines, records


@pytest.fixture
def tiny_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


CELLS = ["", "a", "é, b", 'say ""x""', "two\nlines", "\n", "a\r\nb", 'quote"inside', "  ", ",,", "x" * 70, "p\n\nq\n", '"', '""\n""']


def body(seed, newline, rows=40):
    rng = random.Random(seed)
    out = io.StringIO()
    writer = csv.writer(out, lineterminator=newline, quoting=rng.choice([csv.QUOTE_MINIMAL, csv.QUOTE_ALL]))
    writer.writerow(["a", "b", "c"])
    for k in range(rows):
        writer.writerow([k, rng.choice(CELLS), rng.choice(CELLS)])
        if rng.random() < 0.1:
            out.write(newline)  # a blank line is no record
    text = out.getvalue()
    return text if rng.random() < 0.7 else text.removesuffix(newline)


def parsed(text):
    return [r for r in csv.reader(io.StringIO(text, newline="")) if r][1:]


@pytest.mark.parametrize("newline", ["\n", "\r\n"])
def test_records_cross_any_split(spark, tmp_path, tiny_splits, newline, monkeypatch):
    want = {}
    for k in range(6):
        text = body(k, newline)
        (tmp_path / f"{k}.csv").write_bytes(text.encode())
        want[f"{k}.csv"] = parsed(text)
    (tmp_path / "empty.csv").write_bytes(b"")
    for broadcast in (True, False):
        monkeypatch.setattr(records, "fits_broadcast", lambda df, yes=broadcast: yes)
        found = delimited.read_records(spark, str(tmp_path))
        assert lines.read_lines(spark, str(tmp_path), True).rdd.getNumPartitions() > 30
        got = {}
        for r in found.collect():
            assert not r.open
            got.setdefault(r.path.rsplit("/", 1)[1], {})[r.line_no] = r.line
        assert set(got) == set(want)
        for name, rows in want.items():
            assert sorted(got[name]) == list(range(len(rows) + 1))
            assert [next(csv.reader(io.StringIO(got[name][k + 1], newline=""))) for k in range(len(rows))] == rows


def test_rows_equal_one_task_per_file(spark, tmp_path, tiny_splits):
    for k in range(4):
        (tmp_path / f"{k}.csv").write_bytes(body(100 + k, "\n").encode())
    split = delimited.read_delimited(spark, str(tmp_path), ["a", "b", "c"], multi_line=True, nulls="copy")
    whole = spark.read.schema("a string, b string, c string").csv(
        str(tmp_path), multiLine=True, header=True, escape='"', emptyValue="", nullValue="\u0002")
    key = lambda r: tuple(x or "" for x in r)
    assert sorted(map(key, split.select("a", "b", "c").collect())) == sorted(map(key, whole.collect()))


def test_count_rows_and_limits(spark, tmp_path, tiny_splits, rows):
    text = body(7, "\n")
    (tmp_path / "q.csv").write_text(text, newline="")
    assert rows(delimited.count_rows(spark, str(tmp_path)), "rows", "columns") == [(40, 3)]
    assert rows(delimited.count_rows(spark, str(tmp_path), has_header=False), "rows") == [(41,)]
    first = delimited.read_delimited(spark, str(tmp_path), ["a", "b", "c"], multi_line=True, limit_rows=9)
    assert sorted(int(r.a) for r in first.collect()) == list(range(9))
    below = delimited.read_delimited(spark, str(tmp_path), ["a", "b", "c"], multi_line=True, header_row=5)
    assert sorted(int(r.a) for r in below.collect()) == list(range(5, 40))


def test_quote_that_is_never_closed(spark, tmp_path, tiny_splits):
    (tmp_path / "o.csv").write_text('a,b\n1,x\n2,"open\n' + "3,y\n" * 60)
    (tmp_path / "p.csv").write_text('a,b\n4,5" pipe\n6,"z" tail "\n7,"ok\nok"\n')
    df = delimited.read_delimited(spark, str(tmp_path), ["a", "b"], multi_line=True, flag_bad=True)
    got = {r.a: (r.b, r._bad) for r in df.collect()}
    assert set(got) == {"1", "2", "4", "6", "7"}
    assert got["2"][1] == '2,"open' and all(got[k][1] is None for k in "1467")
    assert got["4"][0] == '5" pipe' and got["7"][0] == "ok\nok"
    with pytest.raises(Exception, match="not closed"):
        delimited.read_delimited(spark, str(tmp_path), ["a", "b"], multi_line=True, strict=True).collect()


def test_other_delimiters_and_encoding(spark, tmp_path, tiny_splits):
    (tmp_path / "e.csv").write_bytes("a||b\n'é\n||'||'it''s'\n1||2\n".encode("iso-8859-1"))
    df = delimited.read_delimited(
        spark, str(tmp_path), ["a", "b"], delimiter="||", quote="'", encoding="LATIN1", multi_line=True)
    assert sorted((r.a, r.b) for r in df.collect()) == [("1", "2"), ("é\n||", "it's")]


def test_effects_and_running_states(spark):
    texts = ["", "a,b", 'a,"b', 'b",c', '"a","b"', 'x"y', 'a,""', '"', '""', '"""', 'a,"b""', 'c"",d', '"a"b,"c', '","']
    got = spark.createDataFrame([(t,) for t in texts], "line string").select(
        "line", records.line_effect(F.col("line")).alias("e")).collect()

    def ends_inside(text, inside):
        at_start = not inside
        k = 0
        while k < len(text):
            if inside:
                if text.startswith('""', k):
                    k += 2
                    continue
                if text[k] == '"':
                    inside, at_start = False, False
            elif text[k] == ",":
                at_start = True
                k += 1
                continue
            elif text[k] == '"' and at_start:
                inside = True
            at_start = False
            k += 1
        return inside

    for r in got:
        want = {(False, True): records.KEEPS, (False, False): records.OUTSIDE, (True, True): records.INSIDE,
                (True, False): records.TURNS}[ends_inside(r.line, False), ends_inside(r.line, True)]
        assert r.e == want, r.line
    rng = np.random.default_rng(0)
    for _ in range(50):
        effects = rng.integers(0, 4, 12)
        for start in (0, 1):
            state, states = start, [start]
            for e in effects:
                state = {0: state, 1: 0, 2: 1, 3: 1 - state}[int(e)]
                states.append(state)
            assert records._running(effects, start).tolist() == states


def test_long_quoted_lines_need_no_stack(spark):
    line = '"' + '""x' * 200_000
    df = spark.createDataFrame([(line,)], "line string").select(records.line_effect(F.col("line")).alias("e"))
    assert df.first().e in (records.TURNS, records.INSIDE)


def test_counts_move_no_text(spark, tmp_path, tiny_splits, rows, monkeypatch):
    for k in range(3):
        (tmp_path / f"{k}.csv").write_bytes((body(k, "\n") + ('9,"open\nz,z' if k == 2 else "")).encode())
    (tmp_path / "head.csv").write_text("a,b,c\n")
    found = delimited.read_records(spark, str(tmp_path)).groupBy("path").agg(F.count(F.lit(1)).alias("n"))
    want = [(p, n - 1) for p, n in rows(found) if n > 1]
    seen, states = [], records._states
    monkeypatch.setattr(records, "_states", lambda df, **k: seen.append(df.columns) or states(df, **k))
    assert rows(delimited.count_rows(spark, str(tmp_path)), "path", "rows") == want
    assert len(seen) == 1 and "line" not in seen[0]
