"""Versions and additions of tables, and lines put into new quotes."""

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quayside.functions.text import requote
from quayside.plans import config
from quayside.sources.tables import VersionedTable


def folders(path):
    return sorted(p.name for p in path.iterdir())


def test_only_the_stated_versions_stay(spark, tmp_path, rows):
    t = VersionedTable(spark, str(tmp_path / "t"), keep=2)
    for k in range(4):
        t.replace(spark.range(k, k + 2))
        t.append(spark.range(10 * k, 10 * k + 1))
    assert folders(tmp_path / "t") == ["a=00000003-000001", "a=00000004-000001", "v=00000003", "v=00000004"]
    assert sorted(rows(t.read())) == [(3,), (4,), (30,)]
    with pytest.raises(ValueError):
        VersionedTable(spark, str(tmp_path / "t"), keep=0)


def test_additions_are_seen_whole_or_not_at_all(spark, tmp_path, rows):
    t = VersionedTable(spark, str(tmp_path / "t"), spark.range(0).schema)
    t.append(spark.range(2))
    before = t.read()
    t.append(spark.range(2, 4))
    # an addition without its mark is not there yet
    spark.range(50, 60).write.parquet(str(tmp_path / "t" / "a=00000001-000002"))
    (tmp_path / "t" / "a=00000001-000002" / "_SUCCESS").unlink()
    assert rows(t.read()) == [(k,) for k in range(4)] and rows(before) == [(0,), (1,)]
    with pytest.raises(Exception):
        t.append(spark.range(1).select(F.raise_error(F.lit("x")).cast("long").alias("id")))
    assert rows(t.read()) == [(k,) for k in range(4)]
    t.append(spark.range(7, 8).select(F.lit("extra").alias("other"), "id"))
    assert rows(t.read()) == [(k,) for k in (0, 1, 2, 3, 7)]


def test_many_additions_become_a_version(spark, tmp_path, rows, monkeypatch):
    monkeypatch.setattr(VersionedTable, "ADDITIONS", 3)
    t = VersionedTable(spark, str(tmp_path / "t"))
    t.replace(spark.range(1))
    for k in range(1, 6):
        t.append(spark.range(k, k + 1))
    assert rows(t.read()) == [(k,) for k in range(6)] and t.versions() == [1, 2]


def by_characters(line, delimiter, new):
    """The line character by character: outer quotes stay, a delimiter between quotes changes, every
    other quote is doubled."""
    start = 1 if line.startswith('"') else 0
    stop = len(line) - (1 if line.endswith('"') and len(line) > start else 0)
    out, k = line[:start], start
    while k < stop:
        if line.startswith(f'"{delimiter}"', k) and k + len(delimiter) + 2 <= stop:
            out += f'"{new}"'
            k += len(delimiter) + 2
        else:
            out += line[k] * (2 if line[k] == '"' else 1)
            k += 1
    return out + line[stop:]


def test_requoted_lines(spark):
    import random

    rng = random.Random(3)
    lines = ["".join(rng.choice('"",|$a.') for _ in range(rng.randint(0, 14))) for _ in range(600)] + ["", '"', '""', '"""', None]
    for delimiter, new in ((",", "|"), ("|", ","), (".", "$1")):
        frame = spark.createDataFrame([(x,) for x in lines], "line string")
        got = frame.select("line", requote(F.col("line"), delimiter, new).alias("out")).collect()
        for r in got:
            assert r.out == (None if r.line is None else by_characters(r.line, delimiter, new)), (r.line, delimiter)


SETS = [
    ("delete from s.t where file_id = :file_id", True), ("insert into a select x from t where t.file_id=:file_id and y > 1", True),
    ("update t set done = true where (file_id = :file_id)", True), ("insert into a select x from t join u on u.file_id = :file_id", True),
    ("insert into a select :file_id, x from t where file_id = :file_id", False), ("update t set file_id = :file_id where x = 1", False),
    ("insert into a select count(*) from t where file_id = :file_id", False), ("delete from t where a = 1 or file_id = :file_id", False),
    ("insert into a select distinct x from t where file_id = :file_id", False), ("select * from t where file_id = :file_id", False),
    ("insert into a select x from t where file_id = :file_id limit 5", False), ("delete from t where file_id > :file_id", False),
]


@pytest.mark.parametrize("sql, wide", SETS)
def test_statements_over_sets_of_files(sql, wide):
    got, why = config.over_files(sql, "ids")
    assert (got is not None) == wide and bool(why) != wide
    if wide:
        assert ":file_id" not in got and re.search(r"file_id IN \(SELECT file_id FROM ids\)", got)


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab,\"|", max_size=12))
def test_by_characters_is_its_own_inverse_on_plain_fields(text):
    assert by_characters(text.replace('"', ""), ",", "|") == text.replace('"', "")


def test_bucketed_targets_aggregate_without_a_shuffle(spark, rows):
    from quayside.sources.tables import CatalogTable

    spark.sql("CREATE DATABASE IF NOT EXISTS bucketed")
    source = spark.range(200).selectExpr("id", "id % 7 AS file_id")
    t = CatalogTable(spark, "bucketed.t", source, "file_id", 4)
    assert not t.exists()
    t.create()
    t.replace(source)
    t.append(source.selectExpr("file_id", "id + 1000 AS id"))
    sums = t.read().groupBy("file_id").count()
    assert "Exchange" not in sums._jdf.queryExecution().executedPlan().toString()
    assert sorted(r["count"] for r in sums.collect()) == [56] * 3 + [58] * 4
    t.replace(source.filter("id < 3"))
    assert rows(t.read(), "id") == [(0,), (1,), (2,)]
    spark.sql("DROP DATABASE bucketed CASCADE")
