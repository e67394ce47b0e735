"""Rows that must not get lost: missing batches, missing keys, missing checksums, whole documents."""

import json

from pyspark.sql import functions as F

from quayside.functions.names import snake_ddl
from quayside.operators import catalog, deliver, merge, skew
from quayside.sources import tables


def test_missing_batch_is_moved_and_counted(spark, tmp_path):
    source = spark.createDataFrame([(1, "a"), (2, None), (3, None)], "id int, b string")
    log = deliver.move_batches(source, "b", source.select("b").distinct(), str(tmp_path / "moved"))
    got = {r["b"]: (r["rows_dumped"], r["rows_loaded"], r["status"]) for r in log.collect()}
    assert got == {"a": (1, 1, "Completed"), None: (2, 2, "Completed")}
    some = deliver.move_batches(source, "b", source.filter("b = 'a'").select("b"), str(tmp_path / "some"))
    assert [r["b"] for r in some.collect()] == ["a"]


def test_insert_ignore_keeps_rows_without_a_key(spark, rows):
    target = spark.createDataFrame([(1, "x")], "k int, v string")
    fresh = spark.createDataFrame([(1, "n"), (2, "b"), (2, "a"), (None, "p"), (None, "q")], "k int, v string")
    assert rows(merge.insert_ignore(target, fresh, ["k"])) == sorted([(2, "a"), (None, "p"), (None, "q")], key=repr)


def test_files_without_checksum_are_no_copies(spark, rows):
    files = spark.createDataFrame(
        [(1, "p", None, "Processed"), (2, "p", None, "Processed"), (3, "p", "c", "Processed"), (4, "p", "c", "Processed")],
        "file_id int, project_name string, crc string, file_process_state string")
    assert rows(catalog.first_copies(files, [F.col("file_id")]), "file_id") == [(1,), (2,), (3,)]
    assert {r[0] for r in catalog.duplicate_files(files).select("file_id").collect()} == {3, 4}


def test_large_hot_lookup_is_salted(spark, rows, monkeypatch):
    monkeypatch.setattr(skew, "SALTS", 3)
    left = spark.createDataFrame([(k % 3, k) for k in range(40)] + [(None, 99)], "k int, v int")
    right = spark.createDataFrame([(0, "a"), (1, "b"), (7, "c")], "k int, w string")
    for how in ("inner", "left", "left_semi", "left_anti"):
        got = skew.lookup_join(left, right, ["k"], how, broadcast_rows=0, share=4)
        assert rows(got, *sorted(got.columns)) == rows(left.join(right, "k", how), *sorted(got.columns)), how


def test_whole_documents(spark, tmp_path):
    df = spark.createDataFrame([(k, f"t{k}") for k in range(57)], "a int, b string").repartition(3).sortWithinPartitions("a")

    def text(name):
        parts = sorted((tmp_path / name).glob("part-*"), key=lambda p: p.name)
        return "".join(p.read_text() for p in parts)

    tables.dump_json(df, str(tmp_path / "j"))
    assert sorted(int(r[0]) for r in json.loads(text("j"))["data"]) == list(range(57))
    tables.dump_html(df, str(tmp_path / "h"))
    assert text("h").count("<tr") == 58 and text("h").rstrip().endswith("</tbody></table>")
    tables.dump_markdown(df, str(tmp_path / "m"))
    assert len([x for x in text("m").splitlines() if x.strip()]) == 59
    tables.dump_json(df.limit(0), str(tmp_path / "e"))
    assert json.loads(text("e")) == {"data": []}


def test_names_inside_other_names_stay(spark):
    assert snake_ddl("create table t (LoanID int, ID int, MyLoanID int) ,", ["ID", "LoanID"]) == (
        "create table t (loan_id int, id int, myloanid int),")
