"""Configurations, publishing, streaming and the registered queries."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from quayside.operators import deliver
from quayside.plans import config
from quayside.plans.logs import Logs, run_upsert
from quayside.plans.publish_job import PublishJob, run_delivery
from quayside.sources.tables import VersionedTable
from quayside.streaming import pickup

LOAD = r"""
- path: /off
  enabled: False
  project_name: none
  mapping: [{file_regex: x, file_type: CSV}]
- path: /data
  project_name: p
  limit_rows: 5
  file_delimiter: ';'
  process_logic: [{logic: custom_logic.generate_checksum}]
  mapping:
    - {file_regex: '.*a.csv', file_type: CSV, table_name: first, column_list: "x, y", process_logic: [{logic: custom_logic.pandas_import}]}
    - {file_regex: '.*b.csv', file_type: CSV, enabled: False, table_name: hidden}
    - {file_regex: '.*c.csv', file_type: CSV, limit_rows: 7, file_delimiter: '|'}
    - {file_regex: '.*d.csv', file_type: CSV, limit_rows: None}
"""


def test_mappings():
    a, c, d = config.read_mappings(LOAD)
    assert (a.order, c.order, d.order) == (0, 1, 2)
    assert a.steps == ("generate_checksum", "pandas_import")
    assert c.steps == ("generate_checksum",)                       # once, not twice
    assert (a.table_name, c.table_name) == ("first", "first")      # sticky
    assert (a.delimiter, c.delimiter, d.delimiter) == (";", "|", "|")
    assert (a.limit_rows, c.limit_rows, d.limit_rows) == (5, 7, None)
    assert a.columns == ["x", "y"] and a.header_row == 0


def test_broken_mapping_stops():
    with pytest.raises(KeyError):
        config.read_mappings("[{path: /x, project_name: p, mapping: [{file_type: CSV}]}]")
    with pytest.raises(ValueError):
        config.read_mappings("[{path: /x, project_name: p, mapping: [{file_type: CSV, file_regex: '(?P<a>x)'}]}]")


def test_templates():
    item = {"log": "{{schema}}.log", "db": {"target": {"schema": "pub"}}, "sql": ["use {{schema}}", {"n": "t", "s": "{{n}}.{{schema}}"}]}
    got = config.fill_templates(item, item)
    assert got["log"] == "pub.log"
    assert got["sql"] == ["use pub", {"n": "t", "s": "t.pub"}]


def test_bound_sql():
    assert config.bind_sql("vacuum analyze {schema_name}.{table_name}", "s", "t", None) is None
    assert config.bind_sql("truncate table {schema_name}.{table_name} cascade", "s", "t", None) == "truncate table s.t"
    assert config.bind_sql("select {column_list} where f={file_id}", "s", "t", ["a", "b"]) == "select a,b where f=:file_id"
    with pytest.raises(ValueError):
        config.bind_sql("x", "s; drop", "t", None)


ITEM = """
- delivery_type: SCHEMA
  move_data: True
  db:
    source_db: {schema: src}
    target_db: {schema: pub}
  all_tables: True
  tables:
    - {table: loan, batch_method: COLUMN, column: file_id}
"""


@pytest.fixture
def job(spark, tmp_path):
    loan = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "file_id long, v string")
    other = spark.range(5)
    sources = {"loan": loan, "other": other}
    item = config.read_publish(ITEM)[0]
    return PublishJob(spark, item, str(tmp_path / "pub"), sources.__getitem__, ["loan", "other"])


def test_publish_moves_every_batch_once(spark, job, rows):
    log = job.run()
    assert rows(log, "trg_table", "rows_dumped", "rows_loaded", "status") == sorted([
        ("pub.loan", 2, 2, "Completed"), ("pub.loan", 1, 1, "Completed"), ("pub.loan", 1, 1, "Completed"),
        ("pub.other", 5, 5, "Completed")], key=repr)
    first = rows(spark.read.parquet(job.path("loan")), "file_id", "v")
    assert len(first) == 4
    assert job.open_batches().isEmpty()
    assert job.run().count() == 4
    assert rows(spark.read.parquet(job.path("loan")), "file_id", "v") == first


def test_publish_resumes_with_unfinished_batches(spark, job, rows):
    job.run()
    keep = job.log.read().filter("rows_dumped <> 2")
    job.log.replace(keep)                     # as if the run had stopped before one log row
    assert job.open_batches().count() == 1
    job.run()
    assert len(rows(spark.read.parquet(job.path("loan")), "v")) == 4
    assert job.open_batches().isEmpty()


def test_plan_only(spark, job):
    job.item = {**job.item, "move_data": False}
    assert job.run().isEmpty() and job.open_batches().count() == 4


def test_empty_chunk_is_an_error(spark, job):
    job.source = lambda name: spark.createDataFrame([], "file_id long, v string")
    with pytest.raises(ValueError, match="no batches"):
        job.plan()


def test_delivery_modes(spark, tmp_path, rows):
    ddl = "k long, file_id long, v string, t timestamp"
    src = spark.createDataFrame([(1, 1, "a", None), (2, 2, "b", None), (3, 3, "c", None)], ddl)
    target = VersionedTable(spark, str(tmp_path / "t"), src.schema)
    run_delivery(deliver.KILLFILL, src.filter("k = 1"), target)
    run_delivery(deliver.FILE_ID, src, target)
    run_delivery(deliver.FILE_ID, src, target)
    assert rows(target.read(), "k") == [(1,), (2,), (3,)]
    catalog = spark.createDataFrame([(1, "p"), (2, "q"), (9, "q")], "file_id long, project_name string")
    more = src.unionByName(spark.createDataFrame([(4, 9, "d", None), (5, 8, "e", None)], ddl))
    run_delivery(deliver.PROJECT, more, target, catalog=catalog, project="q")
    assert rows(target.read(), "k") == [(1,), (2,), (3,), (4,)]
    import datetime as dt

    timed = spark.createDataFrame([(1, 1, "old", dt.datetime(2024, 1, 1))], ddl)
    run_delivery(deliver.KILLFILL, timed, target)
    newer = spark.createDataFrame(
        [(1, 2, "new", dt.datetime(2024, 1, 3)), (1, 3, "mid", dt.datetime(2024, 1, 2)), (7, 2, "x", dt.datetime(2023, 1, 1))], ddl)
    run_delivery(deliver.LAST_UPDATE, newer, target, keys=["k"], time="t", tie="file_id")
    assert rows(target.read(), "k", "v") == [(1, "new")]
    with pytest.raises(ValueError):
        run_delivery("OTHER", src, target)


def test_upsert_with_logs(spark, tmp_path, rows):
    ddl = "k long, v string, file_id long"
    target = VersionedTable(spark, str(tmp_path / "t"), spark.createDataFrame([], ddl).schema)
    target.replace(spark.createDataFrame([(1, "a", 1), (2, "b", 1)], ddl))
    logs = Logs(spark, str(tmp_path / "logs"))
    assert logs.last_success("s.t", "s.t_upsert") is None
    assert run_upsert(target, spark.createDataFrame([(2, "c", 2), (3, "d", 2)], ddl), ["k"], "s.t", logs)
    status = logs.status.read().first()
    assert (status.previous_record_count, status.records_inserted, status.records_updated,
            status.records_deleted, status.current_record_count, status.success) == (2, 1, 1, 0, 3, "Y")
    assert logs.last_success("s.t", "s.t_upsert") == status.start_date
    twice = spark.createDataFrame([(9, "x", 3), (9, "y", 3)], ddl)
    assert not run_upsert(target, twice, ["k"], "s.t", logs)
    assert rows(target.read()) == [(1, "a", 1), (2, "c", 2), (3, "d", 2)]
    error = logs.errors.read().first()
    assert error.program_unit == "s.t_upsert" and len(error.error_message) <= 256
    assert rows(logs.status.read(), "success") == [("N",), ("Y",)]
    logs.add_errors(spark.createDataFrame([("x" * 5000, "m" * 5000)], "sql_statement string, error_message string"))
    longest = logs.errors.read().selectExpr("max(length(sql_statement))", "max(length(error_message))").first()
    assert tuple(longest) == (2000, 256)


def test_publish_retains_the_moved_rows(spark, job, tmp_path):
    job.item = {**job.item, "retain_data_file_path": str(tmp_path / "kept")}
    job.run()
    assert spark.read.csv(str(tmp_path / "kept" / "loan")).count() == 4


def test_stream_loads_each_file_once(spark, tmp_path, rows):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text("x,y\n1,2\n")
    (folder / "copy.csv").write_text("x,y\n1,2\n")
    args = (spark, str(folder), ["x", "y"], str(tmp_path / "out"), str(tmp_path / "seen"), str(tmp_path / "cp"))
    pickup.load_available(*args).awaitTermination()
    out = lambda: rows(spark.read.parquet(str(tmp_path / "out")), "x", "y")
    assert out() == [("1", "2")]
    (folder / "b.csv").write_text("x,y\n3,4\n")
    (folder / "late_copy.csv").write_text("x,y\n1,2\n")
    pickup.load_available(*args).awaitTermination()
    pickup.load_available(*args).awaitTermination()
    assert out() == [("1", "2"), ("3", "4")]
    seen = {r.path.rsplit("/", 1)[1]: r.duplicate_file for r in pickup.read_seen(spark, str(tmp_path / "seen")).collect()}
    assert seen == {"a.csv": False, "copy.csv": True, "b.csv": False, "late_copy.csv": True}


def test_repeated_batch_changes_nothing(spark, tmp_path, rows):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("x\n1\n")
    batch = spark.createDataFrame([(str(tmp_path / "in" / "a.csv"), "k", False)], pickup.SEEN_SCHEMA[:3])
    write = pickup.load_batch(spark, ["x"], str(tmp_path / "out"), str(tmp_path / "seen"))
    write(batch, 0)
    write(batch, 0)
    assert rows(spark.read.parquet(str(tmp_path / "out")), "x") == [("1",)]
    assert pickup.read_seen(spark, str(tmp_path / "seen")).count() == 1


def test_a_batch_reads_only_what_is_new(spark, tmp_path, rows):
    folder = tmp_path / "in"
    folder.mkdir()
    args = (spark, str(folder), ["x"], str(tmp_path / "out"), str(tmp_path / "seen"), str(tmp_path / "cp"))
    read, state = [], []
    for lot in range(4):
        for k in range(5):
            (folder / f"{lot}-{k}.csv").write_text(f"x\n{lot}{k}\n")
            (folder / f"{lot}-{k}.copy.csv").write_text(f"x\n{lot}{k}\n")
        (folder / f"{lot}-old.csv").write_text("x\n00\n")
        done = pickup.load_available(*args)
        done.awaitTermination()
        with_rows = [p for p in done.recentProgress if p.numInputRows]
        read.append(sum(p.numInputRows for p in with_rows))
        state.append([op.numRowsUpdated for p in with_rows for op in p.stateOperators])
    assert read[1] == read[2] == read[3] == 11  # files of the lot, not those seen before
    assert state[1] == state[2] == state[3] == [5]
    assert sorted(rows(spark.read.parquet(str(tmp_path / "out")), "x")) == [(f"{lot}{k}",) for lot in range(4) for k in range(5)]
    copies = {r.path.rsplit("/", 1)[1] for r in pickup.read_seen(spark, str(tmp_path / "seen")).filter("duplicate_file").collect()}
    assert copies == {f"{lot}-{k}.csv" for lot in range(4) for k in range(5)} | {f"{lot}-old.csv" for lot in range(4)}


def test_an_unreadable_file_stops_its_batch(spark, tmp_path, monkeypatch):
    from pyspark.errors import PySparkException

    with pytest.raises(PySparkException, match="nothing there"):
        files = spark.createDataFrame([("/nothing there",)], "path string")
        from quayside.sources.storage import digests

        digests(files).select(F.coalesce("crc", F.raise_error(F.concat_ws(": ", "path", "error")))).collect()


def test_every_query_is_registered_once():
    queries, oracles = entry_point.queries(), entry_point.oracle_sql()
    assert set(oracles) <= set(queries)
    own = entry_point.load_all()  # without the training-data subpackage, which may be absent
    assert set(own.QUERIES) - set(own.ORACLES) == {"catalog_scan", "index_cardinality_approx"}
