"""End-to-end loads: the scenarios of the sample configurations, with assertions."""

import gzip
import hashlib
import itertools
import tarfile
import zipfile

import pytest
import yaml

from quayside.plans.load_job import NO_MAPPING, LoadJob

CSV = "LoanKey, State,rate\nk1, CA,3.5\nk2, NY,4.0\nk3, CA,n/a"


def config(folder, schema, importer="pandas_import", table="", project="loans"):
    """Archives are unpacked, delimited files imported; every file is counted, checksummed and
    checked for duplicates first."""
    def unpack(pattern, kind):
        return {"file_regex": pattern, "file_type": kind,
                "process_logic": [{"logic": "custom_logic.extract_compressed_file"}]}

    load = {
        "file_regex": r".*\.csv$", "file_type": "CSV", "schema_name": schema, "file_delimiter": ",",
        "append_file_id": True, "limit_rows": "None",
        "process_logic": [{"logic": f"custom_logic.{importer}"}],
        "post_action": [{"sql": "vacuum analyze {schema_name}.{table_name}"}],
    }
    checks = ("count_file_linux_wc", "generate_checksum", "log_file_size", "abort_if_duplicate")
    return yaml.safe_dump([{
        "path": str(folder), "project_name": project,
        "extract_file_name_data": r"\d\d\d\d", "format_extracted_date": "YYYY",
        "process_logic": [{"logic": f"custom_logic.{c}"} for c in checks],
        "mapping": [
            unpack(r".*\.zip$", "zip"),
            unpack(r".*gz$", "gzip"),
            load | ({"table_name": table} if table else {}),
        ],
    }])


def states(catalog):
    return {r.file_name: r for r in catalog.collect()}


def test_load_with_archives_duplicates_and_states(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "sales_2018.csv").write_text(CSV)
    (folder / "z_copy.csv").write_text(CSV)
    (folder / "readme.txt").write_text("not listed")
    with zipfile.ZipFile(folder / "pack_2017.zip", "w") as z:
        z.writestr("deep/sales_inner.csv", CSV + "\n1,2,3\n")
    with tarfile.open(folder / "pack_2016.tar.gz", "w:gz") as t:
        (tmp_path / "tar_inner.csv").write_text("LoanKey,State,rate\n9,8,7\n")
        t.add(tmp_path / "tar_inner.csv", "tar_inner.csv")

    job = LoadJob.from_yaml(spark, config(folder, "load_a", table="sales"), str(tmp_path / "work"))
    found = states(job.run())

    assert set(found) == {
        "sales_2018.csv", "z_copy.csv", "pack_2017.zip", "pack_2016.tar.gz", "sales_inner.csv", "tar_inner.csv",
    }
    assert found["sales_2018.csv"].file_process_state == "Processed"
    assert found["sales_2018.csv"].rows_inserted == 3
    assert found["sales_2018.csv"].total_rows == 4
    assert found["sales_2018.csv"].file_name_data == "2018-01-01"
    assert found["sales_2018.csv"].database_table == "load_a.sales"
    assert found["sales_2018.csv"].process_msg_trail.split(";\n")[0] == "pandas_import"
    assert found["z_copy.csv"].file_process_state == "FAILED"
    assert found["z_copy.csv"].duplicate_file
    assert "Duplicate File Found" in found["z_copy.csv"].last_error_msg
    assert found["pack_2017.zip"].total_files == 1
    inner = found["sales_inner.csv"]
    assert inner.parent_file_id == found["pack_2017.zip"].id
    assert inner.file_name_data == "2017-01-01"
    assert inner.file_type == "CSV" and inner.rows_inserted == 4

    table = spark.table("load_a.sales")
    # the blank in front of " State" becomes an underscore
    assert table.columns == ["file_id", "loan_key", "_state", "rate"]
    assert found["tar_inner.csv"].file_process_state == "FAILED"  # its state is not in the table
    assert "columns not in load_a.sales: state" in found["tar_inner.csv"].last_error_msg
    assert table.count() == 3 + 4
    per_file = {r.file_id: r["count"] for r in table.groupBy("file_id").count().collect()}
    assert per_file[found["sales_2018.csv"].id] == 3  # every row carries its file's id

    again = job.run()
    assert spark.table("load_a.sales").count() == table.count()
    assert again.count() == 6


def test_copy_reopens_when_first_copy_fails(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text("x,y\n1,2\n1,2,3\n")
    (folder / "b.csv").write_text("x,y\n1,2\n1,2,3\n")
    job = LoadJob.from_yaml(
        spark, config(folder, "load_b", "client_copy", "t", "p"), str(tmp_path / "work"))
    found = states(job.run())
    assert {r.file_process_state for r in found.values()} == {"FAILED"}
    assert not any(r.duplicate_file for r in found.values())
    assert all("malformed row" in r.last_error_msg for r in found.values())


def test_strict_load_leaves_target_unchanged(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "good.csv").write_text('x,y\n1,""\n2,\n')
    (folder / "bad.csv").write_text("x,y\n3,4\n5\n")
    job = LoadJob.from_yaml(
        spark, config(folder, "load_c", "pg_bulk_copy", "t", "p"), str(tmp_path / "work"))
    found = states(job.run())
    assert found["good.csv"].file_process_state == "Processed"
    assert found["bad.csv"].file_process_state == "FAILED"
    rows = {(r.x, r.y) for r in spark.table("load_c.t").collect()}
    assert rows == {("1", ""), ("2", None)}


def test_unmapped_and_extra_columns(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text("x,y\n1,2\n")
    (folder / "b.csv").write_text("x,y,z\n1,2,3\n")
    job = LoadJob.from_yaml(
        spark, config(folder, "load_d", table="t", project="p"), str(tmp_path / "work"))
    found = states(job.run())
    assert found["a.csv"].file_process_state == "Processed"
    assert found["b.csv"].file_process_state == "FAILED"
    assert "columns not in load_d.t: z" in found["b.csv"].last_error_msg

    job.mappings = [m for m in job.mappings if m.file_type != "CSV"]
    (folder / "c.csv").write_text("x,y\n5,6\n")
    job.reset("DATA")
    job.mappings = job.mappings[:1]
    found = states(job.run(reset_failed=False))
    assert found["a.csv"].last_error_msg == NO_MAPPING


COMBINATIONS = list(itertools.product([False, True], [False, True], [None, 10], [True, False]))


@pytest.fixture(scope="module")
def option_run(spark, tmp_path_factory):
    """One load with a mapping, a file and a table for each combination of checksum, file id, row
    limit and truncation."""
    root = tmp_path_factory.mktemp("options")
    (root / "in").mkdir()
    spark.sql("CREATE DATABASE IF NOT EXISTS opt")
    entries = []
    for n, (crc, file_id, limit, truncate) in enumerate(COMBINATIONS):
        (root / "in" / f"data{n:02d}.csv").write_text("a,b\n" + "".join(f"{i},v{i}\n" for i in range(25)))
        columns = (["file_id long"] if file_id else []) + (["crc string"] if crc else []) + ["a string", "b string"]
        spark.sql(f"CREATE TABLE opt.t{n:02d} ({', '.join(columns)}) USING parquet")
        spark.sql(f"INSERT INTO opt.t{n:02d} SELECT {', '.join(['null'] * len(columns))}")
        actions = [{"sql": "truncate table {schema_name}.{table_name} cascade"}] if truncate else []
        entries.append({
            "file_regex": f".*data{n:02d}.csv", "file_type": "CSV", "schema_name": "opt",
            "table_name": f"t{n:02d}", "append_file_id": file_id, "append_crc": crc, "limit_rows": limit,
            "pre_action": actions, "process_logic": [{"logic": "custom_logic.pandas_import"}],
        })
    text = yaml.safe_dump([{"path": str(root / "in"), "project_name": "opt", "mapping": entries}])
    return states(LoadJob.from_yaml(spark, text, str(root / "work")).run())


@pytest.mark.parametrize("n", range(16))
def test_option_product(spark, option_run, n):
    crc, file_id, limit, truncate = COMBINATIONS[n]
    row = option_run[f"data{n:02d}.csv"]
    want = 25 if limit is None else limit
    assert row.rows_inserted == want, row
    loaded = spark.table(f"opt.t{n:02d}").collect()
    assert len(loaded) == want + (0 if truncate else 1)
    new = [r for r in loaded if r.a is not None]
    assert {r.a for r in new} == {str(i) for i in range(want)}
    if crc:
        assert {r.crc for r in new if r.a == "3"} == {hashlib.md5(b"3,v3").hexdigest()}
    if file_id:
        assert {r.file_id for r in new} == {row.id}


def test_workbooks_data_packs_and_staged_upserts(spark, tmp_path):
    from tests.test_sources import workbook

    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "rates.xlsx").write_bytes(workbook({"S": ({"A1": "Loan ID", "B1": "Rate", "A2": "007", "B2": 1.5}, {})}))
    toc = ({"A1": "Loans", "A2": "one"}, {"A2": "Loans!$B$1"})
    loans = ({"B1": "Figure", "B2": "USD", "C3": "2018", "B4": "north", "C4": 1}, {})
    (folder / "DataPack.xlsx").write_bytes(workbook({"Contents": toc, "Loans": loans}))
    (folder / "a.csv").write_text("k,v\n1,old\n2,two\n")
    (folder / "b.csv").write_text("k,v\n1,new\n3,three\n")
    spark.sql("CREATE DATABASE stg_up")
    spark.sql("CREATE DATABASE data_up")
    spark.sql("CREATE TABLE data_up.loan (file_id long, k string, v string) USING parquet")
    spark.sql("INSERT INTO data_up.loan VALUES (0, '2', 'two'), (0, '9', 'nine')")

    def steps(*names):
        return [{"logic": f"custom_logic.{n}"} for n in names]

    text = yaml.safe_dump([{"path": str(folder), "project_name": "p", "mapping": [
        {"file_regex": ".*DataPack.xlsx", "file_type": "XLSX", "schema_name": "stg_up", "table_name": "pack",
         "process_logic": steps("generate_checksum", "wyman")},
        {"file_regex": ".*xlsx", "file_type": "XLS", "schema_name": "stg_up", "table_name": "rates",
         "append_file_id": True, "process_logic": steps("row_count_excel", "pandas_import")},
        {"file_regex": ".*csv", "file_type": "CSV", "schema_name": "stg_up", "table_name": "loan", "keys": ["k"],
         "process_logic": steps("pandas_import", "upsert_table_from_stg")},
    ]}])
    found = states(LoadJob.from_yaml(spark, text, str(tmp_path / "work"), "data_up").run())
    assert {r.file_process_state for r in found.values()} == {"Processed"}, found
    book = found["rates.xlsx"]
    assert (book.total_rows, book.rows_inserted, book.database_table) == (1, 1, "stg_up.rates")
    assert [tuple(r) for r in spark.table("stg_up.rates").select("file_id", "loan_id", "rate").collect()] == [
        (book.id, "007", "1.5")]
    pack = spark.table("stg_up.pack").first()
    assert (pack.file_id, pack.sheetname, pack.figure, pack.units, pack.dimension, pack.measure, pack.stat_value) == (
        str(found["DataPack.xlsx"].id), "Loans", "Figure", "USD", "north", "2018", "1")
    assert found["DataPack.xlsx"].total_rows == 1
    a, b = found["a.csv"].id, found["b.csv"].id
    assert sorted(tuple(r) for r in spark.table("data_up.loan").select("k", "v", "file_id").collect()) == [
        ("1", "new", b), ("2", "two", 0), ("3", "three", b), ("9", "nine", 0)]


def test_copy_by_position_into_a_wider_table(spark, tmp_path):
    """Without a column list a copy fills the table's columns from the left; a missing folder is
    passed over."""
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text("h1,h2\n1,2\n")
    spark.sql("CREATE DATABASE load_f")
    spark.sql("CREATE TABLE load_f.t (file_id long, x string, y string, z string) USING parquet")
    text = config(folder, "load_f", "client_copy", "t", "p")
    text += config(tmp_path / "gone", "load_f", "client_copy", "t", "p")
    found = states(LoadJob.from_yaml(spark, text, str(tmp_path / "work")).run())
    row = spark.table("load_f.t").first()
    assert (row.file_id, row.x, row.y, row.z) == (found["a.csv"].id, "1", "2", None)


def test_single_gz_member(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    with gzip.open(folder / "one.csv.gz", "wt") as f:
        f.write("x,y\n1,2\n")
    job = LoadJob.from_yaml(
        spark, config(folder, "load_e", table="t", project="p"), str(tmp_path / "work"))
    found = states(job.run())
    assert found["one.csv"].rows_inserted == 1
    assert found["one.csv"].parent_file_id == found["one.csv.gz"].id


def test_statements_that_count_run_once_for_all_files(spark, tmp_path, rows, caplog):
    (tmp_path / "in").mkdir()
    for k in range(4):
        (tmp_path / "in" / f"n{k}.csv").write_text("a,b\n" + "".join(f"{i},x\n" for i in range(k + 1)))
    spark.sql("CREATE DATABASE each_file")
    for name in ("sizes", "big", "chain"):
        spark.sql(f"CREATE TABLE each_file.{name} (file_id long, n long) USING parquet")
    counted = "select {file_id}, count(1) from {schema_name}.t where file_id = '{file_id}'"
    text = yaml.safe_dump([{"path": str(tmp_path / "in"), "project_name": "each", "mapping": [{
        "file_regex": ".*csv$", "file_type": "CSV", "schema_name": "each_file", "table_name": "t", "append_file_id": True,
        "process_logic": [{"logic": "custom_logic.pandas_import"}],
        "post_action": [
            {"sql": "insert into {schema_name}.sizes " + counted},
            {"sql": "insert into {schema_name}.big (n, file_id) select count(case when a <> ', from' and a > 1 then 1 end) as k, "
                    "{file_id} as f from {schema_name}.t where file_id = {file_id}"},
        ]}]}])
    done = states(LoadJob.from_yaml(spark, text, str(tmp_path / "work")).run())
    files = {done[f"n{k}.csv"].id: k + 1 for k in range(4)}
    assert {r.file_process_state for r in done.values()} == {"Processed"}
    assert rows(spark.table("each_file.sizes")) == sorted(files.items())
    assert rows(spark.table("each_file.big")) == sorted((i, max(0, n - 2)) for i, n in files.items())
    assert "once per file" not in caplog.text

    # What reads the rows it inserted for the files before still goes file by file.
    job = LoadJob.from_yaml(spark, text, str(tmp_path / "work"))
    ids = spark.createDataFrame([(i,) for i in files], "id long")
    job._for_files("insert into each_file.chain select :file_id, count(1) from each_file.chain where file_id <> :file_id", ids)
    assert rows(spark.table("each_file.chain")) == [(i, k) for k, i in enumerate(sorted(files))]
    assert "once per file" in caplog.text


@pytest.mark.parametrize("sql", [
    "insert into a select k, :file_id from t where file_id = :file_id limit 3", "insert into a select 'n:file_id', count(1) from t",
    "insert into a select :file_id, k, count(1) from t where file_id = :file_id group by 1, 2",
    "insert into a select :file_id as f, count(1) from t group by f", "insert into a select :file_id, current_timestamp()",
    "delete from t where file_id > :file_id"])
def test_statements_left_to_each_file(sql):
    from quayside.plans.config import each_file

    assert each_file(sql, "ids") is None
