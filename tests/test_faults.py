"""Files that fail alone, equal archives, odd names, row limits, staged merges and publish modes."""

import zipfile

import pytest
import yaml

from pyspark.sql import functions as F

from quayside.operators import merge
from quayside.plans.load_job import LoadJob
from quayside.plans.logs import Logs
from quayside.plans.publish_job import PublishJob
from quayside.sources import delimited, html


def steps(*names):
    return [{"logic": f"custom_logic.{n}"} for n in names]


def test_one_bad_file_fails_alone(spark, tmp_path):
    folder = tmp_path / "in"
    (folder / "more").mkdir(parents=True)
    (folder / "good.csv").write_text("x,y\n1,2\n")
    (folder / "data[1].csv").write_text("x,y\n5,6\n")
    (folder / "wide.csv").write_text("x,y\n3,4,5\n")
    (folder / "bad.zip").write_bytes(b"no archive")
    (folder / "bad.xlsx").write_bytes(b"no workbook")
    for place in (folder, folder / "more"):
        with zipfile.ZipFile(place / "pack.zip", "w") as z:
            z.writestr(zipfile.ZipInfo("inner.csv"), "x,y\n7,8\n")
    text = yaml.safe_dump([{"path": str(folder), "project_name": "p", "mapping": [
        {"file_regex": r".*\.zip$", "file_type": "zip", "process_logic": steps("generate_checksum", "extract_compressed_file")},
        {"file_regex": ".*xlsx", "file_type": "XLSX", "schema_name": "fault", "table_name": "t",
         "process_logic": steps("pandas_import")},
        {"file_regex": ".*csv", "file_type": "CSV", "schema_name": "fault", "table_name": "t", "append_file_id": True,
         "process_logic": steps("count_file_linux_wc", "pandas_import")},
    ]}])
    job = LoadJob.from_yaml(spark, text, str(tmp_path / "work"))
    for _ in range(2):
        found = job.run().collect()
        ids = [r.id for r in found]
        assert len(ids) == len(set(ids)) == 9
        state = {r.file_name: r.file_process_state for r in found}
        assert {n for n, s in state.items() if s == "FAILED"} == {
            "wide.csv", "bad.zip", "bad.xlsx"}
        inner = [r for r in found if r.file_name == "inner.csv"]
        assert len(inner) == 2 and len({r.parent_file_id for r in inner}) == 2
    loaded = sorted((r.x, r.y) for r in spark.table("fault.t").collect())
    assert loaded == [("1", "2"), ("5", "6"), ("7", "8"), ("7", "8")]
    errors = Logs(spark, f"{tmp_path}/work/logging").errors.read().collect()
    assert {r.program_unit for r in errors} >= {"extract_compressed_file", "pandas_import"}


def test_copies_of_failed_content_take_one_pass(spark, tmp_path, monkeypatch):
    folder = tmp_path / "in"
    folder.mkdir()
    for k in range(6):
        (folder / f"bad{k}.csv").write_text("x,y\n1,2,3\n")
        (folder / f"good{k}.csv").write_text("x,y\n1,2\n")
    (folder / "other.dat").write_text("x,y\n1,2,3\n")  # the same content by another mapping has its own chance
    text = yaml.safe_dump([{"path": str(folder), "project_name": "p", "process_logic": steps("generate_checksum", "abort_if_duplicate"),
                            "mapping": [
        {"file_regex": r".*\.csv", "file_type": "CSV", "schema_name": "fate", "table_name": "t", "process_logic": steps("pandas_import")},
        {"file_regex": r".*\.dat", "file_type": "CSV", "schema_name": "fate", "table_name": "u", "column_list": "x,y,z",
         "has_header": False, "process_logic": steps("pandas_import")}]}])
    passes = []
    one = LoadJob._one_pass
    monkeypatch.setattr(LoadJob, "_one_pass", lambda self: passes.append(1) or one(self))
    found = {r.file_name: r for r in LoadJob.from_yaml(spark, text, str(tmp_path / "work")).run().collect()}
    bad = [found[f"bad{k}.csv"] for k in range(6)]
    assert {r.file_process_state for r in bad} == {"FAILED"} and not any(r.duplicate_file for r in bad)
    assert all("malformed row" in r.last_error_msg for r in bad)
    good = [found[f"good{k}.csv"] for k in range(6)]
    assert sum(r.file_process_state == "Processed" for r in good) == 1 and sum(r.duplicate_file for r in good) == 5
    assert len(passes) <= 3  # the copies of the bad file in the first, the file of the other mapping in the second
    errors = Logs(spark, f"{tmp_path}/work/logging").errors.read().filter("error_message like '%malformed%'")
    assert errors.count() >= 6


def test_staged_rows_keep_their_files(spark, tmp_path, rows):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text("k;v\n1;a1\n2;a2\n")
    (folder / "b.csv").write_text("k;v\n1;b1\n3;b3\n")
    (folder / "c.csv").write_text("k;v\n9;c1\n9;c2\n")
    text = yaml.safe_dump([{"path": str(folder), "project_name": "p", "mapping": [
        {"file_regex": ".*csv", "file_type": "CSV", "schema_name": "stg_keep", "table_name": "t", "keys": ["k"],
         "file_delimiter": ";", "new_delimiter": "|", "target_schema": "dat_keep",
         "process_logic": steps("pandas_import", "upsert_table_from_stg")},
    ]}])
    spark.sql("CREATE DATABASE stg_keep")
    spark.sql("CREATE DATABASE dat_keep")
    job = LoadJob.from_yaml(spark, text, str(tmp_path / "work"))
    found = {r.file_name: r for r in job.run().collect()}
    a, b = found["a.csv"].id, found["b.csv"].id
    want = sorted([("1", "b1", b), ("2", "a2", a), ("3", "b3", b)])
    assert rows(spark.table("dat_keep.t"), "k", "v", "file_id") == want
    assert found["c.csv"].file_process_state == "FAILED" and "not unique" in found["c.csv"].last_error_msg
    status = Logs(spark, f"{tmp_path}/work/logging").status.read().collect()
    assert [(r.records_inserted, r.current_record_count) for r in status] == [(3, 3)]
    (folder / "d.csv").write_text("k;v\n2;d2\n")
    found = {r.file_name: r for r in job.run(reset_failed=False).collect()}
    want = sorted([("1", "b1", b), ("2", "d2", found["d.csv"].id), ("3", "b3", b)])
    assert rows(spark.table("dat_keep.t"), "k", "v", "file_id") == want


def test_repeat_in_one_file_is_an_error(spark, rows):
    target = spark.createDataFrame([], "k int, v string, file_id long")
    twice = spark.createDataFrame([(1, "a", 7), (1, "b", 7)], "k int, v string, file_id long")
    with pytest.raises(Exception, match="not unique"):
        merge.merge_rows(target, twice, ["k"], dedupe_by="file_id").collect()
    older = spark.createDataFrame([(1, "a", 7), (1, "b", 8)], "k int, v string, file_id long")
    assert rows(merge.merge_rows(target, older, ["k"], dedupe_by="file_id"), "v") == [("b",)]


def test_limit_counts_rows_not_lines(spark, tmp_path, rows):
    (tmp_path / "q").mkdir()
    (tmp_path / "q" / "q.csv").write_text('a,b\n\n1,"x\ny"\n2,z\n3,w\n4,v\n')
    df = delimited.read_delimited(spark, str(tmp_path / "q"), ["a", "b"], multi_line=True, limit_rows=3)
    assert rows(df, "a", "b") == [("1", "x\ny"), ("2", "z"), ("3", "w")]
    with pytest.raises(ValueError):
        delimited.read_delimited(spark, str(tmp_path / "q"), ["a", "b"], multi_line=True, append_crc=True)
    assert rows(delimited.count_rows(spark, str(tmp_path / "q")), "rows", "columns") == [(4, 2)]


def test_elements_without_end_tags(spark, rows):
    page = ("<p>one<p class=x>two</p><pre>no</pre><table id=o><tr><td>a<table><tr><td>b</table></table><table>c"
            "<a href='/s'>s</a><a class=z href=/u>u<a href=\"/d\">d</a><a name=n>n</a><!-- <p> -->")
    pages = spark.createDataFrame([(1, page), (2, None), (3, "")], "page_id long, html string")
    assert rows(html.links(pages), "href", "text") == [("/d", "d"), ("/s", "s"), ("/u", "u")]
    assert [r.content for r in html.elements(pages, "p").orderBy("pos").collect()][:1] == ["one"]
    tables = [r.content for r in html.elements(pages, "table").orderBy("pos").collect()]
    assert tables[0] == "<tr><td>a<table><tr><td>b</table>" and tables[1] == "<tr><td>b" and tables[2].startswith("c<a")
    counts = html.element_counts(pages.filter("page_id = 1"), ["p", "table", "tr", "a"])
    assert rows(counts, "tag", "n") == [("a", 4), ("p", 2), ("table", 3), ("tr", 2)]


@pytest.mark.parametrize("mode, want", [
    ("KILLFILL", [(1, 1), (2, 2), (3, 2)]), ("FILE_ID", [(1, 1), (2, 2), (3, 2)]), ("PROJECT", [(2, 2), (3, 2)]),
    ("CDO_LAST_UPDATE", [(1, 1), (2, 2), (3, 2)])])
def test_publish_modes(spark, tmp_path, rows, mode, want):
    source = spark.createDataFrame([(1, 1), (2, 2), (3, 2)], "k long, file_id long").withColumn(
        "cdo_last_update", F.timestamp_seconds("k"))
    catalog = spark.createDataFrame([(2, "q")], "file_id long, project_name string")
    item = {"delivery_type": mode, "move_data": True, "project": "q", "keys": ["k"], "tie_column": "file_id",
            "tables": ["t"], "db": {"source_db": {"schema": "s"}, "target_db": {"schema": "d"}}}
    job = PublishJob(spark, item, str(tmp_path), lambda name: source, ["t"], catalog)
    for _ in range(2):
        log = job.run()
    from quayside.sources.tables import VersionedTable

    assert rows(VersionedTable(spark, job.path("t"), source.schema).read(), "k", "file_id") == want
    assert [r.status for r in log.collect()] == ["Completed", "Completed"]
    with pytest.raises(ValueError):
        PublishJob(spark, {**item, "delivery_type": "OTHER"}, str(tmp_path), lambda name: source, ["t"]).run()
