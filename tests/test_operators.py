"""Operators against brute force on small data, with the large-table paths forced."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from quayside.operators import catalog as cat
from quayside.operators import deliver, mapping, merge, numbering, quality, reshape, skew

SLOW = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def frame(spark, data, ddl):
    return spark.createDataFrame(data, ddl)


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows on one key, some keys missing."""
    rng = random.Random(7)
    rows = [(i, 1 if i % 3 == 0 else (None if i % 17 == 0 else rng.randrange(2, 60))) for i in range(3000)]
    return rows, spark.createDataFrame(rows, "id long, k long").repartition(6).cache()


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("limit", [0, 10**6])
def test_lookup_join(spark, skewed, rows, how, limit):
    data, df = skewed
    table = {k: f"n{k}" for k in range(1, 60, 2)}
    lookup = frame(spark, list(table.items()), "k long, name string")
    got = rows(skew.lookup_join(df, lookup, ["k"], how, broadcast_rows=limit, share=20), "id", "k",
               *(["name"] if how in ("inner", "left") else []))
    if how == "inner":
        want = [(i, k, table[k]) for i, k in data if k in table]
    elif how == "left":
        want = [(i, k, table.get(k)) for i, k in data]
    elif how == "left_semi":
        want = [(i, k) for i, k in data if k in table]
    else:
        want = [(i, k) for i, k in data if k not in table]
    assert got == sorted(want, key=repr)


def test_hot_keys_are_few(spark, skewed, rows):
    _, df = skewed
    assert rows(skew.hot_keys(df.filter("k is not null"), ["k"], share=5)) == [(1,)]


def test_number_rows_matches_row_number(spark, skewed, rows):
    data, df = skewed
    got = rows(numbering.number_rows(df, [F.desc("id")], ["k"]), "k", "id", "position")
    groups = {}
    for i, k in data:
        groups.setdefault(k, []).append(i)
    want = [(k, i, n + 1) for k, ids in groups.items() for n, i in enumerate(sorted(ids, reverse=True))]
    assert got == sorted(want, key=repr)


def test_number_rows_splits_a_hot_group(spark, monkeypatch):
    """The rows of one key are numbered by several tasks."""
    seen = []
    keep = numbering.durable
    monkeypatch.setattr(numbering, "durable", lambda df, label: seen.append(keep(df, label)) or seen[-1])
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        df = spark.range(4000).withColumn("k", F.lit(1))
        out = numbering.number_rows(df, ["id"], ["k"])
        assert out.filter("position <> id + 1").count() == 0
        assert seen[0].select(F.shiftright("_slot", 33)).distinct().count() >= 6
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "2")


def test_block_ranges(spark, rows):
    df = frame(spark, [("a", 3), ("a", 10), ("b", 5), ("a", 7)], "sheet string, row int")
    got = rows(numbering.block_ranges(df, "row", ["row"], ["sheet"]))
    assert got == sorted([("a", 1, 3, 6), ("a", 2, 7, 9), ("a", 3, 10, None), ("b", 1, 5, None)], key=repr)


def merged_by_hand(target, staging, check=True):
    out = {}
    for k, v in target.items():
        if k not in staging:
            out[k] = (*v, "target_only")
        elif not check or staging[k][0] != v[0]:
            out[k] = (*staging[k], "update")
        else:
            out[k] = (*v, "unchanged")
    out |= {k: (*v, "insert") for k, v in staging.items() if k not in target}
    return sorted([(k, *v) for k, v in out.items()], key=repr)


ROWS = st.dictionaries(st.integers(0, 12), st.tuples(st.sampled_from(["x", "y", None]), st.just(1)), max_size=10)


@SLOW
@given(target=ROWS, staging=ROWS, check=st.booleans(), broadcast=st.booleans())
def test_merge_rows(spark, target, staging, check, broadcast):
    staging = {k: (v[0], 2) for k, v in staging.items()}
    ddl = "k long, v string, file_id long"
    t = frame(spark, [(k, *v) for k, v in target.items()], ddl)
    s = frame(spark, [(k, *v) for k, v in staging.items()], ddl)
    old = merge.fits_broadcast
    merge.fits_broadcast = lambda df, rows=0: broadcast
    try:
        once = merge.merge_rows(t, s, ["k"], check)
        got = sorted((tuple(r) for r in once.collect()), key=repr)
        assert got == merged_by_hand(target, staging, check)
        twice = merge.merge_rows(once.drop("action"), s, ["k"], check).drop("action")
        assert sorted(map(tuple, twice.collect()), key=repr) == sorted(map(tuple, once.drop("action").collect()), key=repr)
    finally:
        merge.fits_broadcast = old


def test_merge_refuses_repeated_keys(spark):
    t = frame(spark, [(1, "a", 1)], "k long, v string, file_id long")
    s = frame(spark, [(1, "b", 2), (1, "c", 3)], "k long, v string, file_id long")
    with pytest.raises(PySparkException, match="not unique"):
        merge.merge_rows(t, s, ["k"]).collect()
    won = merge.merge_rows(t, s, ["k"], dedupe_by="file_id").collect()
    assert [tuple(r) for r in won] == [(1, "c", 3, "update")]


def test_unchanged_rows_keep_their_file(spark):
    ddl = "k long, v string, file_id long, cdo_last_update string"
    t = frame(spark, [(1, "a", 1, "old"), (2, "b", 1, "old")], ddl)
    s = frame(spark, [(1, "a", 2, "new"), (2, "c", 2, "new")], ddl)
    got = {r.k: tuple(r) for r in merge.merge_rows(t, s, ["k"]).collect()}
    assert got == {1: (1, "a", 1, "old", "unchanged"), 2: (2, "c", 2, "new", "update")}


def test_insert_ignore_set_where_add_column(spark, rows):
    t = frame(spark, [(1, "a")], "k long, v string")
    s = frame(spark, [(1, "z"), (2, "b"), (2, "b")], "k long, v string")
    assert rows(merge.insert_ignore(t, s, ["k"])) == [(2, "b")]
    assert rows(merge.set_where(s, "k", F.lit(9), F.col("v") == "z"), "k") == [(2,), (2,), (9,)]
    wide = merge.add_column(t, "crc", "uuid")
    assert wide.schema["crc"].dataType.simpleString() == "string"
    with pytest.raises(ValueError):
        merge.add_column(t, "x", "Blob")


def files_frame(spark, data):
    return frame(
        spark, data,
        "file_id long, project_name string, crc string, file_process_state string, parent_file_id long,"
        " file_path string, file_name string, duplicate_file boolean",
    )


def test_duplicates_of_a_large_group_of_copies(spark, rows, monkeypatch):
    """A third of all files are copies of one file; no pair of copies is ever formed."""
    rng = random.Random(3)
    data = []
    for i in range(900):
        crc = "same" if i % 3 == 0 else f"c{rng.randrange(500)}"
        state = rng.choice(["Processed", "RAW", "FAILED"])
        data.append((i, rng.choice("pq"), crc, state, 0, "/d", f"f{i}", False))
    df = files_frame(spark, data)
    done = {}
    for r in data:
        if r[3] == "Processed":
            done.setdefault((r[1], r[2]), set()).add(r[0])
    want = [(r[0],) for r in data if done.get((r[1], r[2]), set()) - {r[0]}]
    assert rows(cat.duplicate_files(df), "file_id") == sorted(want, key=repr)
    plan = cat.duplicate_files(df)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_finished_imports(spark, rows):
    data = [
        (1, "p", "a", "Processed", 0, "/d", "z1", False),
        (2, "p", "b", "Processed", 1, "/d", "m1", False),
        (3, "p", "c", "FAILED", 1, "/d", "m2", True),     # duplicate members do not count
        (4, "p", "d", "Processed", 0, "/d", "z2", False),
        (5, "p", "e", "RAW", 4, "/d", "m3", False),
        (6, "p", "f", "FAILED", 0, "/d", "z3", False),
    ]
    df = files_frame(spark, data)
    assert rows(cat.finished_imports(df), "file_id") == [(1,)]
    assert rows(cat.finished_children(df), "file_id") == [(2,), (3,)]


def test_first_match_order_and_case(spark, rows):
    df = frame(spark, [("/in/A_Risk.CSV",), ("/in/other.csv",), ("/in/x.txt",)], "path string")
    got = rows(df.select("path", mapping.first_match(F.col("path"), [".*risk.*.csv$", ".*csv"]).alias("m")))
    assert got == sorted([("/in/A_Risk.CSV", 0), ("/in/other.csv", 1), ("/in/x.txt", None)], key=repr)
    strict = rows(df.select(mapping.first_match(F.col("path"), [".*risk"], ignore_case=False).alias("m")))
    assert strict == [(None,), (None,), (None,)]
    # a pattern is anchored at the start only
    assert rows(df.select(mapping.first_match(F.col("path"), ["other"]).alias("m"))) == [(None,)] * 3
    plan = mapping.map_files(df, F.col("path"), ["a", "b"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_named_groups_are_refused(spark):
    with pytest.raises(ValueError):
        mapping.first_match(F.lit("x"), ["(?P<year>.*)"])


def test_resets(spark, rows):
    df = frame(
        spark,
        [(1, "FAILED", "CSV", True, True), (2, "FAILED", "ZIP", False, True), (3, "Processed", "DATA", True, False),
         (4, "RAW", "CSV", True, True)],
        "id long, file_process_state string, file_type string, reprocess boolean, duplicate_file boolean",
    )
    def raw(option, where=None):
        out = cat.reset_files(df, option, where)
        return [r[0] for r in rows(out.filter("file_process_state = 'RAW' and not duplicate_file"), "id")]
    assert raw("FAILED") == [1]
    assert raw("ALL") == [1, 2, 3, 4]
    assert raw("RAW") == [4]
    assert raw("DATA") == [1, 3, 4]
    assert raw("DATA", F.col("id") > 1) == [3, 4]
    with pytest.raises(ValueError):
        cat.reset_files(df, "SOME")


def test_dictionary_ids_stay(spark, rows):
    df = frame(spark, [("F", "x"), ("O", None)], "status string, kind string")
    first = reshape.extend_dictionary(
        reshape.empty_dictionary(df), reshape.lookup_values(df, {"status": "s", "kind": "k"}, {"stats": ["m1"]}))
    more = frame(spark, [("A", "x"), ("F", "y")], "status string, kind string")
    second = reshape.extend_dictionary(first, reshape.lookup_values(more, {"status": "s", "kind": "k"}))
    old = {(r.type, r.name): r.id for r in first.collect()}
    new = {(r.type, r.name): r.id for r in second.collect()}
    assert old == {("k", "x"): 1, ("s", "F"): 2, ("s", "O"): 3, ("stats", "m1"): 4}
    assert new == old | {("k", "y"): 5, ("s", "A"): 6}
    coded = reshape.encode(more, second, {"status": "s", "kind": "k"})
    assert rows(coded, "status_id", "kind_id") == [(2, 5), (6, 1)]


def test_unpivot_keeps_or_drops_nulls(spark, rows):
    df = frame(spark, [(1, 2.0, None)], "id long, m_a double, m_b double")
    assert rows(reshape.unpivot(df, "m_")) == [(1, "m_a", 2.0)]
    assert len(rows(reshape.unpivot(df, "m_", keep_nulls=True))) == 2
    assert reshape.columns_like(["am_a", "m_a"], "m_") == ["m_a"]
    tagged = reshape.unpivot_tables({"seq1": df, "seq2": df, "other": df}, "2018", "seq", "m_a")
    assert rows(tagged, "year", "table_name", "col_name") == [("2018", "seq1", "m_a"), ("2018", "seq2", "m_a")]


def test_batches_are_typed_and_null_safe(spark, rows):
    df = frame(spark, [("it's",), (None,)], "c string")
    plan = deliver.plan_batches(df, "s.t", "p.t", "COLUMN", "c")
    assert sorted(r.src_sql for r in plan.collect()) == [
        "select * from s.t where c IS NULL", "select * from s.t where c='it''s'"]
    again = deliver.new_batches(plan, plan)
    assert again.isEmpty()
    with pytest.raises(ValueError):
        deliver.plan_batches(df, "s.t", "p.t", "RANGE")


@SLOW
@given(a=st.lists(st.integers(0, 9), max_size=20), b=st.lists(st.integers(0, 9), max_size=20))
def test_delivered_delta_leaves_nothing(spark, a, b):
    src = frame(spark, [(x, i) for i, x in enumerate(a)], "file_id long, v long")
    trg = frame(spark, [(x, i) for i, x in enumerate(b)], "file_id long, v long")
    moved = deliver.deliver_file_id(src, trg)
    assert sorted(r.file_id for r in moved.collect()) == sorted(x for x in a if x not in b)
    assert deliver.deliver_file_id(src, trg.unionByName(moved)).isEmpty()


def test_mismatched_batch_stops(spark):
    dumped = frame(spark, [("a",), ("a",), ("b",)], "k string")
    loaded = frame(spark, [("a",), ("b",)], "k string")
    log = deliver.batch_log(dumped, loaded, dumped, "k")
    assert {r.k: r.status for r in log.collect()} == {"a": "Failed", "b": "Completed"}
    with pytest.raises(ValueError, match="do not match"):
        deliver.require_complete(log)


def test_rules(spark, rows):
    df = frame(spark, [(1, "Yes"), (2, None), (3, "maybe")], "id long, answer string")
    def broken(ok):
        return [r[1] for r in rows(quality.violations(df, "id", [(1, "answer", ok)]))]
    assert broken("yes;no") == [3]          # a missing value breaks no list
    assert broken("Yes") == [1, 3]          # the list is not lower-cased
    assert broken("yes;NULL") == [3]
    assert broken("NULL") == [1, 3]
    plan = quality.violations(df, "id", [(1, "answer", "yes"), (2, "answer", "no")])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Scan") == 1 and "Exchange" not in text


def test_redaction_keeps_null(spark, rows):
    df = frame(spark, [("a", 1, "x"), (None, 2, "y")], "name string, n int, other string")
    out = quality.redact(df, {"name": "Hash", "n": "Increment", "gone": "drop"})
    assert rows(out) == sorted([("0cc175b9c0f1b6a831c399e269772661", 2), (None, 3)], key=repr)


def test_profiles(spark, rows):
    df = frame(spark, [("abc", None), ("a", None)], "c string, d string")
    assert rows(quality.profile_lengths(df)) == [("c", 3), ("d", None)]
    stats = {r.column_name: r for r in quality.column_stats(df).collect()}
    assert stats["c"].is_key and stats["c"].distinct_count == 2
    assert stats["d"].null_count == 2 and not stats["d"].is_key
    assert quality.is_key(df, ["c"]) and not quality.is_key(df, ["d"])


def test_reconcile(spark, rows):
    recorded = frame(spark, [("t", 5), ("t", 2), ("gone", 1)], "table string, rows long")
    present = frame(spark, [("t", 6), ("new", 3)], "table string, rows long")
    assert rows(quality.reconcile(recorded, present, "table")) == [
        ("gone", 1, 0, -1), ("new", 0, 3, 3), ("t", 7, 6, -1)]


def test_latest_state_keeps_message(spark, rows):
    ev = frame(spark, [(1, "RAW", 1, None), (1, "FAILED", 2, "boom"), (1, "RAW", 3, None)],
               "id long, state string, seq long, msg string")
    assert rows(cat.latest_state(ev, "id", "state", ["seq"], "msg")) == [(1, "RAW", "boom", 3)]
    assert rows(cat.latest(ev, ["id"], ["seq"]), "state") == [("RAW",)]


def test_discard_removes_stored_tables_only(spark, tmp_path):
    from quayside.session import discard, durable

    kept, gone = durable(spark.range(3), "kept"), durable(spark.range(5), "gone")
    spark.range(2).write.parquet(str(tmp_path / "own"))
    own = spark.read.parquet(str(tmp_path / "own"))
    discard(gone)
    discard(own)
    assert kept.count() == 3 and own.count() == 2
    with pytest.raises(Exception, match="(?i)exist"):
        gone.collect()
