import pytest
from pyspark.sql import functions as F

from rootweave import workspace
from rootweave.sources import files, tables


@pytest.fixture
def db(ws):
    return ws.scratch_database()


def numbers(spark, n):
    return spark.range(n).select(F.col("id"), (F.col("id") * 10).alias("v"))


def ids(spark, table):
    return sorted(r.id for r in spark.table(table).collect())


def test_swap_can_read_the_table_it_replaces(spark, db):
    t = f"{db}.t"
    tables.write_table(numbers(spark, 5), t)
    tables.swap_transform(spark, t, lambda df: df.filter("id < 3"))
    assert ids(spark, t) == [0, 1, 2]
    assert not spark.catalog.tableExists(t + tables.STAGING) and not spark.catalog.tableExists(t + tables.OLD)


def test_swap_cut_short_before_and_between_the_renames(spark, db):
    t = f"{db}.t"
    tables.write_table(numbers(spark, 5), t)
    tables.stage_replacement(spark, t, numbers(spark, 2))
    tables.recover_swap(spark, t)
    assert ids(spark, t) == [0, 1, 2, 3, 4]

    tables.stage_replacement(spark, t, numbers(spark, 2))
    spark.sql(f"ALTER TABLE {t} RENAME TO {t + tables.OLD}")
    tables.recover_swap(spark, t)
    assert ids(spark, t) == [0, 1, 2, 3, 4]
    assert not spark.catalog.tableExists(t + tables.STAGING)


def test_update_keeps_type_and_rows_with_unknown_condition(spark, db):
    t = f"{db}.t"
    tables.write_table(spark.createDataFrame([(1, "a"), (2, None), (3, "b")], "id int, flag string"), t)
    tables.update_where(spark, t, "id", F.col("flag") == "a", F.lit(9_000_000_000) - 8_999_999_990)
    assert spark.table(t).schema["id"].dataType.simpleString() == "int"
    assert {tuple(r) for r in spark.table(t).collect()} == {(10, "a"), (2, None), (3, "b")}


def test_insert_if_absent_is_idempotent(spark, db):
    t = f"{db}.t"
    tables.ensure_table(spark, t, "id bigint, note string")
    row = spark.createDataFrame([(1, "first")], "id int, note string")
    for _ in range(3):
        tables.insert_if_absent(row, t, ["id"])
    assert ids(spark, t) == [1]


def test_insert_if_absent_treats_null_keys_as_equal(spark, db):
    t = f"{db}.t"
    tables.ensure_table(spark, t, "a bigint, b string, note string")
    rows = spark.createDataFrame([(None, "x", "2"), (None, "x", "1"), (1, None, None), (None, None, "z")], "a int, b string, note string")
    for _ in range(3):
        tables.insert_if_absent(rows, t, ["a", "b"])
    assert {tuple(r) for r in spark.table(t).collect()} == {(None, "x", "1"), (1, None, None), (None, None, "z")}
    assert spark.table(t).count() == 3


def test_ingest_refuses_two_files_for_one_table(spark, db, tmp_path):
    for name in ("A-b.csv", "a_b.csv"):
        (tmp_path / name).write_text("x\ty\n1\t2\n")
    with pytest.raises(ValueError, match="a_b"):
        files.ingest_folder(spark, str(tmp_path), db)
    assert not spark.catalog.tableExists(f"{db}.a_b")


@pytest.mark.parametrize("text", ["y\tx\n7\t1\n", "x\ty\n1\tbad\n"])
def test_read_with_schema_refuses_other_headers_and_bad_values(spark, tmp_path, text):
    (tmp_path / "t.csv").write_text(text)
    with pytest.raises(Exception):
        files.read_delimited(spark, str(tmp_path / "t.csv"), "x string, y int").collect()


def test_baseline_reset(spark, db):
    t, state = f"{db}.t", f"{db}.state"
    tables.write_table(numbers(spark, 3), t)
    tables.write_table(numbers(spark, 3), state)
    tables.reset_to_baseline(spark, [t], [])
    tables.swap_transform(spark, t, lambda df: df.limit(0))
    tables.reset_to_baseline(spark, [t], [state])
    assert ids(spark, t) == [0, 1, 2]
    assert not spark.catalog.tableExists(state)
    tables.drop_database(spark, db)
    assert not spark.catalog.databaseExists(db)


def test_ingest_infers_types_and_normalises_names(spark, db, tmp_path):
    (tmp_path / "My Table-1.csv").write_text(
        "rel_id\tvalid_to\tkey\n1\t9999-12-31 00:00:00.0000000\ta\n2\t2021-11-11 11:11:11.1234567\tb\n"
    )
    assert files.ingest_folder(spark, str(tmp_path), db) == [f"{db}.my_table_1"]
    df = spark.table(f"{db}.my_table_1")
    assert dict(df.dtypes) == {"rel_id": "int", "valid_to": "timestamp", "key": "string"}
    shown = {r.valid_to for r in files.preview(df, ["rel_id"]).collect()}
    assert shown == {"9999-12-31 00:00:00", "2021-11-11 11:11:11.123456"}
    assert [tuple(r) for r in files.load_report(spark, [f"{db}.my_table_1"]).collect()] == [("my_table_1", 2)]


def test_ingest_refuses_missing_input(spark, db, tmp_path):
    with pytest.raises(FileNotFoundError, match="does not exist"):
        files.ingest_folder(spark, str(tmp_path / "nowhere"), db)
    with pytest.raises(FileNotFoundError, match="no \\*.csv"):
        files.ingest_folder(spark, str(tmp_path), db)


def test_workspace_widens_shuffles_and_cleans_up(spark):
    setting = workspace.PARTITIONS_SETTING
    before = spark.conf.get(setting)
    with workspace.Workspace(spark) as ws:
        ws.stage(numbers(spark, 5), "t")
        ws.expect(10)
        assert spark.conf.get(setting) == before
        ws.expect(100 * workspace.ROWS_PER_TASK)
        ws.expect(50 * workspace.ROWS_PER_TASK)
        assert spark.conf.get(setting) == "100"
        path, fs = ws._hadoop_path(ws.path)
        assert fs.exists(path)
    assert spark.conf.get(setting) == before
    assert not fs.exists(path)


def test_counting_while_writing_nothing(spark, ws):
    staged, seen = ws.stage_counted(numbers(spark, 5).filter("id > 9"), "t", even=F.count_if(F.col("id") % 2 == 0))
    assert seen == {"rows": 0, "even": 0} and staged.isEmpty()
