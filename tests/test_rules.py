import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from rootweave.functions import better_root, key_as_long, not_blank, open_ended
from rootweave.operators import checks, delta


@pytest.mark.parametrize("seeds, best", [
    (["99", "1000"], "99"), (["X1", "A7"], "A7"), (["X1", "5", "A7"], "5"), (["007"], "007"),
    (["8", "007"], "007"), (["7", "007"], "007"), (["-3", "2"], "-3"), (["99999999999999999999", "A"], "99999999999999999999"),
])
def test_better_root(spark, seeds, best):
    df = spark.createDataFrame([(s,) for s in seeds], "s string")
    assert df.agg(better_root("s").alias("best")).first().best == best


def test_key_as_long_never_fails(spark):
    df = spark.createDataFrame([("12",), ("abc",), (None,), ("",)], "k string")
    assert [r[0] for r in df.select(key_as_long("k")).collect()] == [12, None, None, None]


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date", "string"])
def test_open_ended_for_every_type(spark, kind):
    df = spark.createDataFrame(
        [("9999-12-31 00:00:00",), ("9999-12-31 23:59:59",), ("9999-12-30 23:59:59",), (None,)], "t string"
    )
    df = df.select(F.col("t"), (F.col("t").cast("timestamp_ntz").cast(kind) if kind != "string" else F.col("t")).alias("v"))
    kept = df.filter(open_ended("v", df.schema["v"].dataType)).select("t").collect()
    assert {r.t for r in kept} == {"9999-12-31 00:00:00", "9999-12-31 23:59:59"}
    assert isinstance(df.schema["t"].dataType, StringType)


def test_open_ended_reaches_the_file_reader(spark, ws):
    df = ws.stage(spark.sql("SELECT TIMESTAMP_NTZ '9999-12-31 00:00:00' AS v, 'Y' AS flag, 1 AS x"), "t")
    plan = df.filter(open_ended("v", df.schema["v"].dataType) & (F.col("flag") == "Y")).select("flag")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(v,9999-12-31T00:00)" in text and "EqualTo(flag,Y)" in text


def test_blank_keys(spark):
    keys = [None, "", "  ", " k", "k"]
    df = spark.createDataFrame([("r", k) for k in keys] + [(None, "k")], "rel_id string, id_key string")
    assert {r.id_key for r in df.filter(not_blank("rel_id", "id_key")).collect()} == {" k", "k"}


def test_checks_report_every_kind_of_problem(spark):
    pair = "rel_id string, root_id string"
    twice = spark.createDataFrame([("1", "a"), ("1", "a"), ("2", "a"), ("2", "b")], pair)
    assert checks.uniqueness(twice).first().asDict() == {"total_rows": 4, "distinct_rows": 3, "ambiguous_entities": 1}
    with pytest.raises(checks.CheckFailed):
        checks.require_unique(twice, "t")
    empty = twice.limit(0)
    assert checks.uniqueness(empty).first().asDict() == {"total_rows": 0, "distinct_rows": 0, "ambiguous_entities": 0}

    before = spark.createDataFrame([("1", "a"), ("2", "a")], pair)
    after = spark.createDataFrame([("2", "a"), ("3", "a")], pair)
    found = {tuple(r) for r in delta.pair_delta(before, after).collect()}
    assert found == {("inserted", "3", "a"), ("removed", "1", "a")}
    expected = spark.createDataFrame([("inserted", "3", "a"), ("removed", "9", "a")], "kind string, " + pair)
    problems = {tuple(r) for r in checks.delta_check(before, after, expected).collect()}
    assert problems == {("unexpected", "removed", "1", "a"), ("missing", "removed", "9", "a")}
    golden = {tuple(r) for r in checks.golden_compare(after, before).collect()}
    assert golden == {("extra", "3", "a"), ("missing", "1", "a")}
    assert checks.has_rows(before) and not checks.has_rows(empty)
