import pytest
from pyspark.sql import functions as F

from rootweave.operators import skew


@pytest.fixture(scope="module")
def sides(spark):
    big = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 500).alias("k"), F.col("id").alias("x")
    )
    other = spark.range(0, 400, 1).select(F.col("id").alias("k"), (F.col("id") * 2).alias("y"))
    return big, other.union(other.filter("k < 5").withColumn("y", F.col("y") + 1))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_spread_join_equals_plain_join(sides, how):
    big, other = sides
    hot = skew.hot_keys(big, "k", big.count())
    assert [r.k for r in hot.collect()] == [0]
    plain = big.join(other, "k", how)
    spread = skew.skew_join(big, other, "k", hot, how)
    assert spread.columns == plain.columns
    assert spread.exceptAll(plain).isEmpty() and plain.exceptAll(spread).isEmpty()


def test_rows_of_a_hot_key_go_to_many_tasks(sides):
    big, other = sides
    joined = skew.skew_join(big, other.dropDuplicates(["k"]), "k", skew.hot_keys(big, "k", big.count()))
    spark = big.sparkSession
    before = {c: spark.conf.get(c) for c in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tasks = joined.filter("k = 0").select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert len(tasks) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert max(r["count"] for r in tasks) < 0.5 * sum(r["count"] for r in tasks)


@pytest.mark.parametrize("limit", [skew.BROADCAST_ROWS, 0])
def test_semi_and_anti_join_on_both_paths(sides, ws, monkeypatch, limit):
    monkeypatch.setattr(skew, "BROADCAST_ROWS", limit)
    big, other = sides
    keys = skew.stage_keys(other.select("k"), ws, "keys")
    assert keys.rows == 400
    inside, outside = skew.semi_join(big, keys, "k"), skew.anti_join(big, keys, "k")
    assert inside.filter("k >= 400").isEmpty() and outside.filter("k < 400").isEmpty()
    assert inside.count() + outside.count() == 20_000


def test_hot_keys_are_found_without_shuffling_rows(sides):
    big, _ = sides
    text = big.select(F.concat(F.lit("k"), "k").alias("k")).unionByName(big.limit(900).select(F.lit(None).cast("string").alias("k")))
    for df, key in ((big, 0), (text, "k0")):
        hot = skew.hot_keys(df, "k", 20_000)
        assert "hashpartitioning" not in hot._jdf.queryExecution().executedPlan().toString()
        assert [r.k for r in hot.collect()] == [key]
    assert skew.hot_keys(big.filter("k < 0"), "k", 0).isEmpty()


def test_rows_that_are_certainly_not_in_a_long_list_are_not_shuffled(spark, ws, monkeypatch):
    monkeypatch.setattr(skew, "BROADCAST_ROWS", 0)
    big = spark.range(40_000).select(F.when(F.col("id") % 9 > 0, F.col("id").cast("string")).alias("k"), "id")
    keys = skew.stage_keys(spark.range(0, 40_000, 40).select(F.col("id").cast("string").alias("k")), ws, "keys")
    spread = []
    plain = skew.skew_join
    monkeypatch.setattr(skew, "skew_join", lambda rows, *rest: spread.append(rows.count()) or plain(rows, *rest))
    inside, outside = skew.semi_join(big, keys, "k"), skew.anti_join(big, keys, "k")
    wanted = {i for i in range(0, 40_000, 40) if i % 9}
    assert {r.id for r in inside.collect()} == wanted
    left = [r.id for r in outside.collect()]
    assert len(left) == 40_000 - len(wanted) and not wanted & set(left)
    assert max(spread) < 10_000


def test_keys_of_another_type_than_the_list_are_found(spark, ws, monkeypatch):
    monkeypatch.setattr(skew, "BROADCAST_ROWS", 0)
    keys = skew.stage_keys(spark.range(5).selectExpr("CAST(id AS INT) AS k"), ws, "keys")
    assert skew.semi_join(spark.range(10).withColumnRenamed("id", "k"), keys, "k").count() == 5


def test_a_full_filter_loses_no_row(spark, ws, monkeypatch):
    monkeypatch.setattr(skew, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(skew, "MOST_WORDS", 1)
    keys = skew.stage_keys(spark.range(500).withColumnRenamed("id", "k"), ws, "keys")
    big = spark.range(1_000).withColumnRenamed("id", "k")
    assert skew.semi_join(big, keys, "k").count() == 500 and skew.anti_join(big, keys, "k").count() == 500
