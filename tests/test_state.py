"""What a refresh reads and writes: only what changed."""

import re

import pytest
from pyspark.sql import functions as F

from rootweave import workspace
from rootweave.plans import refresh, state
from tests.world import World


def files(spark, table):
    """File names by bucket."""
    found = {}
    for path in spark.table(table).inputFiles():
        bucket = re.search(r"bucket=(\d+)/", path)
        found.setdefault(int(bucket[1]) if bucket else None, set()).add(path)
    return found


def all_files(spark, cfg):
    return {t: files(spark, t) for t in [cfg.output, *refresh.state_tables(cfg)]}


@pytest.fixture
def world(spark, ws):
    w = World(spark, ws)
    for i in range(300):
        w.add(f"{1000 + i}", f"k{i}", "Y" if i % 3 else "N"), w.join(f"{5000 + i}", f"k{i}")
    w.refresh()
    return w


def test_untouched_buckets_keep_their_files(spark, world):
    before = all_files(spark, world.cfg)
    world.join("9000", "k7")
    assert world.refresh().changed_edges == 1
    world.check()
    after = all_files(spark, world.cfg)
    labels, log = world.cfg.state(refresh.COMPONENTS), world.cfg.state(refresh.EDGES)
    # One component of three entities, and one new row of the log.
    rewritten = [b for b in before[labels] if after[labels].get(b) != before[labels][b]]
    assert 1 <= len(rewritten) <= 3 and len(before[labels]) == state.LEAST_BUCKETS
    grown = [b for b in before[log] if after[log][b] != before[log][b]]
    assert len(grown) == 1 and before[log][grown[0]] < after[log][grown[0]]
    assert after[world.cfg.state(refresh.SEEDS)] == before[world.cfg.state(refresh.SEEDS)]


def test_a_run_without_changes_and_one_with_repeated_rows(spark, world):
    before = all_files(spark, world.cfg)
    assert world.refresh() == refresh.RunStats(0, 0, 0, 0, len(world.expected()))
    assert all_files(spark, world.cfg) == before
    world.link.append(list(world.link[0]))
    assert world.refresh() == refresh.RunStats(0, 0, 0, 0, len(world.expected()))
    after = all_files(spark, world.cfg)
    assert {t for t in after if after[t] != before[t]} == {world.cfg.state(refresh.DIGESTS)}
    assert refresh.committed_run(spark, world.cfg)


def test_a_long_log_is_rewritten_where_it_is_long(spark, world, monkeypatch):
    monkeypatch.setattr(state, "SLACK", 0)
    log = world.cfg.state(refresh.EDGES)
    first = files(spark, log)
    rows = []
    for turn in range(4):
        for row in world.link[:150]:
            row[4] = "N" if turn % 2 else "Y"
        world.refresh()
        rows.append(spark.table(log).count())
    world.check()
    assert rows[0] <= 450 + 300 and max(rows) <= 1_200 and files(spark, log) != first
    net = spark.table(log).groupBy("source_table", "rel_id", "id_key").agg(F.sum("sign").alias("n"))
    assert {r["n"] for r in net.collect()} <= {0, 1} and net.filter("n = 1").count() == 600


def test_component_numbers_are_never_issued_twice(spark, world):
    seen = {}
    for turn in range(3):
        for r in spark.table(world.cfg.state(refresh.COMPONENTS)).groupBy("component_id").agg(F.sort_array(F.collect_set("rel_id")).alias("m")).collect():
            assert seen.setdefault(r["component_id"], r["m"]) == r["m"]
        world.join(f"{1000 + turn}", f"k{turn + 40}")
        world.refresh()
    assert set(seen) == set(range(max(seen) + 1))


def test_a_run_cut_short_while_writing_state_leads_to_a_rebuild(spark, world, monkeypatch):
    world.join("9000", "k7"), world.add("9001", "k8", "Y")

    def broken(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(state, "append_buckets", broken)
        with pytest.raises(RuntimeError):
            world.refresh()
    assert refresh.committed_run(spark, world.cfg) is None
    assert world.refresh().impacted_rel_ids == 602
    world.check()


def test_a_bucket_that_loses_all_rows_is_dropped(spark, ws):
    table = f"{ws.scratch_database()}.t"
    spark.sql(f"CREATE TABLE {table} (x STRING, bucket INT) USING PARQUET PARTITIONED BY (bucket)")
    state.append_buckets(spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "x string, bucket int"), table)
    kept = files(spark, table)[3]
    state.overwrite_buckets(spark.table(table).filter("x = 'b'").withColumn("x", F.lit("B")), table, [1, 2])
    assert {tuple(r) for r in spark.table(table).collect()} == {("B", 2), ("c", 3)} and files(spark, table)[3] == kept
    assert spark.conf.get(state.OVERWRITE_SETTING).lower() == "static"


def test_logs_of_other_columns_lead_to_a_rebuild(spark, world):
    spark.sql(f"ALTER TABLE {world.cfg.state(refresh.EDGES)} ADD COLUMNS (h BIGINT)")
    world.join("9000", "k7")
    assert world.refresh().changed_edges == 601
    world.check()
    world.join("9001", "k7")
    assert world.refresh().changed_edges == 1


def test_a_first_log_is_dealt_in_slices_of_buckets(spark):
    rows = spark.range(20_000).selectExpr("CAST(id AS STRING) AS x")
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "64"}
    before = {c: spark.conf.get(c) for c in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        sizes = state.whole_log(rows.unionByName(rows), 2).groupBy(F.spark_partition_id()).count().collect()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert sum(r["count"] for r in sizes) == 20_000 and max(r["count"] for r in sizes) < 10_000 * 0.6


def test_changes_are_found_in_one_shuffle(spark, ws, monkeypatch):
    log = spark.range(3_000).selectExpr("CAST(id AS STRING) AS x")
    log = state.with_bucket(log, 4).withColumn("sign", F.lit(1))
    log = log.unionByName(log.filter("x = '7'").withColumn("sign", F.lit(-1)))
    now = spark.range(5, 3_010).selectExpr("CAST(id AS STRING) AS x")
    plans = []
    real = ws.stage_counted
    monkeypatch.setattr(ws, "stage_counted", lambda df, *a, **m: plans.append(df) or real(df, *a, **m))
    found, counted = state.changes(log, now.unionByName(now), 4, [0, 1, 2, 3], ws)
    assert (counted["added"], counted["removed"], counted["rows"]) == (11, 5, 16)
    assert {(r["x"], r["sign"]) for r in found.collect()} == {(str(i), -1) for i in range(5)} | {(str(i), 1) for i in (7, *range(3_000, 3_010))}
    assert sum(p._jdf.queryExecution().executedPlan().toString().count("hashpartitioning") for p in plans) == 1


def test_what_a_task_of_a_first_log_gets_does_not_grow_with_the_rows(spark, monkeypatch):
    monkeypatch.setattr(workspace, "ROWS_PER_DEAL", 1_000)
    for number in (10_000, 40_000):
        rows = spark.range(number).selectExpr("CAST(id AS STRING) AS x")
        log = state.whole_log(rows, 64, number)
        assert log.rdd.getNumPartitions() == number // 1_000 and log.count() == number
        assert max(r["count"] for r in log.groupBy(F.spark_partition_id()).count().collect()) < 3_500
