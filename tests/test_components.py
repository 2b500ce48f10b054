import random

import pytest
from pyspark.sql import functions as F

from rootweave.operators import components, mapping
from tests.brute import components as brute_components
from tests.brute import mapping as brute_mapping

EDGE = "rel_id string, id_key string"


def groups(found):
    rows = found.labels.groupBy("component_id").agg(F.collect_set("rel_id").alias("members")).collect()
    return {frozenset(r.members) for r in rows}


def random_graphs(seed, count):
    """Many small graphs side by side; every name starts with the number of its graph."""
    rng = random.Random(seed)
    edges, seeds = set(), set()
    for g in range(count):
        entities, keys = rng.randint(3, 25), rng.randint(2, 20)
        for _ in range(rng.randint(1, 2 * entities)):
            edges.add((f"{g}0{rng.randrange(entities):02d}", f"{g}k{rng.randrange(keys)}"))
        seeds |= {f"{g}0{rng.randrange(entities):02d}" for _ in range(rng.randint(0, 4))}
    return sorted(edges), sorted(seeds)


def test_random_graphs(spark, ws):
    edges, seeds = random_graphs(1, 150)
    edge_df = spark.createDataFrame(edges, EDGE)
    seed_df = spark.createDataFrame([(s,) for s in seeds], "seed_rel_id string")
    found = mapping.components_with_seeds(edge_df, seed_df, ws)
    assert groups(found) == set(brute_components(edges, seeds).values())
    assert {tuple(r) for r in mapping.assign_roots(found, seed_df).collect()} == brute_mapping(edges, seeds)

    by_rel = brute_components(edges, seeds)
    pairs = {(s, m) for s in seeds for m in by_rel[s]}
    assert {tuple(r) for r in mapping.closure_pairs(found, seed_df).collect()} == pairs

    start = ["1000", "nowhere", seeds[0]]
    reached = set().union(*[by_rel.get(s, {s}) for s in start])
    start_df = spark.createDataFrame([(s,) for s in start], "rel_id string")
    assert {r.rel_id for r in mapping.expand_component(found, start_df).collect()} == reached


def test_clashing_vertex_numbers(spark, ws):
    edges, _ = random_graphs(2, 10)
    found = components.connected_components(
        spark.createDataFrame(edges, EDGE), ws, entity_hash=lambda c: F.pmod(F.crc32(c), F.lit(7))
    )
    assert groups(found) == set(brute_components(edges).values())


def test_long_chain_and_hub_and_many_small(spark, ws):
    """A path of 2,000 entities, one identifier with a third of all rows, and small pairs."""
    chain = spark.range(2000).select(
        F.concat(F.lit("c"), "id").alias("rel_id"),
        F.explode(F.array(F.concat(F.lit("p"), "id"), F.concat(F.lit("p"), F.col("id") + 1))).alias("id_key"),
    )
    hub = spark.range(60_000).select(F.concat(F.lit("h"), "id").alias("rel_id"), F.lit("hub").alias("id_key"))
    small = spark.range(100_000).select(
        F.concat(F.lit("s"), "id").alias("rel_id"), F.concat(F.lit("q"), F.floor(F.col("id") / 2)).alias("id_key")
    )
    found = components.connected_components(chain.union(hub).union(small), ws)
    sizes = found.labels.groupBy("component_id").count().groupBy("count").agg(F.count(F.lit(1)).alias("n"))
    assert {(r["count"], r.n) for r in sizes.collect()} == {(2000, 1), (60_000, 1), (2, 50_000)}
    assert found.hot.count() == 2
    assert found.rounds < 20

    seeds = spark.createDataFrame([("h7",), ("h5",), ("c9",), ("s3",)], "seed_rel_id string")
    rows = mapping.assign_roots(found, seeds).groupBy("root_id").count().collect()
    assert {(r.root_id, r["count"]) for r in rows} == {("h5", 60_000), ("c9", 2000), ("s3", 2)}


def test_entity_with_a_third_of_all_rows(spark, ws):
    """One entity on 30,000 identifiers, each shared with one more entity."""
    star = spark.range(30_000).select(
        F.explode(F.array(F.lit("centre"), F.concat(F.lit("e"), "id"))).alias("rel_id"), F.concat(F.lit("k"), "id").alias("id_key")
    )
    found = components.connected_components(star, ws)
    assert found.labels.select("component_id").distinct().count() == 1
    assert found.entities == 30_001


def test_rounds_without_progress_raise(spark, ws, monkeypatch):
    monkeypatch.setattr(components, "contracted", lambda edges, level: edges)
    edges = [(f"e{i}", f"k{i + d}") for i in range(60) for d in (0, 1)]
    with pytest.raises(components.NotConverged):
        components.connected_components(spark.createDataFrame(edges, EDGE), ws)


def test_no_edges_at_all(spark, ws):
    seeds = spark.createDataFrame([("5",), ("6",)], "seed_rel_id string")
    found = mapping.components_with_seeds(spark.createDataFrame([], EDGE), seeds, ws)
    assert {tuple(r) for r in mapping.assign_roots(found, seeds).collect()} == {("5", "5"), ("6", "6")}
    assert found.rounds == 0


@pytest.mark.parametrize("bits", [0, 17, 34, 51, 63])
def test_rotation_can_be_turned_back(spark, bits):
    df = spark.range(-50, 50).withColumn("x", F.xxhash64("id"))
    back = components.rotate(components.rotate(F.col("x"), bits), -bits)
    assert df.filter(back != F.col("x")).count() == 0
    assert df.select(components.rotate(F.col("x"), bits)).distinct().count() == 100


def test_stars_read_one_shuffle_unless_an_identifier_is_hot(spark, ws):
    class Kept:
        """A workspace that keeps plans instead of files."""

        def stage_counted(self, df, label, **_):
            return (df, {"rows": df.count()}) if label == "hubs" else (df, {"rows": None})

    pairs = spark.range(4_000).selectExpr("CAST(id % 900 AS STRING) AS id_key", "id AS v")
    pairs = pairs.unionByName(pairs).unionByName(spark.createDataFrame([(None, 9_000)], "id_key string, v bigint"))
    hub = pairs.unionByName(spark.range(5_000, 6_000).selectExpr("'7' AS id_key", "id AS v"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plain, spread = (components.star_edges(p, 8_000, Kept())[0] for p in (pairs, hub))
        expected = {(v % 900, v) for v in range(900, 4_000)}
        assert {tuple(r) for r in plain.collect()} == expected
        assert "ReusedExchange" in plain._jdf.queryExecution().executedPlan().toString()
        assert {tuple(r) for r in spread.collect()} == expected | {(7, v) for v in range(5_000, 6_000)}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_seeds_are_marked_in_the_labels_and_not_looked_up(spark, ws, monkeypatch):
    edges = spark.createDataFrame([("1", "a"), ("2", "a"), ("3", "b"), (None, "c")], EDGE)
    seeds = spark.createDataFrame([("2",), ("2",), ("9",), (None,)], "seed_rel_id string")
    found = mapping.components_with_seeds(edges, seeds, ws)
    looked_up = mapping.assign_roots(found, seeds.select("seed_rel_id"))
    monkeypatch.setattr(mapping, "seeded_components", None)
    marked = mapping.assign_roots(found, seeds)
    assert sorted(map(tuple, marked.collect())) == sorted(map(tuple, looked_up.collect())) == [("1", "2"), ("2", "2"), ("9", "9")]
