"""Updates by file, versions, rejected lines, bags, numbers and resumed rounds."""

import pytest
from pyspark.sql import functions as F

from rootweave.operators import components, delta, hops, mapping, numbering
from rootweave.sources import files, tables
from rootweave.sources.versions import Versions
from rootweave.workspace import Workspace


def test_an_update_rewrites_the_files_it_hits(spark, ws):
    table = f"{ws.scratch_database()}.t"
    spark.range(0, 400, 1, 4).selectExpr("id", "id % 10 AS x").write.saveAsTable(table)
    before = set(spark.table(table).inputFiles())
    assert len(before) == 4
    assert tables.update_where(spark, table, "x", F.col("id") == 150, F.lit(99)) == 1
    after = set(spark.table(table).inputFiles())
    assert len(before & after) == 3
    assert tables.update_where(spark, table, "x", F.col("id") < 0, F.lit(99)) == 0
    assert set(spark.table(table).inputFiles()) == after
    rows = {r["id"]: r["x"] for r in spark.table(table).collect()}
    assert rows == {i: 99 if i == 150 else i % 10 for i in range(400)}
    assert tables.update_where(spark, table, "x", F.lit(True), F.lit("7")) == 4
    assert spark.table(table).filter("x = 7").count() == 400


@pytest.mark.parametrize("announced", [False, True])
def test_an_update_cut_short(spark, ws, monkeypatch, announced):
    table = f"{ws.scratch_database()}.t"
    spark.range(0, 100, 1, 2).selectExpr("id", "0 AS x").write.saveAsTable(table)

    def broken(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(tables.Folder, "move" if announced else "save", broken)
        with pytest.raises(RuntimeError):
            tables.update_where(spark, table, "x", F.col("id") < 10, F.lit(1))
    tables.recover_update(spark, table)
    spark.catalog.refreshTable(table)
    assert spark.table(table).count() == 100 and spark.table(table).filter("x = 1").count() == (10 if announced else 0)


def test_a_partitioned_table_is_updated_as_a_whole(spark, ws):
    table = f"{ws.scratch_database()}.t"
    spark.range(100).selectExpr("id", "0 AS x", "id % 3 AS p").write.partitionBy("p").saveAsTable(table)
    tables.update_where(spark, table, "x", F.col("p") == 1, F.lit(1))
    assert spark.table(table).filter("x = 1 AND p = 1").count() == 33 and spark.table(table).count() == 100


def test_versions(spark, ws, monkeypatch):
    v = Versions(spark, ws.scratch_database(), f"{ws.path}/v")
    read = lambda t: sorted(r[0] for r in spark.table(f"{v.database}.{t}").collect())
    assert v.current() is None
    first = v.replace({"a": spark.range(3), "b": spark.range(5)})
    parts = set(spark.table(f"{v.database}.a").inputFiles())
    second = v.replace({"a": spark.table(f"{v.database}.a").filter("id > 0")})
    assert read("a") == [1, 2] and read("b") == [0, 1, 2, 3, 4]
    v.switch(first)
    assert read("a") == [0, 1, 2] and set(spark.table(f"{v.database}.a").inputFiles()) == parts
    # Cut short between two tables: the catalog is behind, the version is not.
    with monkeypatch.context() as patch:
        patch.setattr(Versions, "recover", lambda self: None)
        third = v.replace({"a": spark.range(1), "b": spark.range(1)})
    assert v.current() == third and read("a") == [0, 1, 2]
    Versions(spark, v.database, f"{ws.path}/v").recover()
    assert read("a") == [0] and read("b") == [0]
    with pytest.raises(ValueError):
        v.forget(third)
    v.forget(second)
    v.switch(first)
    assert read("a") == [0, 1, 2]
    with pytest.raises(ValueError):
        v.switch(second)
    fourth = v.replace({"c": spark.range(2)})
    v.switch(first)
    assert not spark.catalog.tableExists(f"{v.database}.c")
    v.switch(fourth)
    assert read("c") == [0, 1]


def test_rejected_lines(spark, ws, tmp_path):
    (tmp_path / "One.csv").write_text("k\tname\n1\ta\nx\tb\n3\n4\td\te\n5\te\n\t\n")
    (tmp_path / "two.csv").write_text("k\tname\n")
    db = ws.scratch_database()
    schemas = {"one": "k BIGINT, name STRING", "two": "k BIGINT, name STRING"}
    report = {r["table_name"]: (r["loaded"], r["rejected"]) for r in files.ingest_with_rejects(spark, str(tmp_path), db, schemas, ws).collect()}
    assert report == {"one": (2, 3)}  # a file without lines has no row
    assert {tuple(r) for r in spark.table(f"{db}.one").collect()} == {(1, "a"), (5, "e")}
    assert {r["line"] for r in spark.table(f"{db}.one{files.REJECTS}").collect()} == {"x\tb", "3", "4\td\te"}
    assert spark.table(f"{db}.two").count() == 0
    with pytest.raises(ValueError):
        files.ingest_with_rejects(spark, str(tmp_path), db, {"one": "k BIGINT, name STRING"}, ws)


def test_bags(spark, monkeypatch):
    monkeypatch.setattr(delta, "REPEAT", 3)
    before = spark.createDataFrame([(1, None)] * 2 + [(2, "x")] * 11 + [(3, "y")], "a int, b string")
    after = spark.createDataFrame([(1, None)] * 9 + [(2, "x")] + [(3, "y")], "a int, b string")
    found = sorted((r["kind"], r["a"], r["b"]) for r in delta.bag_delta(before, after).collect())
    assert found == [("inserted", 1, None)] * 7 + [("removed", 2, "x")] * 10
    plan = delta.bag_delta(before.filter("a > 0"), after)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") == 2


def test_dense_numbers(spark, ws):
    rows = spark.createDataFrame([(f"n{i % 700:03d}",) for i in range(1_000)], "name string")
    numbered, n = numbering.dense_numbers(rows.distinct(), ["name"], ws, start=5)
    assert n == 700 and {r["name"]: r["v"] for r in numbered.collect()} == {f"n{i:03d}": i + 5 for i in range(700)}
    again = sorted(r["v"] for r in numbering.dense_numbers(rows, ["name"], ws)[0].collect())
    assert again == list(range(1_000))
    assert numbering.dense_numbers(rows.limit(0), ["name"], ws)[1] == 0


def test_bitmaps_beyond_one_slot(spark, ws):
    numbered = spark.range(1, 70_001).selectExpr("CAST(id AS STRING) AS seed_rel_id", "id AS v")
    edges = numbered.selectExpr("'s' AS source_table", "seed_rel_id AS rel_id", "'all' AS id_key").unionByName(
        spark.createDataFrame([("s", "e", "all"), ("s", "f", "none")], "source_table string, rel_id string, id_key string"))
    keys = hops.key_bitmaps(numbered, edges)
    assert keys.count() == 3
    reached = hops.entity_bitmaps(keys, edges.filter("rel_id IN ('e', 'f')"))
    assert [tuple(r) for r in hops.count_seeds(reached).collect()] == [("e", 70_000)]
    listed = hops.listed_seeds(reached, numbered)
    assert listed.count() == 70_000 and listed.select("seed_rel_id").distinct().count() == 70_000


def test_bitmaps_of_scattered_seeds_are_as_short_as_the_seeds(spark, ws):
    numbered = spark.range(1, 200).selectExpr("CAST(id AS STRING) AS seed_rel_id", "id * 997 AS v")
    edges = numbered.selectExpr("'s' AS source_table", "seed_rel_id AS rel_id", "CAST(v % 80 AS STRING) AS id_key")
    keys = hops.key_bitmaps(numbered, edges.unionByName(edges))
    assert keys.filter(F.length(F.to_json(F.struct("seeds"))) > 500).isEmpty()
    reached = hops.entity_bitmaps(keys, edges)
    groups = {}
    for rel, key in edges.select("rel_id", "id_key").collect():
        groups.setdefault(key, []).append(rel)
    pairs = {(x, y) for g in groups.values() for x in g for y in g}
    assert sorted(tuple(r) for r in hops.listed_seeds(reached, numbered).collect()) == sorted(pairs)
    assert {tuple(r) for r in hops.count_seeds(reached).collect()} == {(x, len(g)) for g in groups.values() for x in g}


def test_a_closure_is_counted_without_its_pairs(spark, ws):
    edges = spark.createDataFrame([("a", "1"), ("b", "1"), ("c", "2"), ("d", "2"), ("e", "2")], "rel_id string, id_key string")
    seeds = spark.createDataFrame([("a",), ("c",), ("d",), ("x",)], "seed_rel_id string")
    found = mapping.closure(mapping.components_with_seeds(edges, seeds, ws), seeds)
    assert {tuple(r) for r in found.reached().collect()} == {("a", 2), ("c", 3), ("d", 3), ("x", 1)}
    assert sum(r["n_pairs"] for r in found.sizes().collect()) == found.pairs().count() == 9
    asked = spark.createDataFrame([("a", "b"), ("a", "c"), ("x", "x"), ("b", "a"), ("x", None)], "seed_rel_id string, rel_id string")
    assert {(r[0], r[1]) for r in found.holds(asked).filter("reached").collect()} == {("a", "b"), ("x", "x")}


def test_a_contraction_goes_on_after_its_last_round(spark, monkeypatch):
    path = spark.range(1, 400).selectExpr("CAST(id AS STRING) AS id").selectExpr("id AS rel_id", "id AS id_key").unionByName(
        spark.range(2, 400).selectExpr("CAST(id AS STRING) AS rel_id", "CAST(id - 1 AS STRING) AS id_key"))
    done = []
    real = components.pointers

    def counted(edges, turn):
        done.append(turn)
        if len(done) == 3:
            raise RuntimeError("lost")
        return real(edges, turn)

    monkeypatch.setattr(components, "pointers", counted)
    with pytest.raises(RuntimeError):
        with Workspace(spark, name="resumed") as first:
            components.connected_components(path, first)
    with Workspace(spark, name="resumed") as second:
        found = components.connected_components(path, second)
        assert found.labels.select("component_id").distinct().count() == 1 and found.labels.count() == 399
        assert found.rounds == len(done) - 1 and done[3] == 17  # the third round is the first one done anew
    with Workspace(spark, name="resumed") as third:
        assert not components.Rounds(third, {"rows": 0, "low": 0, "high": 0}).folder.names("round-*.json")
    # Other edges under the same name start afresh.
    monkeypatch.setattr(components, "pointers", real)
    fourth = Workspace(spark, name="resumed")
    components.connected_components(path.filter("rel_id < '2'"), fourth)
    other = components.connected_components(path, fourth)
    assert other.labels.select("component_id").distinct().count() == 1
    fourth.close()
