"""The graph questions: edges, seeds, closures, components and full mappings."""

from __future__ import annotations

from pyspark.sql import functions as F

from rootweave.operators import checks, components, edges, mapping, numbering
from rootweave.workspace import Workspace
from workload import oracles as sql
from workload.views import BEFORE, NOW, config, history_tables


def solve(spark, sf_dir, scope, state=NOW):
    """(components, seeds) of one state, staged."""
    tables, cfg, ws = history_tables(spark, sf_dir, state), config(scope), Workspace(spark)
    seeds = ws.stage(edges.active_seeds(tables, cfg), "seeds")
    return mapping.components_with_seeds(edges.edge_rows(tables, cfg), seeds, ws), seeds


def mapped(spark, sf_dir, scope, state=NOW):
    tables, cfg = history_tables(spark, sf_dir, state), config(scope)
    return mapping.full_mapping(edges.edge_rows(tables, cfg), edges.active_seeds(tables, cfg), Workspace(spark))


def active_seeds(spark, sf_dir):
    return edges.active_seeds(history_tables(spark, sf_dir), config("current"))


def edges_history(spark, sf_dir):
    return edges.build_edges(history_tables(spark, sf_dir), config("history"))


def edges_current(spark, sf_dir):
    return edges.build_edges(history_tables(spark, sf_dir), config("current"))


def edges_untagged(spark, sf_dir):
    return edges.untagged(edges.edge_rows(history_tables(spark, sf_dir), config("current")))


def closure_pairs(spark, sf_dir):
    return mapping.closure_pairs(*solve(spark, sf_dir, "current"))


def closure_reached(spark, sf_dir):
    """How many entities each seed reaches, from the factorised closure."""
    return mapping.closure(*solve(spark, sf_dir, "current")).reached()


def closure_holds(spark, sf_dir):
    """For every seed and the entity of the next order number: does the one reach the other?"""
    found, seeds = solve(spark, sf_dir, "current")
    asked = seeds.select("seed_rel_id", (F.col("seed_rel_id").cast("bigint") + 1).cast("string").alias("rel_id"))
    return mapping.closure(found, seeds).holds(asked)


def vertex_numbers(spark, sf_dir):
    """Numbers without gaps for all entities with an edge, in their order."""
    e = edges.edge_rows(history_tables(spark, sf_dir), config("history"))
    return numbering.dense_numbers(e.select("rel_id").distinct(), ["rel_id"], Workspace(spark))[0]


def expand_component(spark, sf_dir):
    """Everything reachable from the entities with an open, flagged-off register row."""
    found, _ = solve(spark, sf_dir, "current")
    register = history_tables(spark, sf_dir)["register"]
    start = register.filter("active_f = 'N' AND valid_from < TIMESTAMP_NTZ '1995-07-01 00:00:00'").select("rel_id").distinct()
    return mapping.expand_component(found, start)


def components_named(spark, sf_dir):
    found, _ = solve(spark, sf_dir, "history")
    return components.named_components(found)


def full_mapping_history(spark, sf_dir):
    return mapped(spark, sf_dir, "history")


def full_mapping_current(spark, sf_dir):
    return mapped(spark, sf_dir, "current")


def golden_compare(spark, sf_dir):
    """The mapping after the correction, checked against the one before it."""
    now = mapping.present_as_long(mapped(spark, sf_dir, "current"), "rel_id", "root_id")
    before = mapping.present_as_long(mapped(spark, sf_dir, "current", BEFORE), "rel_id", "root_id")
    return checks.golden_compare(now, before)


QUERIES = {
    "active_seeds": active_seeds, "edges_history": edges_history, "edges_current": edges_current,
    "edges_untagged": edges_untagged, "closure_pairs": closure_pairs, "closure_reached": closure_reached,
    "closure_holds": closure_holds, "vertex_numbers": vertex_numbers, "expand_component": expand_component,
    "components": components_named, "full_mapping_history": full_mapping_history,
    "full_mapping_current": full_mapping_current, "golden_compare": golden_compare,
}

ALL_NEAR = """near AS (
    SELECT DISTINCT a.rel_id AS x, b.rel_id AS y FROM edges a JOIN edges b ON a.id_key = b.id_key)"""

ORACLES = {
    "active_seeds": sql.with_history(NOW, extra=sql.seeds("seeds"), body="SELECT * FROM seeds"),
    "edges_history": sql.with_history(NOW, extra=sql.edges("edges", "history"), body="SELECT * FROM edges"),
    "edges_current": sql.with_history(NOW, extra=sql.edges("edges", "current"), body="SELECT * FROM edges"),
    "edges_untagged": sql.with_history(
        NOW, extra=sql.edges("edges", "current"), body="SELECT DISTINCT rel_id, id_key FROM edges"),
    "closure_pairs": sql.with_history(
        NOW, extra=sql.graph("", "current"), body="SELECT seed_rel_id, rel_id FROM reach"),
    "closure_reached": sql.with_history(NOW, extra=sql.graph("", "current"), body="""
        SELECT seed_rel_id, count(*) AS n_reached FROM reach GROUP BY seed_rel_id"""),
    "closure_holds": sql.with_history(NOW, extra=sql.graph("", "current") + """,
        asked AS (SELECT seed_rel_id, CAST(CAST(seed_rel_id AS BIGINT) + 1 AS STRING) AS rel_id FROM seeds)""", body="""
        SELECT seed_rel_id, rel_id, (seed_rel_id, rel_id) IN (SELECT (seed_rel_id, rel_id) FROM reach) AS reached FROM asked"""),
    "vertex_numbers": sql.with_history(NOW, extra=sql.edges("edges", "history"), body="""
        SELECT rel_id, row_number() OVER (ORDER BY rel_id) - 1 AS v FROM (SELECT DISTINCT rel_id FROM edges)"""),
    "expand_component": sql.with_history(NOW, extra=sql.edges("edges", "current") + ",\n" + ALL_NEAR + """,
        found(rel_id) AS (
            SELECT rel_id FROM register WHERE active_f = 'N' AND valid_from < TIMESTAMP '1995-07-01 00:00:00'
            UNION SELECT n.y FROM found f JOIN near n ON n.x = f.rel_id)""", body="SELECT rel_id FROM found"),
    "components": sql.with_history(NOW, extra=",\n".join([sql.edges("edges", "history"), sql.seeds("seeds"), ALL_NEAR]) + """,
        found(start, rel_id) AS (
            SELECT rel_id, rel_id FROM (SELECT rel_id FROM edges UNION SELECT seed_rel_id FROM seeds)
            UNION SELECT f.start, n.y FROM found f JOIN near n ON n.x = f.rel_id)""",
        body="SELECT start AS rel_id, min(rel_id) AS component_id FROM found GROUP BY start"),
    "full_mapping_history": sql.with_history(
        NOW, extra=sql.graph("", "history"), body="SELECT rel_id, root_id FROM mapping"),
    "full_mapping_current": sql.with_history(
        NOW, extra=sql.graph("", "current"), body="SELECT rel_id, root_id FROM mapping"),
    "golden_compare": sql.two_states("""
        SELECT 'extra' AS kind, CAST(rel_id AS BIGINT) AS rel_id, CAST(root_id AS BIGINT) AS root_id
        FROM (SELECT * FROM mapping EXCEPT SELECT * FROM b_mapping)
        UNION ALL SELECT 'missing', CAST(rel_id AS BIGINT), CAST(root_id AS BIGINT)
        FROM (SELECT * FROM b_mapping EXCEPT SELECT * FROM mapping)"""),
}
