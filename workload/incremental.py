"""Incremental maintenance: each step of a refresh, and the whole of it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rootweave.config import MappingConfig
from rootweave.operators import checks, delta
from rootweave.operators.edges import active_seeds, edge_rows
from rootweave.operators.skew import Keys, semi_join, stage_keys
from rootweave.plans import refresh, state
from rootweave.plans.scenario import current_output
from rootweave.sources.tables import swap_replace
from rootweave.workspace import Workspace
from workload import oracles as sql
from workload.mapping import solve
from workload.relational import BEFORE_MEMBER, both_graphs, graph, one_step_membership
from workload.views import BEFORE, NOW, config, create_tables, history_tables


def signed(before: DataFrame, now: DataFrame) -> DataFrame:
    """What came (sign 1) and went (-1)."""
    return delta.presence(before, now).filter("was <> now").select(*before.columns, F.expr("IF(now, 1, -1)").alias("sign"))


def start_of(spark: SparkSession, sf_dir: str, ws: Workspace) -> Keys:
    """The staged start of the impact of going from BEFORE to NOW."""
    cfg = config("current")
    before, now = (history_tables(spark, sf_dir, s) for s in (BEFORE, NOW))
    edge_changes, counted = ws.stage_counted(signed(edge_rows(before, cfg), edge_rows(now, cfg)), "edge-changes")
    seed_changes = signed(active_seeds(before, cfg), active_seeds(now, cfg))
    return stage_keys(refresh.impact_start(edge_changes, seed_changes, edge_rows(now, cfg), counted["rows"]), ws, "start")


def region_of(spark: SparkSession, sf_dir: str, ws: Workspace) -> Keys:
    previous, _ = solve(spark, sf_dir, "current", BEFORE)
    return refresh.impacted_entities(start_of(spark, sf_dir, ws), previous.labels, ws)


def edge_delta(spark, sf_dir):
    return delta.edge_delta(graph(spark, sf_dir, state=BEFORE)[0], graph(spark, sf_dir)[0])


def seed_delta(spark, sf_dir):
    return delta.seed_delta(graph(spark, sf_dir, state=BEFORE)[1], graph(spark, sf_dir)[1])


def impact_start(spark, sf_dir):
    return start_of(spark, sf_dir, Workspace(spark)).frame


def impacted_entities(spark, sf_dir):
    return region_of(spark, sf_dir, Workspace(spark)).frame


def impacted_seeds(spark, sf_dir):
    region = region_of(spark, sf_dir, Workspace(spark))
    return refresh.impacted_seeds(active_seeds(history_tables(spark, sf_dir), config("current")), region)


def scoped_recompute(spark, sf_dir):
    ws, tables, cfg = Workspace(spark), history_tables(spark, sf_dir), config("current")
    region = region_of(spark, sf_dir, ws)
    return refresh.scoped_recompute(edge_rows(tables, cfg), active_seeds(tables, cfg), region, ws)[0]


def merge_output(spark, sf_dir):
    """One-step memberships: entities of changed edges get their new one, others keep the old."""
    ws = Workspace(spark)
    before, now = graph(spark, sf_dir, state=BEFORE), graph(spark, sf_dir)
    region = stage_keys(delta.edge_delta(before[0], now[0]).select("rel_id"), ws, "region")
    recomputed = semi_join(one_step_membership(*now), region, "rel_id")
    return refresh.merge_output(one_step_membership(*before), region, recomputed)


def enforce_active(spark, sf_dir):
    """Earlier memberships whose root is still active."""
    member = one_step_membership(*graph(spark, sf_dir, state=BEFORE))
    return refresh.enforce_active(member, graph(spark, sf_dir)[1], Workspace(spark))


def delta_check(spark, sf_dir):
    """All insertions are expected and no removal, so the removals come back as problems."""
    before = one_step_membership(*graph(spark, sf_dir, state=BEFORE))
    now = one_step_membership(*graph(spark, sf_dir))
    expected = delta.pair_delta(before, now).filter("kind = 'inserted'")
    return checks.delta_check(before, now, expected)


def replace_sources(spark: SparkSession, sf_dir: str, cfg: MappingConfig, state: str) -> None:
    for name, df in history_tables(spark, sf_dir, state).items():
        swap_replace(spark, f"{cfg.source_db}.{name}", df)


def refreshed(spark: SparkSession, sf_dir: str) -> tuple[MappingConfig, refresh.RunStats]:
    """First refresh on BEFORE, second on NOW: its configuration and what the second run counted."""
    ws = Workspace(spark)
    db = ws.scratch_database()
    cfg = config("current", db, state_db=ws.scratch_database())
    create_tables(spark, sf_dir, db, BEFORE)
    refresh.refresh_mapping(spark, cfg)
    replace_sources(spark, sf_dir, cfg, NOW)
    return cfg, refresh.refresh_mapping(spark, cfg)


def incremental_mapping(spark, sf_dir):
    return current_output(spark, refreshed(spark, sf_dir)[0])


def run_stats(spark, sf_dir):
    return refreshed(spark, sf_dir)[1].as_frame(spark)


def noop_run(spark, sf_dir):
    """What a third run without any change counts."""
    cfg, _ = refreshed(spark, sf_dir)
    return refresh.refresh_mapping(spark, cfg).as_frame(spark)


def incremental_state(spark, sf_dir):
    """What the state tables hold after the refresh, as one list of facts; components by their smallest entity."""
    cfg, _ = refreshed(spark, sf_dir)
    edges = spark.table(cfg.state(refresh.EDGE_SNAPSHOT)).select(F.col("source_table").alias("fact"), "rel_id", F.col("id_key").alias("value"))
    seeds = spark.table(cfg.state(refresh.SEED_SNAPSHOT)).select(F.lit("seed").alias("fact"), F.col("seed_rel_id").alias("rel_id"), F.lit("").alias("value"))
    members = spark.table(cfg.state(refresh.MEMBERS)).select(F.lit("member").alias("fact"), "rel_id", F.col("root_id").alias("value"))
    labels = spark.table(cfg.state(refresh.COMPONENTS))
    names = labels.groupBy("component_id").agg(F.min("rel_id").alias("value"))
    components = labels.join(names, "component_id").select(F.lit("component").alias("fact"), "rel_id", "value")
    return edges.unionByName(seeds).unionByName(members).unionByName(components)


def source_digests(spark, sf_dir):
    """Rows by relation of which digests are kept, summed over all buckets."""
    relations = refresh.source_relations(history_tables(spark, sf_dir), config("current"))
    found = state.digest_rows(spark, state.digests(relations, state.LEAST_BUCKETS))
    return found.groupBy("relation").agg(F.sum("n").alias("row_count"))


def idempotent_rerun(spark, sf_dir):
    """Rows that the rerun without any change inserted and removed, and those it kept."""
    cfg, _ = refreshed(spark, sf_dir)
    before = Workspace(spark).stage(current_output(spark, cfg), "output")
    refresh.refresh_mapping(spark, cfg)
    return delta.presence(before, current_output(spark, cfg)).agg(
        F.count_if(F.expr("now AND NOT was")).alias("inserted"),
        F.count_if(F.expr("was AND NOT now")).alias("removed"),
        F.count_if(F.expr("was AND now")).alias("kept"),
    )


QUERIES = {
    "edge_delta": edge_delta, "seed_delta": seed_delta, "impact_start": impact_start,
    "impacted_entities": impacted_entities, "impacted_seeds": impacted_seeds,
    "scoped_recompute": scoped_recompute, "merge_output": merge_output, "enforce_active": enforce_active,
    "delta_check": delta_check, "incremental_mapping": incremental_mapping, "run_stats": run_stats,
    "noop_run": noop_run, "source_digests": source_digests, "incremental_state": incremental_state, "idempotent_rerun": idempotent_rerun,
}

BOTH_MEMBERS = sql.ONE_STEP + ",\n" + BEFORE_MEMBER.replace("member AS", "b_member AS", 1)

ORACLES = {
    "edge_delta": both_graphs("""
        SELECT 'inserted' AS kind, * FROM (SELECT * FROM edges EXCEPT SELECT * FROM b_edges)
        UNION ALL SELECT 'removed', * FROM (SELECT * FROM b_edges EXCEPT SELECT * FROM edges)"""),
    "seed_delta": both_graphs("""
        SELECT 'inserted' AS kind, * FROM (SELECT * FROM seeds EXCEPT SELECT * FROM b_seeds)
        UNION ALL SELECT 'removed', * FROM (SELECT * FROM b_seeds EXCEPT SELECT * FROM seeds)"""),
    "impact_start": both_graphs("SELECT rel_id FROM start_set", sql.START),
    "impacted_entities": sql.two_states("SELECT rel_id FROM region", sql.REGION),
    "impacted_seeds": sql.two_states(
        "SELECT seed_rel_id FROM seeds WHERE seed_rel_id IN (SELECT rel_id FROM region)", sql.REGION),
    "scoped_recompute": sql.two_states(
        "SELECT rel_id, root_id FROM mapping WHERE rel_id IN (SELECT rel_id FROM region)", sql.REGION),
    "merge_output": both_graphs("""
        SELECT rel_id, root_id FROM b_member WHERE rel_id NOT IN (SELECT rel_id FROM moved)
        UNION ALL SELECT rel_id, root_id FROM member WHERE rel_id IN (SELECT rel_id FROM moved)""",
        BOTH_MEMBERS + ",\n" + sql.MOVED),
    "enforce_active": both_graphs(
        "SELECT rel_id, root_id FROM member WHERE root_id IN (SELECT seed_rel_id FROM seeds)", BEFORE_MEMBER),
    "delta_check": both_graphs("""
        SELECT 'unexpected' AS problem, 'removed' AS kind, rel_id, root_id
        FROM (SELECT * FROM b_member EXCEPT SELECT * FROM member)""", BOTH_MEMBERS),
    "incremental_mapping": sql.with_history(
        NOW, extra=sql.graph("", "current"), body="SELECT rel_id, root_id FROM mapping"),
    "run_stats": sql.two_states("""
        SELECT (SELECT count(*) FROM moved) AS changed_edges,
               (SELECT count(*) FROM (SELECT * FROM seeds EXCEPT SELECT * FROM b_seeds)) AS added_seeds,
               (SELECT count(*) FROM (SELECT * FROM b_seeds EXCEPT SELECT * FROM seeds)) AS removed_seeds,
               (SELECT count(*) FROM region) AS impacted_rel_ids,
               (SELECT count(*) FROM mapping) AS output_rows""", sql.REGION),
    "noop_run": sql.with_history(NOW, extra=sql.graph("", "current"), body="""
        SELECT 0 AS changed_edges, 0 AS added_seeds, 0 AS removed_seeds, 0 AS impacted_rel_ids,
               count(*) AS output_rows FROM mapping"""),
    "source_digests": sql.with_history(NOW, extra=sql.seeds("seeds"), body="""
        SELECT 'edges of register' AS relation, count(*) AS row_count FROM register
        WHERE valid_to >= TIMESTAMP '9999-12-31' AND trim(rel_id) <> '' AND trim(id_key) <> ''
        UNION ALL SELECT 'edges of link', count(*) FROM link
        WHERE valid_to >= TIMESTAMP '9999-12-31' AND del_f = 'N' AND trim(rel_id) <> '' AND trim(id_key) <> ''
        UNION ALL SELECT 'seeds', count(*) FROM seeds"""),
    "incremental_state": sql.with_history(NOW, extra=sql.graph("", "current") + """,
        found(start, rel_id) AS (
            SELECT rel_id, rel_id FROM (SELECT rel_id FROM edges UNION SELECT seed_rel_id FROM seeds)
            UNION SELECT f.start, n.y FROM found f JOIN near n ON n.x = f.rel_id)""", body="""
        SELECT source_table AS fact, rel_id, id_key AS value FROM edges
        UNION ALL SELECT 'seed', seed_rel_id, '' FROM seeds
        UNION ALL SELECT 'member', rel_id, root_id FROM mapping
        UNION ALL SELECT 'component', start, min(rel_id) FROM found GROUP BY start"""),
    "idempotent_rerun": sql.with_history(NOW, extra=sql.graph("", "current"), body="""
        SELECT 0 AS inserted, 0 AS removed, count(*) AS kept FROM mapping"""),
}
