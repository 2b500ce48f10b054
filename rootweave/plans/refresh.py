"""Incremental refresh: recompute only what a change can have touched.

Every edge that joins two components of the previous run must be a new edge. So the
components that hold an entity of a changed edge, an entity already known for a changed
identifier, or an added or removed seed are the only ones whose answer can differ, and
together with the new entities they are closed under the edges of both runs. That region
is recomputed with the same operators as a full rebuild; everything else is carried over.

What a run costs follows what changed: digests find the buckets of the sources with changes, only
these are compared with the log, the changes are appended to it, and labels are overwritten in the
buckets of the region only (see :mod:`rootweave.plans.state`). Current edges are read from the
sources, so the log is never read as a whole. A run without changes writes nothing.
"""

from __future__ import annotations

import uuid
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rootweave.config import MappingConfig
from rootweave.operators.edges import EDGE_COLUMNS, active_seeds, edge_rows, load_sources
from rootweave.operators.mapping import assign_roots, components_with_seeds
from rootweave.operators.numbering import dense_numbers
from rootweave.operators.skew import BROADCAST_ROWS, Keys, anti_join, hot_keys, semi_join, skew_join, stage_keys
from rootweave.plans import state
from rootweave.sources.tables import (
    append_rows,
    drop_table,
    ensure_database,
    ensure_table,
    finish_swap,
    get_property,
    recover_swap,
    set_properties,
    stage_replacement,
    swap_replace,
)
from rootweave.workspace import Workspace

EDGES = "edge_log"
SEEDS = "seed_log"
COMPONENTS = "component_snapshot"
DIGESTS = "source_digest"
# The last column of the first three is what they are partitioned by.
STATE_SCHEMAS = {
    EDGES: f"source_table STRING, rel_id STRING, id_key STRING, sign INT, {state.BUCKET} INT",
    SEEDS: f"seed_rel_id STRING, sign INT, {state.BUCKET} INT",
    COMPONENTS: f"rel_id STRING, component_id BIGINT, {state.BUCKET} INT",
    DIGESTS: f"relation STRING, {state.BUCKET} INT, n BIGINT, low BIGINT, high BIGINT",
}
EDGE_SNAPSHOT = "edge_snapshot"
SEED_SNAPSHOT = "seed_snapshot"
MEMBERS = "seed_membership"
SEED_RELATION = "seeds"
RUN_ID = "rootweave.run_id"
BUCKETS = "rootweave.buckets"
NEXT_COMPONENT = "rootweave.next_component"


@dataclass(frozen=True)
class RunStats:
    changed_edges: int
    added_seeds: int
    removed_seeds: int
    impacted_rel_ids: int
    output_rows: int

    def as_dict(self) -> dict[str, int]:
        return asdict(self)

    def as_frame(self, spark: SparkSession) -> DataFrame:
        values = self.as_dict()
        return spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} bigint" for k in values))


def state_tables(cfg: MappingConfig) -> list[str]:
    return [cfg.state(t) for t in STATE_SCHEMAS]


def ensure_state_table(spark: SparkSession, cfg: MappingConfig, table: str) -> None:
    ensure_table(spark, cfg.state(table), STATE_SCHEMAS[table], None if table == DIGESTS else state.BUCKET)


def ensure_tables(spark: SparkSession, cfg: MappingConfig) -> None:
    """Create the databases, the output table, the state tables and the views on them that are missing."""
    ensure_database(spark, cfg.target_db)
    ensure_database(spark, cfg.state_db)
    for table in [cfg.output, *state_tables(cfg)]:
        recover_swap(spark, table)
    for table in STATE_SCHEMAS:
        ensure_state_table(spark, cfg, table)
    ensure_table(spark, cfg.output, f"{cfg.entity_out} STRING, {cfg.root_out} STRING")
    # What the last run saw and found, without a second copy of it.
    views = {
        EDGE_SNAPSHOT: f"SELECT source_table, rel_id, id_key FROM {cfg.state(EDGES)} GROUP BY ALL HAVING sum(sign) > 0",
        SEED_SNAPSHOT: f"SELECT seed_rel_id FROM {cfg.state(SEEDS)} GROUP BY ALL HAVING sum(sign) > 0",
        MEMBERS: f"SELECT CAST({cfg.entity_out} AS STRING) AS rel_id, CAST({cfg.root_out} AS STRING) AS root_id "
                 f"FROM {cfg.output}",
    }
    for view, query in views.items():
        spark.sql(f"CREATE OR REPLACE VIEW {cfg.state(view)} AS {query}")


def committed_run(spark: SparkSession, cfg: MappingConfig) -> str | None:
    """The run that wrote the output and all state tables, or None if they disagree.

    The run is stamped together with the edge scope, so a changed scope starts afresh, and so do logs of other columns.
    """
    for table in (EDGES, SEEDS):
        if spark.table(cfg.state(table)).columns != [c.split()[0] for c in STATE_SCHEMAS[table].split(", ")]:
            return None
    runs = {get_property(spark, t, RUN_ID) for t in [cfg.output, *state_tables(cfg)]}
    run = runs.pop() if len(runs) == 1 else None
    return run if run and run.startswith(f"{cfg.edge_scope}-") else None


def stamp(spark: SparkSession, cfg: MappingConfig, run: str) -> None:
    for table in [cfg.output, *state_tables(cfg)]:
        set_properties(spark, table, {RUN_ID: run})


def impact_start(edge_changes: DataFrame, seed_changes: DataFrame, edges: DataFrame, changed_edges: int) -> DataFrame:
    """Entities from which a change can spread.

    Entities of changed edges and changed seeds, plus one entity that each changed identifier already had: it
    stands for the component that the identifier belonged to. ``edges`` are the edges now; those of the changed
    identifiers without what came and with what went are the earlier ones.
    """
    moved_keys = Keys(edge_changes.select("id_key").distinct(), changed_edges)
    came = edge_changes.filter("sign > 0").select(EDGE_COLUMNS)
    went = edge_changes.filter("sign < 0").select(EDGE_COLUMNS)
    came = F.broadcast(came) if changed_edges <= BROADCAST_ROWS else came
    earlier = semi_join(edges, moved_keys, "id_key").select(EDGE_COLUMNS).join(came, EDGE_COLUMNS, "left_anti").unionByName(went)
    known = earlier.groupBy("id_key").agg(F.min("rel_id").alias("rel_id"))
    return (
        edge_changes.select("rel_id")
        .unionByName(known.select("rel_id"))
        .unionByName(seed_changes.select(F.col("seed_rel_id").alias("rel_id")))
        .distinct()
    )


def impacted_entities(start: Keys, components: DataFrame, ws: Workspace) -> Keys:
    """``start(rel_id)`` and all members of the previous ``components`` it touches."""
    touched = semi_join(components, start, "rel_id").select("component_id").distinct()
    # An entity is in one component, so no more components are touched than entities.
    members = semi_join(components, Keys(touched, start.rows), "component_id").select("rel_id")
    return stage_keys(members.unionByName(start.frame), ws, "region")


def impacted_seeds(seeds: DataFrame, region: Keys) -> DataFrame:
    """Every active seed inside the region, whether or not it won before."""
    return semi_join(seeds.withColumnRenamed("seed_rel_id", "rel_id"), region, "rel_id").select(
        F.col("rel_id").alias("seed_rel_id")
    )


def scoped_recompute(
    edges: DataFrame, seeds: DataFrame, region: Keys, ws: Workspace
) -> tuple[DataFrame, DataFrame]:
    """Mapping and component labels of a region, computed from its own edges and seeds.

    ``edges`` and ``seeds`` are scanned once per use.
    """
    region_seeds = impacted_seeds(seeds, region)
    found = components_with_seeds(semi_join(edges, region, "rel_id"), region_seeds, ws)
    return assign_roots(found, region_seeds), found.labels


def merge_output(previous: DataFrame, region: Keys, recomputed: DataFrame) -> DataFrame:
    """Rows outside the region as they were, rows inside it as recomputed."""
    return anti_join(previous, region, "rel_id").unionByName(recomputed)


def enforce_active(mapping: DataFrame, seeds: DataFrame, ws: Workspace) -> DataFrame:
    """Rows whose root is an active seed. One root may own a large share of the rows."""
    mapping, counted = ws.stage_counted(mapping, "mapping")
    roots = seeds.select(F.col("seed_rel_id").alias("root_id"))
    heavy = hot_keys(mapping, "root_id", counted["rows"])
    return skew_join(mapping, roots, "root_id", heavy, "left_semi").select("rel_id", "root_id")


def numbered_labels(labels: DataFrame, start: int, ws: Workspace) -> tuple[DataFrame, int]:
    """(rel_id, component_id) of staged ``labels`` with components numbered from ``start`` on, and the number after the last.

    Numbers are never issued twice, so a component of an earlier run cannot be mistaken for one of this run.
    """
    numbers, components = dense_numbers(labels.select("component_id").distinct(), ["component_id"], ws, start, "number")
    hot = hot_keys(labels, "component_id", labels.count())
    return skew_join(labels, numbers, "component_id", hot).select("rel_id", F.col("number").alias("component_id")), start + components


def refresh_mapping(spark: SparkSession, cfg: MappingConfig) -> RunStats:
    """Bring the output table up to date with the source tables.

    The result equals a full rebuild of the configured scope. Without any change nothing is
    written. If there is no consistent state of an earlier run, everything is rebuilt. While state is being
    written no table carries a run, so a run that is cut short leads to a rebuild as well.
    """
    with Workspace(spark) as ws:
        ensure_tables(spark, cfg)
        tables = load_sources(spark, cfg)
        rows = sum(t.count() for t in tables.values())
        ws.expect(rows)
        relations = source_relations(tables, cfg)
        if committed_run(spark, cfg) is None:
            return _start(spark, cfg, tables, relations, rows, ws)
        return _update(spark, cfg, tables, relations, ws)


def source_relations(tables: dict[str, DataFrame], cfg: MappingConfig) -> dict[str, DataFrame]:
    """What digests are kept of: the usable edges of each source, and the seeds."""
    edges = edge_rows(tables, cfg)
    by_source = {f"edges of {s.name}": edges.filter(F.col("source_table") == s.name) for s in cfg.sources}
    return {**by_source, SEED_RELATION: active_seeds(tables, cfg)}


def output_rows(spark: SparkSession, cfg: MappingConfig) -> DataFrame:
    return spark.table(cfg.output).select(
        F.col(cfg.entity_out).cast("string").alias("rel_id"), F.col(cfg.root_out).cast("string").alias("root_id")
    )


def _named(mapping: DataFrame, cfg: MappingConfig) -> DataFrame:
    return mapping.select(F.col("rel_id").alias(cfg.entity_out), F.col("root_id").alias(cfg.root_out))


def _finish(spark: SparkSession, cfg: MappingConfig, digests: state.Digests) -> None:
    """The last step of a run: digests, and the run's name on all tables."""
    swap_replace(spark, cfg.state(DIGESTS), state.digest_rows(spark, digests))
    stamp(spark, cfg, f"{cfg.edge_scope}-{uuid.uuid4().hex}")


def _start(spark, cfg, tables, relations, number: int, ws: Workspace) -> RunStats:
    """Full rebuild, and the state that later runs start from. ``number`` is how many rows the sources have."""
    buckets = state.buckets_for(number)
    stamp(spark, cfg, "")
    digests = state.digests(relations, buckets)
    for table in (EDGES, SEEDS, COMPONENTS):
        drop_table(spark, cfg.state(table))
        ensure_state_table(spark, cfg, table)
    logs = {EDGES: edge_rows(tables, cfg), SEEDS: relations[SEED_RELATION]}
    added = {}
    for table, rows in logs.items():
        append_rows(state.whole_log(rows, buckets, number), cfg.state(table))
        added[table] = spark.table(cfg.state(table)).count()

    edges = spark.table(cfg.state(EDGES)).select(EDGE_COLUMNS)
    seeds = spark.table(cfg.state(SEEDS)).select("seed_rel_id")
    found = components_with_seeds(edges, seeds, ws, sum(added.values()))
    mapping = assign_roots(found, seeds)
    if cfg.carry_forward:
        kept = anti_join(output_rows(spark, cfg), Keys(found.labels.select("rel_id"), found.entities), "rel_id").distinct()
        mapping = mapping.unionByName(enforce_active(kept, seeds, ws))
    _, written = stage_replacement(spark, cfg.output, _named(mapping, cfg))
    labels, following = numbered_labels(found.labels, 0, ws)
    state.append_buckets(with_entity_bucket(labels, buckets), cfg.state(COMPONENTS))
    set_properties(spark, cfg.state(COMPONENTS), {BUCKETS: str(buckets), NEXT_COMPONENT: str(following)})
    finish_swap(spark, cfg.output)
    _finish(spark, cfg, digests)
    return RunStats(
        changed_edges=added[EDGES], added_seeds=added[SEEDS], removed_seeds=0, impacted_rel_ids=found.entities,
        output_rows=written["rows"],
    )


def with_entity_bucket(labels: DataFrame, buckets: int) -> DataFrame:
    return labels.withColumn(state.BUCKET, state.bucket_of(["rel_id"], buckets))


def _update(spark, cfg, tables, relations, ws: Workspace) -> RunStats:
    buckets = int(get_property(spark, cfg.state(COMPONENTS), BUCKETS))
    before, now = state.as_digests(spark.table(cfg.state(DIGESTS))), state.digests(relations, buckets)
    output = output_rows(spark, cfg)
    if before == now:
        return RunStats(0, 0, 0, 0, output.count())

    current_edges = edge_rows(tables, cfg)
    sources = [name for name in relations if name != SEED_RELATION]
    edge_buckets, seed_buckets = state.changed_buckets(before, now, sources), state.changed_buckets(before, now, [SEED_RELATION])
    edge_changes, edge_moves = state.changes(spark.table(cfg.state(EDGES)), current_edges, buckets, edge_buckets, ws)
    seed_changes, seed_moves = state.changes(spark.table(cfg.state(SEEDS)), relations[SEED_RELATION], buckets, seed_buckets, ws)
    changed_edges = edge_moves["rows"]
    if not changed_edges and not seed_moves["rows"]:  # repeated rows came or went
        stamp(spark, cfg, "")
        _finish(spark, cfg, now)
        return RunStats(0, 0, 0, 0, output.count())

    previous = spark.table(cfg.state(COMPONENTS)).select("rel_id", "component_id", state.BUCKET)
    start = stage_keys(impact_start(edge_changes, seed_changes, current_edges, changed_edges), ws, "start")
    region = impacted_entities(start, previous, ws)
    recomputed, labels = scoped_recompute(current_edges, relations[SEED_RELATION], region, ws)
    mapping = merge_output(output, region, recomputed)
    if cfg.carry_forward and seed_moves["removed"]:
        gone = seed_changes.filter("sign < 0").select(F.col("seed_rel_id").alias("root_id"))
        mapping = anti_join(mapping, stage_keys(gone, ws, "gone"), "root_id").select("rel_id", "root_id")
    _, written = stage_replacement(spark, cfg.output, _named(mapping, cfg))

    first = int(get_property(spark, cfg.state(COMPONENTS), NEXT_COMPONENT))
    labels, following = numbered_labels(labels, first, ws)
    labels = ws.stage(with_entity_bucket(labels, buckets), "new-labels")
    # At most as many numbers as there are buckets.
    touched = [r[0] for r in region.frame.select(state.bucket_of(["rel_id"], buckets).alias(state.BUCKET)).distinct().collect()]
    kept = anti_join(previous.filter(state.in_buckets(touched)), region, "rel_id")

    stamp(spark, cfg, "")
    state.overwrite_buckets(kept.select("rel_id", "component_id", state.BUCKET).unionByName(labels), cfg.state(COMPONENTS), touched)
    for table, found, numbers in ((EDGES, edge_changes, edge_buckets), (SEEDS, seed_changes, seed_buckets)):
        if numbers:
            state.append_buckets(found, cfg.state(table))
            state.compact(spark, cfg.state(table), numbers)
    set_properties(spark, cfg.state(COMPONENTS), {NEXT_COMPONENT: str(following)})
    finish_swap(spark, cfg.output)
    _finish(spark, cfg, now)
    return RunStats(
        changed_edges=changed_edges, added_seeds=seed_moves["added"], removed_seeds=seed_moves["removed"],
        impacted_rel_ids=region.rows, output_rows=written["rows"],
    )
