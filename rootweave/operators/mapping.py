"""Which root does each entity belong to?"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rootweave.functions.rules import better_root, key_as_long
from rootweave.operators.components import Components, connected_components
from rootweave.operators.skew import skew_join
from rootweave.workspace import Workspace


def seeds_as_entities(seeds: DataFrame) -> DataFrame:
    return seeds.select(F.col("seed_rel_id").alias("rel_id"))


def components_with_seeds(edges: DataFrame, seeds: DataFrame, ws: Workspace, rows: int | None = None) -> Components:
    """Components of all entities with an edge and of all seeds, even those without one. ``rows``: see :func:`connected_components`."""
    return replace(connected_components(edges, ws, isolated=seeds_as_entities(seeds), rows=rows), isolated=seeds)


def seeded_components(found: Components, seeds: DataFrame) -> DataFrame:
    """(component_id, seed_rel_id) for each seed."""
    return found.labels.join(seeds_as_entities(seeds), "rel_id").select(
        "component_id", F.col("rel_id").alias("seed_rel_id")
    )


def assign_roots(found: Components, seeds: DataFrame) -> DataFrame:
    """(rel_id, root_id): the best seed of each component, for all its entities.

    If the components were made with these very seeds, they are marked in the labels and need not be looked up.
    """
    if found.marked is not None and found.isolated is seeds:
        seeded = found.marked.filter("rel_id IS NOT NULL").withColumnRenamed("rel_id", "seed_rel_id")
    else:
        seeded = seeded_components(found, seeds)
    winners = seeded.groupBy("component_id").agg(better_root("seed_rel_id").alias("root_id"))
    return skew_join(found.labels, winners, "component_id", found.hot).select("rel_id", "root_id")


@dataclass(frozen=True)
class Closure:
    """Everything each seed reaches, kept as two short relations instead of all pairs.

    ``seeds(component_id, seed_rel_id)`` has one row per seed, ``members(component_id, rel_id)`` one per entity; a seed
    reaches the members of its component. Together they are as long as seeds and entities, while the pairs
    are as many as seeds times members. ``hot`` lists the components with very many members.
    """

    seeds: DataFrame
    members: DataFrame
    hot: DataFrame

    def sizes(self) -> DataFrame:
        """(component_id, n_seeds, n_members, n_pairs)."""
        seeds = self.seeds.groupBy("component_id").agg(F.count(F.lit(1)).alias("n_seeds"))
        members = self.members.groupBy("component_id").agg(F.count(F.lit(1)).alias("n_members"))
        return seeds.join(members, "component_id").withColumn("n_pairs", F.col("n_seeds") * F.col("n_members"))

    def reached(self) -> DataFrame:
        """(seed_rel_id, n_reached): how many entities each seed reaches, itself included."""
        return skew_join(self.seeds, self.sizes().select("component_id", "n_members"), "component_id", self.hot).select(
            "seed_rel_id", F.col("n_members").alias("n_reached")
        )

    def holds(self, pairs: DataFrame) -> DataFrame:
        """``pairs(seed_rel_id, rel_id)`` with ``reached``, whether the seed reaches the entity; no other pair is made."""
        of_seed = self.seeds.select("seed_rel_id", F.col("component_id").alias("_from"))
        of_entity = self.members.select("rel_id", F.col("component_id").alias("_to"))
        found = pairs.join(of_seed, "seed_rel_id", "left").join(of_entity, "rel_id", "left")
        return found.select(*pairs.columns, F.coalesce(F.col("_from") == F.col("_to"), F.lit(False)).alias("reached"))

    def pairs(self) -> DataFrame:
        """(seed_rel_id, rel_id), written out: seeds times members of each component."""
        return skew_join(self.members, self.seeds, "component_id", self.hot).select("seed_rel_id", "rel_id")


def closure(found: Components, seeds: DataFrame) -> Closure:
    return Closure(seeded_components(found, seeds), found.labels.select("component_id", "rel_id"), found.hot)


def closure_pairs(found: Components, seeds: DataFrame) -> DataFrame:
    """(seed_rel_id, rel_id) for everything each seed reaches, itself included; see :class:`Closure`."""
    return closure(found, seeds).pairs()


def expand_component(found: Components, start: DataFrame) -> DataFrame:
    """Every entity reachable from ``start(rel_id)``; start rows without an edge are kept."""
    touched = found.labels.join(start, "rel_id", "left_semi").select("component_id").distinct()
    reached = skew_join(found.labels, touched, "component_id", found.hot, "left_semi").select("rel_id")
    return reached.unionByName(start.select("rel_id")).distinct()


def full_mapping(edges: DataFrame, seeds: DataFrame, ws: Workspace) -> DataFrame:
    """(rel_id, root_id) of the whole graph, from nothing but edges and seeds."""
    seeds = ws.stage(seeds, "seeds")
    return assign_roots(components_with_seeds(edges, seeds, ws), seeds)


def present_as_long(mapping: DataFrame, entity_out: str, root_out: str) -> DataFrame:
    """Numeric presentation of a mapping; keys that are not whole numbers become NULL."""
    return mapping.select(key_as_long("rel_id").alias(entity_out), key_as_long("root_id").alias(root_out))
