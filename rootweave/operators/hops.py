"""Single steps through the graph, for exploring it by hand.

Closures do not use these: a step that keeps seeds apart makes, by its meaning, one row
for every seed and entity on an identifier.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rootweave.operators.skew import hot_keys, skew_join
from rootweave.workspace import Workspace


def start_frontier(seeds: DataFrame) -> DataFrame:
    """Every seed reaches itself."""
    return seeds.select("seed_rel_id", F.col("seed_rel_id").alias("rel_id"))


def entity_to_key(frontier: DataFrame, edges: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """Identifiers next to the frontier. Columns other than ``rel_id`` (a seed) are kept.

    ``hot`` lists entities with very many edges, if that was counted.
    """
    kept = [c for c in frontier.columns if c != "rel_id"]
    return skew_join(edges.select("rel_id", "id_key"), frontier, "rel_id", hot).select(*kept, "id_key").distinct()


def key_to_entity(frontier: DataFrame, edges: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """Entities next to a frontier of identifiers; ``hot`` lists identifiers with very many edges."""
    kept = [c for c in frontier.columns if c != "id_key"]
    return skew_join(edges.select("rel_id", "id_key"), frontier, "id_key", hot).select(*kept, "rel_id").distinct()


def one_step_membership(
    seeds: DataFrame, edges: DataFrame, by_entity: DataFrame | None = None, by_key: DataFrame | None = None
) -> DataFrame:
    """(rel_id, root_id): the smallest seed at most one identifier away.

    Each identifier is reduced to its smallest seed before it meets its entities, so
    the rows in between never outnumber the edges. ``by_entity`` and ``by_key`` list hot entities and identifiers.
    """
    best = entity_to_key(start_frontier(seeds), edges, by_entity).groupBy("id_key").agg(F.min("seed_rel_id").alias("root_id"))
    reached = skew_join(edges.select("rel_id", "id_key"), best, "id_key", by_key)
    return reached.groupBy("rel_id").agg(F.min("root_id").alias("root_id"))


def hot_edge_keys(edges: DataFrame, ws: Workspace) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Staged edges with their hot entities and hot identifiers."""
    edges, counted = ws.stage_counted(edges, "edges")
    return edges, hot_keys(edges, "rel_id", counted["rows"]), hot_keys(edges, "id_key", counted["rows"])


# Numbers that one slot, and one word of it, stand for.
BITS, WORD = 32_768, 64


def key_bitmaps(numbered: DataFrame, edges: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """(id_key, slot, seeds): the seeds on each identifier as bitmaps of their numbers, from ``numbered(seed_rel_id, v)``.

    Numbers count from 1. An identifier has one row for each 32,768 numbers among which it has a seed. ``seeds`` lists the
    64-bit words ``(at, word)`` that are not zero, so a row is never longer than its seeds, nor than 512 words.
    """
    found = skew_join(edges.select("rel_id", "id_key"), numbered.select(F.col("seed_rel_id").alias("rel_id"), "v"), "rel_id", hot)
    place = F.bitmap_bit_position("v").cast("int")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), place % WORD)
    words = found.groupBy("id_key", F.bitmap_bucket_number("v").alias("slot"), F.floor(place / WORD).cast("int").alias("at")).agg(
        F.bit_or(bit).alias("word")
    )
    return words.groupBy("id_key", "slot").agg(F.collect_list(F.struct("at", "word")).alias("seeds"))


def entity_bitmaps(keys: DataFrame, edges: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """(rel_id, slot, at, word): the seeds at most one identifier away from each entity, in words that are not zero.

    There are never more rows than pairs, and where seeds lie close up to 64 times fewer.
    """
    reached = skew_join(edges.select("rel_id", "id_key"), keys, "id_key", hot)
    words = reached.select("rel_id", "slot", F.inline("seeds"))
    return words.groupBy("rel_id", "slot", "at").agg(F.bit_or("word").alias("word"))


def count_seeds(bitmaps: DataFrame) -> DataFrame:
    """(rel_id, n_seeds), counted in the bitmaps."""
    return bitmaps.groupBy("rel_id").agg(F.sum(F.bit_count("word").cast("bigint")).alias("n_seeds"))


def listed_seeds(bitmaps: DataFrame, numbered: DataFrame) -> DataFrame:
    """(seed_rel_id, rel_id): the pairs that the bitmaps stand for, written out."""
    bits = bitmaps.withColumn("bit", F.explode(F.expr("filter(sequence(0, 63), j -> (shiftright(word, j) & 1) = 1)")))
    number = (F.col("slot") - 1) * BITS + F.col("at") * WORD + F.col("bit") + 1
    return bits.select("rel_id", number.alias("v")).join(numbered, "v").select("seed_rel_id", "rel_id")


def only_new(candidates: DataFrame, visited: DataFrame) -> DataFrame:
    """Candidates that were not visited yet, compared on all their columns."""
    return candidates.join(visited, candidates.columns, "left_anti")
