"""Connected components of the entity–identifier graph.

Links are undirected, so whatever a seed reaches is exactly its component. The
components come from randomised contraction (Bögeholz, Brand and Todor, "In-database
connected component analysis", 2020), here with steps of two: each vertex points to its
smallest neighbour under a random order, joins the vertex its pointer's pointer names, and
edges inside a merged group disappear. The edge table shrinks geometrically whatever the
diameter, so all rounds together cost little more than the first one. Nothing ever lists
pairs of entities that share an identifier.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rootweave.operators.skew import hot_keys, hot_limit, salt_groups, skew_join
from rootweave.sources.fs import Folder
from rootweave.workspace import Workspace, count_while_writing, deal


# Rounds without fewer edges after which the contraction is given up; each round should have fewer.
PATIENCE = 10


class NotConverged(RuntimeError):
    """The rounds made no progress; no partial result is returned."""


@dataclass(frozen=True)
class Components:
    """``labels(rel_id, component_id)`` for every entity, staged.

    ``hot`` lists the few components that hold a large share of all entities, so that
    joins on ``component_id`` can spread them. ``rounds`` is how many were needed. ``marked`` are the labels of
    the entities in ``isolated``, the frame that was given under that name.
    """

    labels: DataFrame
    hot: DataFrame
    entities: int
    rounds: int
    isolated: DataFrame | None = None
    marked: DataFrame | None = None


def connected_components(
    edges: DataFrame,
    ws: Workspace,
    isolated: DataFrame | None = None,
    entity_hash=F.xxhash64,
    rows: int | None = None,
) -> Components:
    """Label every entity of ``edges(rel_id, id_key)`` with its component.

    ``isolated(rel_id)`` adds entities that may have no edge at all. ``component_id``
    is a number that no two components share. ``rows`` says how many rows both have together if they are
    files already; otherwise they are staged first. Repeated rows do no harm.
    """
    pairs = edges.select("rel_id", "id_key", F.lit(False).alias("isolated"))
    if isolated is not None:
        pairs = pairs.unionByName(isolated.select("rel_id", F.lit(None).cast("string").alias("id_key"), F.lit(True).alias("isolated")))
    if rows is None:
        pairs, counted = ws.stage_counted(pairs, "pairs")
        rows = counted["rows"]
    ws.expect(rows)

    # Entities are numbered by a hash, so that the rounds move 64-bit numbers only.
    # Should two entities share a number, the labels show it and numbering is repeated.
    number = entity_hash(F.col("rel_id")).cast("bigint")
    # Only names move, the numbers follow from them.
    names = pairs.groupBy("rel_id").agg(F.max("isolated").alias("isolated"))
    labels, seen, rounds = label(pairs.withColumn("v", number), names.withColumn("v", number), rows, ws)
    if seen["clashes"]:
        apart = number_apart(pairs, ws, entity_hash)
        numbered = skew_join(pairs, apart, "rel_id", hot_keys(pairs, "rel_id", rows))
        labels, seen, rounds = label(numbered, names.join(apart, "rel_id"), rows, ws)
    found = labels.select("rel_id", "component_id")
    hot = hot_keys(found, "component_id", seen["rows"])
    return Components(found, hot, seen["rows"], rounds, isolated, labels.filter("isolated").select("rel_id", "component_id"))


def label(pairs: DataFrame, names: DataFrame, rows: int, ws: Workspace) -> tuple[DataFrame, dict, int]:
    """Labels of ``pairs(rel_id, id_key, v)``, what was counted, and the rounds it took. ``names(rel_id, v, isolated)`` are its entities."""
    edges, seen = star_edges(pairs, rows, ws)
    levels = contract(edges, seen["rows"], ws, Rounds(ws, seen) if ws.name else None)
    names = names.groupBy("v").agg(
        F.min("rel_id").alias("rel_id"), F.max("rel_id").alias("last"), F.max("isolated").alias("isolated")
    )
    if levels:
        names = names.join(follow(levels), "v", "left")
    else:
        names = names.withColumn("root", F.col("v"))
    labels, seen = ws.stage_counted(
        names.select("rel_id", F.coalesce("root", "v").alias("component_id"), "isolated", "last"),
        "labels",
        clashes=F.count_if(F.col("rel_id") != F.col("last")),
    )
    return labels.drop("last"), seen, len(levels)


def number_apart(pairs: DataFrame, ws: Workspace, entity_hash) -> DataFrame:
    """(rel_id, v) with entities that share a hash moved to other numbers until none do."""
    names = ws.stage(
        pairs.select("rel_id").distinct().withColumn("v", entity_hash(F.col("rel_id")).cast("bigint")), "names"
    )
    attempt = 0
    while True:
        clashes, found = ws.stage_counted(names.groupBy("v").count().filter("count > 1").select("v"), "clashes")
        if not found["rows"]:
            return names
        attempt += 1
        moved = F.when(F.col("clash"), F.xxhash64("rel_id", F.lit(attempt))).otherwise(F.col("v"))
        names = ws.stage(
            names.join(clashes.withColumn("clash", F.lit(True)), "v", "left").select("rel_id", moved.alias("v")),
            "names",
        )


def star_edges(pairs: DataFrame, rows: int, ws: Workspace) -> tuple[DataFrame, dict]:
    """Replace the entities on each identifier by links to the smallest of them; the edges, and what was counted.

    An identifier with n entities gives n - 1 edges (a, b); one with a single entity
    gives none and does not take part in the join. Without hot identifiers the rows are dealt to them once: the
    smallest entities and the join with these read the same shuffle. Otherwise the join spreads the hot ones.
    """
    keyed = pairs.filter("id_key IS NOT NULL AND v IS NOT NULL").select("id_key", "v")
    hubs, found = ws.stage_counted(hot_keys(keyed, "id_key", rows), "hubs")
    dealt = keyed if found["rows"] else deal(keyed, rows, "id_key")
    centres = dealt.groupBy("id_key").agg(F.min("v").alias("centre"), F.max("v").alias("top")).filter("centre < top")
    centres = centres.select("id_key", "centre")
    met = skew_join(dealt, centres, "id_key", hubs) if found["rows"] else dealt.join(centres.hint("shuffle_hash"), "id_key")
    spokes = (
        met.filter("v <> centre")
        .select(F.col("centre").alias("a"), F.col("v").alias("b"))
        .distinct()
    )
    h = F.xxhash64("a", "b")
    return ws.stage_counted(spokes, "edges", low=F.sum(h.bitwiseAND(F.lit(0xFFFFFFFF))), high=F.sum(F.shiftright(h, 32)))


@dataclass(frozen=True)
class Level:
    """``links(v, parent)`` of one round, and the vertices with very many edges, if any.

    A vertex has at most one child more than it has edges, so the same list covers the
    hot parents.
    """

    links: DataFrame
    hot: DataFrame | None

    def join(self, big: DataFrame, other: DataFrame, key: str, how: str = "inner") -> DataFrame:
        hot = None if self.hot is None else self.hot.withColumnRenamed("v", key)
        return skew_join(big, other, key, hot, how)

    def targets(self) -> DataFrame:
        """(v, target): two pointers on from each vertex."""
        onward = self.links.select(F.col("v").alias("parent"), F.col("parent").alias("target"))
        return self.join(self.links, onward, "parent").select("v", "target")


class Rounds:
    """The finished rounds of a contraction, listed in small files of a named workspace.

    A run that is cut short leaves them; the next run on the same edges goes on after the last one. Whether the edges
    are the same is told by their number and the sums of their hashes.
    """

    def __init__(self, ws: Workspace, seen: dict):
        self.ws = ws
        self.start = [seen["rows"], seen["low"], seen["high"]]
        self.folder = Folder(ws.spark, f"{ws.base}/rounds")
        self.folder.make()

    def finished(self) -> list[dict]:
        found = [self.folder.load(name) for name in self.folder.names("round-*.json")]
        return found if all(entry["start"] == self.start for entry in found) else []

    def add(self, number: int, **entry) -> None:
        if number == 0:
            for name in self.folder.names("round-*.json"):
                self.folder.delete(name)
        self.folder.save(f"round-{number:04d}.json", {"start": self.start, **entry})


LINKS = "v bigint, parent bigint, degree bigint"
EDGES = "a bigint, b bigint"


def contract(edges: DataFrame, rows: int, ws: Workspace, rounds: Rounds | None = None) -> list[Level]:
    """Contract ``edges(a, b)`` until none is left; one level per round. ``rounds`` lists those done before."""
    levels: list[Level] = []
    fewest, stalled = rows, 0
    read = ws.spark.read
    for done in rounds.finished() if rounds else []:
        links = read.schema(LINKS).parquet(done["links"])
        levels.append(_level(links, done["from"], done["hot"]))
        edges, rows, fewest, stalled = read.schema(EDGES).parquet(done["edges"]), done["rows"], done["fewest"], done["stalled"]
    while rows:
        if stalled == PATIENCE:
            raise NotConverged(f"still {rows} edges after {PATIENCE} rounds without progress")
        # Vertex numbers are hashes, so a rotation of their bits is a fresh random order.
        # Each order serves two rounds: the first gathers stars around its local minima
        # and the second absorbs them.
        turn = 17 * (len(levels) // 2) % 64
        started = rows
        links_path, edges_path = ws.new_path("links"), ws.new_path("edges")
        counted, seen = count_while_writing(pointers(edges, turn), hot=F.count_if(F.col("degree") > hot_limit(rows)))
        counted.write.parquet(links_path)
        hot = seen.get["hot"]
        level = _level(read.schema(LINKS).parquet(links_path), started, hot)
        levels.append(level)
        counted, seen = count_while_writing(contracted(edges, level))
        counted.write.parquet(edges_path)
        edges, rows = read.schema(EDGES).parquet(edges_path), seen.get["rows"]
        stalled = 0 if rows < fewest else stalled + 1
        fewest = min(fewest, rows)
        if rounds:
            rounds.add(len(levels) - 1, links=links_path, edges=edges_path, rows=rows, hot=hot, fewest=fewest, stalled=stalled, **{"from": started})
    return levels


def _level(links: DataFrame, rows: int, hot: int) -> Level:
    # All degrees add up to twice the edges, which bounds the list of hot vertices.
    busy = links.filter(F.col("degree") > hot_limit(rows)).select("v", salt_groups("degree"))
    return Level(links.select("v", "parent"), busy if hot else None)


def pointers(edges: DataFrame, turn: int) -> DataFrame:
    """(v, parent, degree): the smallest of each vertex and its neighbours in the turned order."""
    ends = edges.select(
        F.inline(F.array(
            F.struct(F.col("a").alias("v"), F.col("b").alias("w")),
            F.struct(F.col("b").alias("v"), F.col("a").alias("w")),
        ))
    )
    nearest = ends.groupBy("v").agg(
        F.min(rotate(F.col("w"), turn)).alias("least"), F.count(F.lit(1)).alias("degree")
    )
    parent = rotate(F.least("least", rotate(F.col("v"), turn)), -turn)
    return nearest.select("v", parent.alias("parent"), "degree")


def contracted(edges: DataFrame, level: Level) -> DataFrame:
    """The edges that still connect different groups, each once."""
    targets = level.targets()
    for end in ("a", "b"):
        moved = targets.select(F.col("v").alias(end), F.col("target").alias(f"new_{end}"))
        edges = level.join(edges, moved, end)  # the old ends stay, so that equal new ends are spread too
    return (
        edges.filter("new_a <> new_b")
        .select(F.least("new_a", "new_b").alias("a"), F.greatest("new_a", "new_b").alias("b"))
        .distinct()
    )


def rotate(number: Column, bits: int) -> Column:
    """Rotate the bits of a 64-bit number to the left; negative counts turn it back."""
    bits %= 64
    if bits == 0:
        return number
    return F.shiftleft(number, bits).bitwiseOR(F.shiftrightunsigned(number, 64 - bits))


def follow(levels: list[Level]) -> DataFrame:
    """(v, root): where each vertex ended up, resolved from the last round back to the first."""
    roots = levels[-1].targets().select("v", F.col("target").alias("root"))
    for level in reversed(levels[:-1]):
        # Two pointers lead to the target, whose root is known from the later rounds.
        onward = level.join(level.links, roots.withColumnRenamed("v", "parent"), "parent", "left").select(
            F.col("v").alias("parent"), F.coalesce("root", "parent").alias("root")
        )
        roots = level.join(level.links, onward, "parent").select("v", "root")
    return roots


def named_components(found: Components) -> DataFrame:
    """(rel_id, component_id) with each component named after its smallest entity."""
    names = found.labels.groupBy("component_id").agg(F.min("rel_id").alias("name"))
    return skew_join(found.labels, names, "component_id", found.hot).select(
        "rel_id", F.col("name").alias("component_id")
    )
