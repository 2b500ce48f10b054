"""Near duplicates among vectors: a forest of random-projection trees with spill overlap.

Each tree splits the vectors again and again by a random direction at the median of a bounded
sample; vectors within a margin of a split go to both sides. The trees are fitted on the driver to
at most ``SAMPLE`` distinct vectors and hold one direction and one threshold per node; every vector
is then sent through all of them. Vectors of a leaf are compared with each other, exactly and in
double precision. Pairs from all trees are united and each links once.

Equal vectors are one point with a weight from the start, so that a vector that stands for a third
of the table costs one comparison. A leaf may still hold very many points, for trees have the depth
of the sample: leaves are cut into blocks of at most ``BLOCK`` points by a hash of the id, and each pair of blocks of a
leaf is one unit of work, so that no task holds more than two blocks. Nothing is capped: every pair
of points in a leaf is compared. Recall comes from the number of trees and the margin; it is
measured in the tests.

Defined cases: vectors that are null, empty or zero, or that hold null or non-finite components link
with nothing and are kept; vectors link with those of their own length only; rows that share an id are one vertex; null
ids link with nothing; labels and other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rootweave.llm.graph import components
from rootweave.workspace import Workspace

SAMPLE = 20_000
LEAF = 200  # sampled points in a leaf, before the spill
TREES = 10
SPILL = 0.05  # share of a node's sample on each side of the median that goes both ways
BLOCK = 1_000


@dataclass
class Tree:
    """Nodes in preorder: direction, limits of the spill zone, and the right child; leaves have none."""

    direction: np.ndarray  # node x dimension
    low: np.ndarray
    high: np.ndarray
    left: np.ndarray
    right: np.ndarray

    def leaves(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(point, leaf) of every leaf that a point falls into."""
        at, where = [], []
        stack = [(0, np.arange(len(points)))]
        while stack:
            node, rows = stack.pop()
            if not len(rows):
                continue
            if self.left[node] < 0:
                at.append(rows)
                where.append(np.full(len(rows), node))
                continue
            x = points[rows] @ self.direction[node]
            stack.append((self.left[node], rows[x <= self.high[node]]))
            stack.append((self.right[node], rows[x >= self.low[node]]))
        if not at:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return np.concatenate(at), np.concatenate(where)


def grow(sample: np.ndarray, rng: np.random.Generator, leaf: int, spill: float) -> Tree:
    """One tree; directions are differences of two sampled points, so that splits follow the data."""
    nodes: list[list] = []

    def split(rows: np.ndarray) -> int:
        number = len(nodes)
        nodes.append([np.zeros(sample.shape[1]), 0.0, 0.0, -1, -1])
        if len(rows) <= leaf:
            return number
        a, b = rng.choice(len(rows), 2, replace=False)
        direction = sample[rows[a]] - sample[rows[b]]
        norm = np.linalg.norm(direction)
        direction = direction / norm if norm > 0 else rng.standard_normal(sample.shape[1])
        x = sample[rows] @ direction
        low, middle, high = np.quantile(x, [0.5 - spill, 0.5, 0.5 + spill])
        first, second = rows[x <= high], rows[x >= low]
        if len(first) == len(rows) or len(second) == len(rows):
            return number  # the points cannot be told apart
        nodes[number][:3] = direction, low, high
        nodes[number][3] = split(first)
        nodes[number][4] = split(second)
        return number

    split(np.arange(len(sample)))
    return Tree(*(np.array([node[i] for node in nodes]) for i in range(5)))


def fit(points: DataFrame, count: int, sample: int = SAMPLE, trees: int = TREES, leaf: int = LEAF, spill: float = SPILL, seed: int = 1) -> list[Tree]:
    """A forest on at most ``sample`` of the ``points(_id, unit)``, chosen by a hash of the id."""
    share = min(1.0, sample / max(count, 1))
    chosen = points.filter(F.pmod(F.xxhash64("_id"), F.lit(1 << 30)) < int(share * (1 << 30))).select("_id", "unit")
    rows = sorted(chosen.collect(), key=lambda row: row["_id"])
    if not rows:
        return []
    matrix = np.array([row["unit"] for row in rows])
    rng = np.random.default_rng(seed)
    return [grow(matrix, rng, leaf, spill) for _ in range(trees)]


def _unit(vectors: DataFrame, vector_col: str) -> DataFrame:
    """Adds ``unit``, the vector in double precision at length one, or null if it cannot link."""
    x = F.col(vector_col).cast("array<double>")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    # Scaled by the largest component first, so that squares neither overflow nor vanish.
    largest = F.aggregate(x, F.lit(0.0), lambda m, v: F.greatest(m, F.abs(v)))
    usable = F.when(x.isNotNull() & (F.size(x) > 0) & finite, F.when(largest > 0, F.transform(x, lambda v: v / largest)))
    scaled = vectors.withColumn("_scaled", usable)
    length = F.sqrt(F.aggregate("_scaled", F.lit(0.0), lambda s, v: s + v * v))
    return scaled.withColumn("_length", length).withColumn("unit", F.transform("_scaled", lambda v: v / F.col("_length"))).drop(
        "_scaled", "_length"
    )


def _leaf_rows(points: DataFrame, forest: list[Tree]) -> DataFrame:
    """(tree, leaf, _id, unit) for every leaf of every point."""
    shared = points.sparkSession.sparkContext.broadcast(forest)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            units = np.array(batch.column(1).to_pylist())
            for number, tree in enumerate(shared.value):
                at, leaf = tree.leaves(units)
                taken = batch.take(pa.array(at))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), number, np.int32)), pa.array(leaf.astype(np.int32)), taken.column(0), taken.column(1)],
                    names=["tree", "leaf", "_id", "unit"],
                )

    return points.mapInArrow(rows, "tree int, leaf int, _id long, unit array<double>")


def _tiles(leaves: DataFrame) -> DataFrame:
    """Adds ``blocks`` of each leaf and copies each row to the pairs of blocks that its own block is part of."""
    sizes = leaves.groupBy("tree", "leaf").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    # Few rows: the number of trees times that of their leaves, which the sample bounds.
    placed = leaves.join(F.broadcast(sizes), ["tree", "leaf"]).withColumn("block", F.pmod(F.xxhash64("_id"), F.col("blocks")).cast("int"))
    return placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "tree", "leaf", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"), "block", "_id", "unit"
    )


def _compare(limit: float):
    def compare(part: pa.Table) -> pa.Table:
        ids = part["_id"].to_numpy()
        units = np.array(part["unit"].combine_chunks().flatten()).reshape(len(ids), -1)
        block = part["block"].to_numpy()
        x, y = part["x"][0].as_py(), part["y"][0].as_py()
        rows, columns = (np.flatnonzero(block == b) for b in (x, y))
        found_a, found_b = [], []
        for at in range(0, len(rows), 256):
            some = rows[at : at + 256]
            i, j = np.nonzero(units[some] @ units[columns].T >= limit - 1e-9)
            a, b = some[i], columns[j]
            # The product only selects; the sum decides in a fixed order, alike in every tree.
            exact = (units[a] * units[b]).sum(axis=1) >= limit
            a, b = ids[a[exact]], ids[b[exact]]
            found_a.append(np.minimum(a, b)[a != b])
            found_b.append(np.maximum(a, b)[a != b])
        pairs = np.unique(np.column_stack([np.concatenate(found_a), np.concatenate(found_b)]), axis=0) if found_a else np.empty((0, 2), np.int64)
        return pa.table({"a": pa.array(pairs[:, 0], pa.int64()), "b": pa.array(pairs[:, 1], pa.int64())})

    return compare


def _pairs(
    points: DataFrame, count: int, ws: Workspace, cosine: float, trees: int, sample: int, leaf: int, spill: float
) -> DataFrame:
    """(a, b): the ``count`` points(_id, unit) of one length that a forest puts in one leaf and whose cosine is large enough."""
    tiles = _tiles(ws.stage(_leaf_rows(points, fit(points, count, sample, trees, leaf, spill)), "leaves"))
    return tiles.groupBy("tree", "leaf", "x", "y").applyInArrow(_compare(cosine), "a long, b long").select("a", "b")


def near_duplicates(
    vectors: DataFrame, ws: Workspace, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = 0.9,
    trees: int = TREES, sample: int = SAMPLE, leaf: int = LEAF, spill: float = SPILL,
) -> DataFrame:
    """(``id_col``, n_links, component_id, kept) for every row of ``vectors``.

    ``n_links`` counts the other vectors with at least this cosine that were found, ``component_id``
    is the smallest id that links lead to, and ``kept`` marks the rows that carry it.
    """
    plain = ws.stage(_unit(vectors.select(F.col(id_col).cast("long").alias("_id"), F.col(vector_col).alias("_vector")), "_vector").select("_id", "unit"), "units")
    usable = plain.filter("_id IS NOT NULL AND unit IS NOT NULL")
    # Equal directions are one point; its vectors all link with each other.
    points = ws.stage(usable.groupBy("unit").agg(F.min("_id").alias("point"), F.count_distinct("_id").alias("copies")), "points")
    named = points.select(F.col("point").alias("_id"), "unit")
    # Vectors are compared with those of their own length; lengths are at most the root of twice the number of all components.
    found = [
        _pairs(named.filter(F.size("unit") == row["d"]), row["count"], ws, cosine, trees, sample, leaf, spill)
        for row in points.groupBy(F.size("unit").alias("d")).count().orderBy("d").collect()
    ]
    none = usable.select(F.col("_id").alias("a"), F.col("_id").alias("b")).limit(0)
    links = ws.stage(reduce(DataFrame.unionByName, found, none).distinct(), "pairs")
    weights = points.select("point", "copies")
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    beside = both.join(weights.withColumnRenamed("point", "b"), "b").groupBy("a").agg(F.sum("copies").alias("beside"))
    roots = components(links, ws)
    known = points.join(beside.withColumnRenamed("a", "point"), "point", "left").join(roots.withColumnRenamed("v", "point"), "point", "left").select(
        "unit", (F.col("copies") - 1 + F.coalesce("beside", F.lit(0))).alias("n_links"), F.coalesce("root", "point").alias("component_id")
    )
    result = plain.join(known, "unit", "left")
    component = F.when(F.col("_id").isNotNull(), F.coalesce("component_id", "_id"))
    return result.select(
        F.col("_id").alias(id_col), F.when(F.col("_id").isNotNull(), F.coalesce("n_links", F.lit(0))).otherwise(F.lit(0)).alias("n_links"),
        component.alias("component_id"), F.coalesce(component == F.col("_id"), F.lit(True)).alias("kept"),
    )
