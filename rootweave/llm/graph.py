"""Components of numbered vertices, named after their smallest member."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rootweave.operators.components import contract, follow
from rootweave.workspace import Workspace


def components(links: DataFrame, ws: Workspace) -> DataFrame:
    """(v, root) for every vertex of ``links(a, b)``; ``root`` is the smallest vertex that can be reached."""
    edges, counted = ws.stage_counted(
        links.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links"
    )
    if not counted["rows"]:
        return edges.select(F.col("a").alias("v"), F.col("b").alias("root"))
    groups = ws.stage(follow(contract(edges, counted["rows"], ws)), "groups")
    names = groups.groupBy("root").agg(F.min("v").alias("name"))
    return ws.stage(groups.join(names, "root").select("v", F.col("name").alias("root")), "roots")
