"""Dense numbers for the rows of a list that no driver could hold."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rootweave.workspace import PARTITIONS_SETTING, Workspace


def dense_numbers(rows: DataFrame, order_by: list[str], ws: Workspace, start: int = 0, column: str = "v") -> tuple[DataFrame, int]:
    """``rows`` with ``column``, numbers from ``start`` on without gaps in the order of ``order_by``; and how many rows there are.

    The rows are dealt to ranges of the order and sorted there. A number is the row's place in its range
    plus the sizes of the ranges before, so it is exact, and no two rows share one. Rows that are equal in all of
    ``order_by`` share a range and follow each other in any order, fixed once the result is written.
    """
    width = int(rows.sparkSession.conf.get(PARTITIONS_SETTING))
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    dealt = rows.repartitionByRange(width, *order_by).sortWithinPartitions(*order_by).withColumns(
        {"_range": F.spark_partition_id(), "_place": place}
    )
    placed, counted = ws.stage_counted(dealt, "places")
    # One row for each range, of which there are as many as the shuffle has partitions.
    sizes = placed.groupBy("_range").count()
    before = sizes.select("_range", (F.sum("count").over(Window.orderBy("_range")) - F.col("count")).alias("_before"))
    number = (F.col("_before") + F.col("_place") + start).cast("bigint")
    return placed.join(F.broadcast(before), "_range").withColumn(column, number).drop("_range", "_place", "_before"), counted["rows"]
