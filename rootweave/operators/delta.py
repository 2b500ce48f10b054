"""Differences between two states."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

INSERTED = "inserted"
REMOVED = "removed"


def presence(before: DataFrame, after: DataFrame) -> DataFrame:
    """Distinct rows of both sides with ``was`` and ``now`` flags.

    One aggregation both removes duplicates and compares: rows are combined before
    they are shuffled, and unchanged rows come along for those who need them.
    """
    columns = before.columns
    marked = before.select(*columns, F.lit(1).alias("was"), F.lit(0).alias("now")).unionByName(
        after.select(*columns, F.lit(0).alias("was"), F.lit(1).alias("now"))
    )
    return marked.groupBy(*columns).agg(
        (F.max("was") == 1).alias("was"),
        (F.max("now") == 1).alias("now"),
    )


def changed(state: DataFrame) -> DataFrame:
    """The rows of a :func:`presence` frame that came or went, with their kind."""
    return state.filter(F.col("was") != F.col("now")).select(
        F.when(F.col("now"), INSERTED).otherwise(REMOVED).alias("kind"),
        *[c for c in state.columns if c not in ("was", "now")],
    )


def pair_delta(before: DataFrame, after: DataFrame) -> DataFrame:
    """(kind, ...) rows that were inserted or removed, as sets."""
    return changed(presence(before, after))


# Copies that one row is repeated into at a time.
REPEAT = 10_000


def signed_multiplicity(before: DataFrame, after: DataFrame) -> DataFrame:
    """Distinct rows with ``copies``, how many more of them ``after`` has than ``before``; equal numbers are left out.

    Each side is read once. Rows are summed up before they are shuffled, so a row that is there very often moves once a task.
    """
    columns = before.columns
    marked = before.select(*columns, F.lit(-1).cast("bigint").alias("copies")).unionByName(
        after.select(*columns, F.lit(1).cast("bigint").alias("copies"))
    )
    return marked.groupBy(*columns).agg(F.sum("copies").alias("copies")).filter("copies <> 0")


def bag_delta(before: DataFrame, after: DataFrame) -> DataFrame:
    """(kind, ...) rows with multiplicity, as ``exceptAll`` in both directions."""
    signed = signed_multiplicity(before, after)
    n = F.abs("copies")
    # In two steps, so that no array is long.
    parts = signed.withColumn("_left", F.explode(F.sequence(F.lit(0).cast("bigint"), n - 1, F.lit(REPEAT).cast("bigint"))))
    rows = parts.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.least(n - F.col("_left"), F.lit(REPEAT)))))
    return rows.select(F.when(F.col("copies") > 0, INSERTED).otherwise(REMOVED).alias("kind"), *before.columns)


def edge_delta(before: DataFrame, after: DataFrame) -> DataFrame:
    """(kind, source_table, rel_id, id_key) of edges that came or went."""
    return pair_delta(before, after)


def seed_delta(before: DataFrame, after: DataFrame) -> DataFrame:
    """(kind, seed_rel_id) of seeds that came or went."""
    return pair_delta(before, after)
