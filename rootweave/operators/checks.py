"""Data-quality checks that return frames instead of collecting rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rootweave.operators.delta import bag_delta, pair_delta


class CheckFailed(AssertionError):
    """A check found rows that break its rule."""


def has_rows(df: DataFrame) -> bool:
    """Stops at the first row found."""
    return not df.isEmpty()


def uniqueness(mapping: DataFrame) -> DataFrame:
    """One row: total rows, distinct rows, and entities with more than one root."""
    entity, root = mapping.columns
    per_entity = mapping.groupBy(entity, root).count().groupBy(entity).agg(
        F.sum("count").alias("n"), F.count(F.lit(1)).alias("roots")
    )
    return per_entity.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum("roots"), F.lit(0)).alias("distinct_rows"),
        F.count_if(F.col("roots") > 1).alias("ambiguous_entities"),
    )


def require_unique(mapping: DataFrame, what: str) -> None:
    found = uniqueness(mapping).first()
    if found.total_rows != found.distinct_rows or found.ambiguous_entities:
        raise CheckFailed(f"{what}: {found.asDict()}")


def delta_check(before: DataFrame, after: DataFrame, expected: DataFrame) -> DataFrame:
    """Rows where the delta and the ``expected(kind, ...)`` delta disagree.

    ``problem`` is 'unexpected' for a change nobody asked for and 'missing' for an
    expected change that did not happen; an exact delta gives no rows.
    """
    found = pair_delta(before, after)
    compared = pair_delta(expected.select(*found.columns).withColumnRenamed("kind", "change"),
                          found.withColumnRenamed("kind", "change"))
    return compared.select(
        F.when(F.col("kind") == "inserted", "unexpected").otherwise("missing").alias("problem"),
        F.col("change").alias("kind"),
        *found.columns[1:],
    )


def golden_compare(computed: DataFrame, golden: DataFrame) -> DataFrame:
    """(kind, ...) rows with multiplicity: 'missing' in computed, or 'extra' there."""
    delta = bag_delta(golden.select(*computed.columns), computed)
    return delta.withColumn("kind", F.when(F.col("kind") == "inserted", "extra").otherwise("missing"))
