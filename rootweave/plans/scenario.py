"""Mutate the sources, refresh, and compare what changed with what should have changed."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rootweave.config import MappingConfig
from rootweave.operators.checks import delta_check, uniqueness
from rootweave.operators.delta import pair_delta
from rootweave.plans.refresh import RunStats, refresh_mapping
from rootweave.workspace import Workspace

LOGIC = "logic"
PRECONDITION = "data precondition"
RESULT_SCHEMA = "case string, passed boolean, inserted bigint, removed bigint, cause string"


@dataclass(frozen=True)
class Scenario:
    """One step of an evolving data set.

    ``mutate`` changes the source tables. ``expected(kind, entity, root)`` is the exact
    delta of the output, or None if only uniqueness is checked. ``needs`` are rows that
    have to exist before the mutation for the case to mean anything.
    """

    case: str
    mutate: Callable[[SparkSession, MappingConfig], None]
    expected: DataFrame | None = None
    needs: tuple[DataFrame, ...] = ()


@dataclass(frozen=True)
class ScenarioResult:
    delta: DataFrame
    stats: RunStats | None
    passed: bool
    cause: str | None
    inserted: int
    removed: int
    case: str

    def row(self) -> tuple:
        return (self.case, self.passed, self.inserted, self.removed, self.cause)


def current_output(spark: SparkSession, cfg: MappingConfig) -> DataFrame:
    return spark.table(cfg.output).select(cfg.entity_out, cfg.root_out)


def run_scenario(spark: SparkSession, cfg: MappingConfig, scenario: Scenario, ws: Workspace) -> ScenarioResult:
    """Run one step on top of the current state. The delta lives in the workspace."""
    before = ws.stage(current_output(spark, cfg), "before")
    if any(rows.isEmpty() for rows in scenario.needs):
        nothing = pair_delta(before, before.limit(0)).limit(0)
        return ScenarioResult(nothing, None, False, PRECONDITION, 0, 0, scenario.case)

    scenario.mutate(spark, cfg)
    stats = refresh_mapping(spark, cfg)
    after = current_output(spark, cfg)
    delta, seen = ws.stage_counted(
        pair_delta(before, after), "delta",
        inserted=F.count_if(F.col("kind") == "inserted"), removed=F.count_if(F.col("kind") == "removed"),
    )
    counts = uniqueness(after).first()
    good = counts.total_rows == counts.distinct_rows and not counts.ambiguous_entities
    if good and scenario.expected is not None:
        good = delta_check(before, after, scenario.expected).isEmpty()
    return ScenarioResult(
        delta, stats, good, None if good else LOGIC, seen["inserted"], seen["removed"], scenario.case
    )


def run_sequence(spark: SparkSession, cfg: MappingConfig, steps: list[Scenario], ws: Workspace) -> DataFrame:
    """(case, passed, inserted, removed, cause) of steps that build on each other."""
    return spark.createDataFrame([run_scenario(spark, cfg, s, ws).row() for s in steps], RESULT_SCHEMA)
