"""Full rebuild of the mapping."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rootweave.config import MappingConfig
from rootweave.operators.checks import require_unique
from rootweave.operators.edges import active_seeds, edge_rows, load_sources
from rootweave.operators.mapping import full_mapping
from rootweave.sources.tables import finish_swap, stage_replacement
from rootweave.workspace import Workspace


def rebuild_mapping(spark: SparkSession, cfg: MappingConfig, ws: Workspace, write: bool = True) -> DataFrame:
    """Compute the mapping of the configured scope from scratch.

    With ``write`` the checked result replaces the output table and is read back from
    there; otherwise it is returned lazily and lives as long as the workspace.
    """
    tables = load_sources(spark, cfg)
    ws.expect(sum(t.count() for t in tables.values()))
    mapping = full_mapping(edge_rows(tables, cfg), active_seeds(tables, cfg), ws)
    result = mapping.select(
        F.col("rel_id").alias(cfg.entity_out), F.col("root_id").alias(cfg.root_out)
    )
    if not write:
        return result
    staged, _ = stage_replacement(spark, cfg.output, result)
    require_unique(staged, cfg.output)
    finish_swap(spark, cfg.output)
    return spark.table(cfg.output)
