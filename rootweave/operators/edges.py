"""From history tables to the entity–identifier graph and its seeds."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rootweave.config import CURRENT, EdgeSource, MappingConfig
from rootweave.functions.rules import key_as_string, not_blank, open_ended

EDGE_COLUMNS = ["source_table", "rel_id", "id_key"]


def load_sources(spark: SparkSession, cfg: MappingConfig) -> dict[str, DataFrame]:
    """The source tables of a configuration, by source name."""
    return {s.name: spark.table(f"{cfg.source_db}.{s.table}") for s in cfg.sources}


def open_rows(df: DataFrame, source: EdgeSource) -> DataFrame:
    return df.filter(open_ended(source.valid_to_col, df.schema[source.valid_to_col].dataType))


def current_rows(df: DataFrame, source: EdgeSource) -> DataFrame:
    """Open-ended rows that are not soft-deleted."""
    rows = open_rows(df, source)
    if source.deleted_col is None:
        return rows
    return rows.filter(F.col(source.deleted_col) == source.kept_value)


def tagged_pairs(df: DataFrame, source: EdgeSource) -> DataFrame:
    """(source_table, rel_id, id_key) of a source, keys as text."""
    return df.select(
        F.lit(source.name).alias("source_table"),
        key_as_string(source.entity_col).alias("rel_id"),
        key_as_string(source.key_col).alias("id_key"),
    )


def edge_rows(tables: Mapping[str, DataFrame], cfg: MappingConfig) -> DataFrame:
    """All usable edges of the configured scope, not yet deduplicated."""
    parts = []
    for source in cfg.sources:
        df = tables[source.name]
        rows = current_rows(df, source) if cfg.edge_scope == CURRENT else df
        parts.append(tagged_pairs(rows, source))
    return reduce(DataFrame.unionByName, parts).filter(not_blank("rel_id", "id_key"))


def build_edges(tables: Mapping[str, DataFrame], cfg: MappingConfig) -> DataFrame:
    """The distinct tagged edges of the configured scope."""
    return edge_rows(tables, cfg).distinct()


def untagged(edges: DataFrame) -> DataFrame:
    return edges.select("rel_id", "id_key").distinct()


def active_seeds(tables: Mapping[str, DataFrame], cfg: MappingConfig) -> DataFrame:
    """Entities flagged as a root in an open-ended row."""
    source, rule = cfg.seed_source, cfg.seed_rule
    return (
        open_rows(tables[source.name], source)
        .filter(F.col(rule.flag_col) == rule.flag_value)
        .select(key_as_string(source.entity_col).alias("seed_rel_id"))
        .filter(F.col("seed_rel_id").isNotNull())
        .distinct()
    )
