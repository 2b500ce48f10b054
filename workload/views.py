"""The mapping problem as it appears in the order tables.

An order is the entity, and an identifier is a part bought in a certain quantity with a
certain return flag. Open line items are the register that can name roots, shipped ones
are the link table. Every line item is an edge. Two states of the tables are defined:
``NOW`` and ``BEFORE`` a correction to the latest shipments that flipped root flags and
soft-delete flags, reopened rows and reassigned identifiers.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from rootweave.config import EdgeSource, MappingConfig, SeedRule

NOW = "now"
BEFORE = "before"

REGISTER = EdgeSource("register", "register", "rel_id", "id_key", "valid_to")
LINK = EdgeSource("link", "link", "rel_id", "id_key", "valid_to", deleted_col="del_f")

# Line items shipped from this day on were corrected between BEFORE and NOW.
CORRECTED = "l_shipdate >= TIMESTAMP '2001-09-15 00:00:00'"


def config(edge_scope: str, database: str = "default", **overrides) -> MappingConfig:
    settings = {
        "sources": (REGISTER, LINK), "seed_rule": SeedRule("register", "active_f"),
        "source_db": database, "target_db": database, "edge_scope": edge_scope,
    }
    return MappingConfig(**{**settings, **overrides})


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def history_sql(source: str, state: str = NOW) -> str:
    """One of the two history tables, in SQL that both engines read (see :func:`on_spark`)."""
    part = "CAST(l_partkey AS STRING) || '-' || CAST(CAST(l_quantity AS INT) AS STRING)"
    if state == NOW:
        key = f"{part} || '-' || l_returnflag"
        root = "o_orderpriority = '1-URGENT'"
        closed = "o_orderstatus = 'P'"
        deleted = "l_discount >= 0.075"
    else:
        key = f"{part} || '-' || CASE WHEN {CORRECTED} AND l_tax < 0.025 THEN 'R' ELSE l_returnflag END"
        root = f"o_orderpriority = CASE WHEN {CORRECTED} THEN '2-HIGH' ELSE '1-URGENT' END"
        closed = f"(o_orderstatus = 'P' OR {CORRECTED} AND o_orderpriority = '5-LOW')"
        deleted = f"l_discount >= CASE WHEN {CORRECTED} THEN 0.045 ELSE 0.075 END"
    flag, flag_col, status = (root, "active_f", "O") if source == "register" else (deleted, "del_f", "F")
    return f"""
        SELECT CAST(l_orderkey AS STRING) AS rel_id,
               l_shipdate AS valid_from,
               CASE WHEN {closed} THEN l_shipdate ELSE TIMESTAMP '9999-12-31 00:00:00' END AS valid_to,
               {key} AS id_key,
               CASE WHEN {flag} THEN 'Y' ELSE 'N' END AS {flag_col}
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        WHERE l_linestatus = '{status}'"""


def on_spark(spark: SparkSession, sql: str, **tables: DataFrame) -> DataFrame:
    """Run SQL with the given frames as its tables; its timestamps have no time zone."""
    for name in tables:
        sql = re.sub(rf"\b(FROM|JOIN)\s+{name}\b", rf"\1 {{{name}}}", sql)
    return spark.sql(sql.replace("TIMESTAMP '", "TIMESTAMP_NTZ '"), **tables)


def history_tables(spark: SparkSession, sf_dir: str, state: str = NOW) -> dict[str, DataFrame]:
    """Both history tables as frames, by source name."""
    inputs = {t: load(spark, sf_dir, t) for t in ("lineitem", "orders")}
    return {s.name: on_spark(spark, history_sql(s.name, state), **inputs) for s in (REGISTER, LINK)}


def create_tables(spark: SparkSession, sf_dir: str, database: str, state: str = NOW) -> None:
    """Materialise both history tables in a database."""
    for name, df in history_tables(spark, sf_dir, state).items():
        df.write.format("parquet").mode("overwrite").saveAsTable(f"{database}.{name}")
