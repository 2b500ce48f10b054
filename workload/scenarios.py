"""Eleven changes to the history tables, each refreshed incrementally.

Every case starts from the refreshed NOW state and returns the rows of the mapping that it
inserted and removed. The same change is written once as SQL per table: what to append, and
which column to update where. The reference SQL solves the whole graph before and after.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rootweave.config import MappingConfig
from rootweave.plans.refresh import refresh_mapping
from rootweave.plans.scenario import Scenario, run_scenario
from rootweave.sources.tables import append_rows, update_where
from rootweave.workspace import Workspace
from workload import oracles as sql
from workload.views import NOW, config, create_tables, load, on_spark

OPEN = "TIMESTAMP '9999-12-31 00:00:00'"
CHANGED_AT = "TIMESTAMP '2024-02-29 12:30:00'"


@dataclass(frozen=True)
class Change:
    """Rows to append, or ``column = value WHERE condition``, for one history table."""

    table: str
    rows: str | None = None
    column: str | None = None
    value: str | None = None
    condition: str | None = None


def register_rows(entity: str, key: str, flag: str, source: str) -> Change:
    return Change("register", rows=f"""
        SELECT {entity} AS rel_id, {CHANGED_AT} AS valid_from, {OPEN} AS valid_to, {key} AS id_key, '{flag}' AS active_f
        FROM {source}""")


def link_rows(entity: str, key: str, source: str) -> Change:
    return Change("link", rows=f"""
        SELECT {entity} AS rel_id, {CHANGED_AT} AS valid_from, {OPEN} AS valid_to, {key} AS id_key, 'N' AS del_f
        FROM {source}""")


def shifted(column: str, by: int) -> str:
    return f"CAST(CAST({column} AS BIGINT) + {by} AS STRING)"


CUSTOMER = shifted("c_custkey", 1_000_000_000)

# Fixed list: the cases in order, with what each of them does.
CASES: dict[str, tuple[Change, ...]] = {
    # New active seeds on identifiers of their own.
    "scenario_1": (register_rows(CUSTOMER, "'new-' || CAST(c_custkey AS STRING)", "Y", "customer"),),
    # Seeds switched off.
    "scenario_2": (Change("register", column="active_f", value="'N'", condition=f"""
        active_f = 'Y' AND valid_to = {OPEN} AND valid_from < TIMESTAMP '1995-09-01 00:00:00'"""),),
    # Links handed to other entities.
    "scenario_3": (Change("link", column="rel_id", value=shifted("rel_id", 5_000_000_000), condition="""
        valid_from >= TIMESTAMP '2001-03-01 00:00:00'"""),),
    # No change.
    "scenario_4": (),
    # A further identifier for entities that have one already.
    "scenario_5": (link_rows("rel_id", "'alt-' || rel_id", f"register WHERE active_f = 'Y' AND valid_to = {OPEN}"),),
    # Every open link recorded a second time.
    "scenario_6": (Change("link", rows=f"""
        SELECT rel_id, valid_from, valid_to, id_key, del_f FROM link WHERE valid_to = {OPEN}"""),),
    # New entities on identifiers that are in use.
    "scenario_7": (link_rows(shifted("rel_id", 2_000_000_000), "id_key", f"""
        register WHERE valid_to = {OPEN} AND valid_from < TIMESTAMP '1996-01-01 00:00:00'"""),),
    # New seeds and new links to them at the same time.
    "scenario_8": (
        register_rows(CUSTOMER, "'cross-' || CAST(c_custkey AS STRING)", "Y", "customer"),
        link_rows(shifted("c_custkey", 3_000_000_000), "'cross-' || CAST(c_custkey AS STRING)", "customer"),
    ),
    # New entities in both tables that reach existing seeds, none of them a seed.
    "scenario_9": (
        register_rows(shifted("rel_id", 4_000_000_000), "id_key", "N", f"""
            link WHERE valid_to = {OPEN} AND valid_from < TIMESTAMP '1995-09-01 00:00:00'"""),
        link_rows(shifted("rel_id", 6_000_000_000), "id_key", f"""
            link WHERE valid_to = {OPEN} AND valid_from < TIMESTAMP '1995-09-01 00:00:00'"""),
    ),
    # Open links closed, and closed register rows reopened.
    "scenario_10": (
        Change("link", column="valid_to", value="valid_from", condition=f"""
            valid_to = {OPEN} AND valid_from < TIMESTAMP '1995-09-01 00:00:00'"""),
        Change("register", column="valid_to", value=OPEN, condition=f"""
            valid_to < {OPEN} AND valid_from < TIMESTAMP '1995-07-01 00:00:00'"""),
    ),
    # Links moved to another identifier.
    "scenario_11": (Change("link", column="id_key", value="substr(id_key, 1, length(id_key) - 1) || 'A'", condition="""
        valid_from >= TIMESTAMP '2001-03-01 00:00:00'"""),),
}


def frame(spark: SparkSession, sf_dir: str, cfg: MappingConfig, change: Change) -> DataFrame:
    """The rows a change appends, read before any change of its case is made."""
    tables = {name: spark.table(f"{cfg.source_db}.{name}") for name in ("register", "link")}
    return on_spark(spark, change.rows, customer=load(spark, sf_dir, "customer"), **tables)


def apply(changes: tuple[Change, ...], sf_dir: str, ws: Workspace, spark: SparkSession, cfg: MappingConfig) -> None:
    appended = [(c, ws.stage(frame(spark, sf_dir, cfg, c), "rows")) for c in changes if c.rows]
    for change, rows in appended:
        append_rows(rows, f"{cfg.source_db}.{change.table}")
    for change in changes:
        if change.column:
            text = (t.replace("TIMESTAMP '", "TIMESTAMP_NTZ '") for t in (change.condition, change.value))
            update_where(spark, f"{cfg.source_db}.{change.table}", change.column, *map(F.expr, text))


def baseline(spark: SparkSession, sf_dir: str, ws: Workspace) -> MappingConfig:
    """Tables and state after a first refresh."""
    db = ws.scratch_database()
    cfg = config("current", db, state_db=ws.scratch_database())
    create_tables(spark, sf_dir, db)
    refresh_mapping(spark, cfg)
    return cfg


def run_case(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = Workspace(spark)
    cfg = baseline(spark, sf_dir, ws)
    scenario = Scenario(name, partial(apply, CASES[name], sf_dir, ws))
    result = run_scenario(spark, cfg, scenario, ws)
    if not result.passed:
        raise AssertionError(result.row())
    return result.delta


def changed_table(table: str, columns: list[str], changes: tuple[Change, ...]) -> str:
    """CTE ``new_<table>``: a history table after the changes of a case."""
    updates = {c.column: f"CASE WHEN {c.condition} THEN {c.value} ELSE {c.column} END"
               for c in changes if c.table == table and c.column}
    select = ", ".join(f"{updates[c]} AS {c}" if c in updates else c for c in columns)
    parts = [f"SELECT {select} FROM {table}"] + [c.rows for c in changes if c.table == table and c.rows]
    return f"new_{table} AS ({' UNION ALL '.join(parts)})"


def oracle(changes: tuple[Change, ...]) -> str:
    columns = ["rel_id", "valid_from", "valid_to", "id_key"]
    extra = ",\n".join([
        changed_table("register", [*columns, "active_f"], changes),
        changed_table("link", [*columns, "del_f"], changes),
        sql.graph("b_", "current"),
        sql.graph("", "current", "new_register", "new_link"),
    ])
    return sql.with_history(NOW, extra=extra, body="""
        SELECT 'inserted' AS kind, * FROM (SELECT * FROM mapping EXCEPT SELECT * FROM b_mapping)
        UNION ALL SELECT 'removed', * FROM (SELECT * FROM b_mapping EXCEPT SELECT * FROM mapping)""")


QUERIES = {name: partial(run_case, name) for name in CASES}
ORACLES = {name: oracle(changes) for name, changes in CASES.items()}
