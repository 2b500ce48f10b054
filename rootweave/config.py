"""What to link, who may be a root, and where the results live."""

from __future__ import annotations

from dataclasses import dataclass

HISTORY = "history"
CURRENT = "current"


@dataclass(frozen=True)
class EdgeSource:
    """One validity-dated history table that links an entity to a business identifier.

    ``name`` tags the rows taken from it. ``deleted_col`` is set for tables that
    carry a soft-delete flag; a row counts as current when that flag is ``kept_value``.
    """

    name: str
    table: str
    entity_col: str
    key_col: str
    valid_to_col: str
    deleted_col: str | None = None
    kept_value: str = "N"


@dataclass(frozen=True)
class SeedRule:
    """Rows of ``source`` whose flag is set and whose validity is open name the roots."""

    source: str
    flag_col: str
    flag_value: str = "Y"


@dataclass(frozen=True)
class MappingConfig:
    """Everything a rebuild or a refresh needs to know.

    ``edge_scope``: ``history`` links through every row ever recorded, ``current``
    only through open-ended rows that are not soft-deleted.
    ``carry_forward``: on a first refresh, keep the rows already in the output table
    whose entity is not part of the current graph and whose root is active.
    """

    sources: tuple[EdgeSource, ...]
    seed_rule: SeedRule
    source_db: str = "default"
    target_db: str = "default"
    state_db: str = "mapping_state"
    output_table: str = "output"
    entity_out: str = "rel_id"
    root_out: str = "root_id"
    edge_scope: str = CURRENT
    carry_forward: bool = False

    def __post_init__(self) -> None:
        if self.edge_scope not in (HISTORY, CURRENT):
            raise ValueError(f"edge_scope must be '{HISTORY}' or '{CURRENT}', got {self.edge_scope!r}")
        if self.seed_rule.source not in {s.name for s in self.sources}:
            raise ValueError(f"seed rule names an unknown source: {self.seed_rule.source!r}")

    @property
    def seed_source(self) -> EdgeSource:
        return next(s for s in self.sources if s.name == self.seed_rule.source)

    @property
    def output(self) -> str:
        return f"{self.target_db}.{self.output_table}"

    def state(self, table: str) -> str:
        return f"{self.state_db}.{table}"


def bank_party_config(source_db: str, target_db: str, state_db: str, **overrides) -> MappingConfig:
    """Ready-made configuration for the bank-register / link-table layout."""
    # Table and column names of the existing inputs and output.
    register = EdgeSource(
        name="direct_bank", table="direct_bank", entity_col="rel_id",
        key_col="np_sbl_id", valid_to_col="edl_valid_to_dts",
    )
    link = EdgeSource(
        name="ggm_np", table="ggm_np", entity_col="rel_id",
        key_col="ikb_no", valid_to_col="edl_valid_to_dts", deleted_col="del_f",
    )
    settings = {
        "sources": (register, link),
        "seed_rule": SeedRule(source="direct_bank", flag_col="drc_bnk_f"),
        "source_db": source_db,
        "target_db": target_db,
        "state_db": state_db,
        "entity_out": "REL_ID",
        "root_out": "REL_ID_REGIE_KLANT",
    }
    return MappingConfig(**{**settings, **overrides})
