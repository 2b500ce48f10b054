"""Entity mapping over validity-dated history tables, on Spark."""

from rootweave.config import CURRENT, HISTORY, EdgeSource, MappingConfig, SeedRule, bank_party_config
from rootweave.operators.components import Components, NotConverged, connected_components
from rootweave.operators.edges import active_seeds, build_edges, load_sources
from rootweave.operators.mapping import assign_roots, closure_pairs, expand_component, full_mapping
from rootweave.plans.rebuild import rebuild_mapping
from rootweave.plans.refresh import RunStats, refresh_mapping
from rootweave.plans.scenario import Scenario, run_scenario, run_sequence
from rootweave.workspace import Workspace

__all__ = [
    "CURRENT", "HISTORY", "Components", "EdgeSource", "MappingConfig", "NotConverged", "RunStats", "Scenario",
    "SeedRule", "Workspace", "active_seeds", "assign_roots", "bank_party_config", "build_edges", "closure_pairs",
    "connected_components", "expand_component", "full_mapping", "load_sources", "rebuild_mapping",
    "refresh_mapping", "run_scenario", "run_sequence",
]
