"""Building blocks of the reference SQL: the graph questions as recursive queries."""

from __future__ import annotations

from workload.views import BEFORE, NOW, history_sql


def with_history(*states: str, extra: str = "", body: str) -> str:
    """``body`` with both history tables of each state; BEFORE tables end in ``_before``."""
    ctes = []
    for state in states:
        suffix = "" if state == NOW else "_before"
        for source in ("register", "link"):
            ctes.append(f"{source}{suffix} AS ({history_sql(source, state)})")
    if extra:
        ctes.append(extra)
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n" + body


def edges(name: str, scope: str, register: str = "register", link: str = "link") -> str:
    """CTE of the distinct tagged edges."""
    is_open = "valid_to >= TIMESTAMP '9999-12-31'"
    of_register = f"WHERE {is_open}" if scope == "current" else ""
    of_link = f"WHERE {is_open} AND del_f = 'N'" if scope == "current" else ""
    return f"""{name} AS (
        SELECT DISTINCT * FROM (
            SELECT 'register' AS source_table, rel_id, id_key FROM {register} {of_register}
            UNION ALL
            SELECT 'link', rel_id, id_key FROM {link} {of_link}
        ) WHERE trim(rel_id) <> '' AND trim(id_key) <> '')"""


def seeds(name: str, register: str = "register") -> str:
    return f"""{name} AS (
        SELECT DISTINCT rel_id AS seed_rel_id FROM {register}
        WHERE active_f = 'Y' AND valid_to >= TIMESTAMP '9999-12-31')"""


def closure(prefix: str, edge_cte: str, seed_cte: str) -> str:
    """CTEs ``<prefix>reach(seed_rel_id, rel_id)`` and ``<prefix>mapping(rel_id, root_id)``."""
    return f"""{prefix}near AS (
        SELECT DISTINCT a.rel_id AS x, b.rel_id AS y FROM {edge_cte} a JOIN {edge_cte} b ON a.id_key = b.id_key),
    {prefix}reach(seed_rel_id, rel_id) AS (
        SELECT seed_rel_id, seed_rel_id FROM {seed_cte}
        UNION
        SELECT r.seed_rel_id, n.y FROM {prefix}reach r JOIN {prefix}near n ON n.x = r.rel_id),
    {prefix}mapping AS (
        SELECT rel_id, CAST(min(CAST(seed_rel_id AS BIGINT)) AS STRING) AS root_id
        FROM {prefix}reach GROUP BY rel_id)"""


def graph(prefix: str, scope: str, register: str = "register", link: str = "link") -> str:
    """Edges, seeds and closure of one state."""
    e, s = f"{prefix}edges", f"{prefix}seeds"
    return ",\n".join([edges(e, scope, register, link), seeds(s, register), closure(prefix, e, s)])


def two_states(body: str, extra: str = "") -> str:
    """``body`` over the current-scope graphs of NOW and, with prefix ``b_``, BEFORE."""
    parts = [graph("", "current"), graph("b_", "current", "register_before", "link_before")]
    return with_history(NOW, BEFORE, extra=",\n".join(parts + ([extra] if extra else [])), body=body)


MOVED = """moved AS (
        (SELECT * FROM edges EXCEPT SELECT * FROM b_edges)
        UNION ALL (SELECT * FROM b_edges EXCEPT SELECT * FROM edges))"""

START = f"""{MOVED},
    start_set AS (
        SELECT rel_id FROM moved
        UNION SELECT min(rel_id) FROM b_edges WHERE id_key IN (SELECT id_key FROM moved) GROUP BY id_key
        UNION (SELECT seed_rel_id FROM seeds EXCEPT SELECT seed_rel_id FROM b_seeds)
        UNION (SELECT seed_rel_id FROM b_seeds EXCEPT SELECT seed_rel_id FROM seeds))"""

REGION = f"""{START},
    region(rel_id) AS (
        SELECT rel_id FROM start_set
        UNION SELECT n.y FROM region r JOIN b_near n ON n.x = r.rel_id)"""

ONE_STEP = """member AS (
        SELECT m.rel_id, min(s.seed_rel_id) AS root_id
        FROM seeds s JOIN edges e ON e.rel_id = s.seed_rel_id JOIN edges m ON m.id_key = e.id_key
        GROUP BY m.rel_id)"""
