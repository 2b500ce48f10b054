"""Projections, filters, joins, aggregates, sorts and set operations, one query each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rootweave.functions import better_root, key_as_long, key_as_string, not_blank, open_ended, table_name_of
from rootweave.operators import checks, delta, edges, hops, numbering
from rootweave.sources.files import preview, temporal_to_string
from rootweave.workspace import Workspace
from workload import oracles as sql
from workload.views import BEFORE, LINK, NOW, REGISTER, config, history_tables, load


def graph(spark: SparkSession, sf_dir: str, scope: str = "current", state: str = NOW):
    """(edges, seeds) of one state of the history tables."""
    tables, cfg = history_tables(spark, sf_dir, state), config(scope)
    return edges.build_edges(tables, cfg), edges.active_seeds(tables, cfg)


def one_step_membership(edge_df: DataFrame, seeds: DataFrame) -> DataFrame:
    staged, by_entity, by_key = hops.hot_edge_keys(edge_df, Workspace(edge_df.sparkSession))
    return hops.one_step_membership(seeds, staged, by_entity, by_key)


def project_alias(spark, sf_dir):
    return load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("entity"), F.col("o_custkey").alias("owner"), F.col("o_orderpriority").alias("priority")
    )


def key_to_string(spark, sf_dir):
    return load(spark, sf_dir, "lineitem").select(
        key_as_string("l_orderkey").alias("rel_id"), key_as_string("l_partkey").alias("id_key")
    )


def key_to_long(spark, sf_dir):
    keys = load(spark, sf_dir, "customer").select(
        "c_custkey", F.when(F.col("c_mktsegment") == "BUILDING", F.col("c_name"))
        .otherwise(key_as_string("c_custkey")).alias("key")
    )
    return keys.select("c_custkey", key_as_long("key").alias("as_long"))


def tag_source(spark, sf_dir):
    tables = history_tables(spark, sf_dir)
    return edges.tagged_pairs(tables["register"], REGISTER).unionByName(edges.tagged_pairs(tables["link"], LINK))


def rename_col(spark, sf_dir):
    return load(spark, sf_dir, "nation").withColumnRenamed("n_name", "nation").select("n_nationkey", "nation")


def flag_filter(spark, sf_dir):
    return load(spark, sf_dir, "customer").filter(F.col("c_mktsegment") == F.lit("BUILDING")).select("c_custkey", "c_name")


def open_ended_rows(spark, sf_dir):
    """Typed and textual form of the same test must agree."""
    register = history_tables(spark, sf_dir)["register"].withColumn("text_to", F.col("valid_to").cast("string"))
    kind = register.schema
    return register.filter(
        open_ended("valid_to", kind["valid_to"].dataType) & open_ended("text_to", kind["text_to"].dataType)
    ).select("rel_id", "id_key", "active_f")


def ts_equals(spark, sf_dir):
    orders = load(spark, sf_dir, "orders")
    day = F.to_timestamp_ntz(F.lit("1998-10-03 00:00:00"))
    return orders.filter(F.col("o_orderdate") == day).select("o_orderkey", "o_custkey")


def drop_blank_keys(spark, sf_dir):
    keys = load(spark, sf_dir, "customer").select(
        key_as_string("c_custkey").alias("rel_id"),
        F.when(F.col("c_mktsegment") == "BUILDING", F.lit("  "))
        .when(F.col("c_mktsegment") == "MACHINERY", F.lit(""))
        .when(F.col("c_mktsegment") == "HOUSEHOLD", F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit(" "), "c_name")).alias("id_key"),
    )
    return keys.filter(not_blank("rel_id", "id_key"))


def case_when(spark, sf_dir):
    return load(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "P", "closed").when(F.col("o_orderpriority") == "1-URGENT", "root")
        .otherwise("member").alias("role"),
    )


def current_rows(spark, sf_dir):
    rows = edges.current_rows(history_tables(spark, sf_dir)["link"], LINK)
    return rows.select("rel_id", "id_key", "del_f")


def temporal_preview(spark, sf_dir):
    return temporal_to_string(load(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"))


def hop_entity_to_key(spark, sf_dir):
    e, s = graph(spark, sf_dir)
    e, by_entity, _ = hops.hot_edge_keys(e, Workspace(spark))
    return hops.entity_to_key(hops.start_frontier(s), e, by_entity)


def hop_key_to_entity(spark, sf_dir):
    e, s = graph(spark, sf_dir)
    e, by_entity, by_key = hops.hot_edge_keys(e, Workspace(spark))
    return hops.key_to_entity(hops.entity_to_key(hops.start_frontier(s), e, by_entity), e, by_key)


def seed_bitmaps(spark, sf_dir):
    """(seeds with numbers, bitmaps of the seeds one identifier away from each entity)."""
    e, s = graph(spark, sf_dir)
    ws = Workspace(spark)
    e, by_entity, by_key = hops.hot_edge_keys(e, ws)
    numbered, _ = numbering.dense_numbers(s, ["seed_rel_id"], ws, start=1)
    return numbered, hops.entity_bitmaps(hops.key_bitmaps(numbered, e, by_entity), e, by_key)


def hop_seed_counts(spark, sf_dir):
    return hops.count_seeds(seed_bitmaps(spark, sf_dir)[1])


def hop_listed_seeds(spark, sf_dir):
    """The pairs of one hop, written out from the bitmaps."""
    numbered, bitmaps = seed_bitmaps(spark, sf_dir)
    return hops.listed_seeds(bitmaps, numbered)


def hop_unseeded(spark, sf_dir):
    e, s = graph(spark, sf_dir)
    e, by_entity, by_key = hops.hot_edge_keys(e, Workspace(spark))
    start = s.select(F.col("seed_rel_id").alias("rel_id"))
    return hops.key_to_entity(hops.entity_to_key(start, e, by_entity), e, by_key)


def anti_one_key(spark, sf_dir):
    _, s = graph(spark, sf_dir)
    return hops.only_new(hop_unseeded(spark, sf_dir), s.select(F.col("seed_rel_id").alias("rel_id")))


def anti_two_keys(spark, sf_dir):
    _, s = graph(spark, sf_dir)
    return hops.only_new(hop_key_to_entity(spark, sf_dir), hops.start_frontier(s))


def removed_seed_members(spark, sf_dir):
    e, before = graph(spark, sf_dir, state=BEFORE)
    _, now = graph(spark, sf_dir)
    removed = before.join(now, "seed_rel_id", "left_anti")
    member = one_step_membership(e, before)
    return member.join(removed, member.root_id == removed.seed_rel_id).select("rel_id").distinct()


def impacted_prev_seeds(spark, sf_dir):
    e, s = graph(spark, sf_dir, state=BEFORE)
    now, _ = graph(spark, sf_dir)
    changed = delta.edge_delta(e, now).select("rel_id").distinct()
    return one_step_membership(e, s).join(changed, "rel_id").select(F.col("root_id").alias("seed_rel_id")).distinct()


def semi_filter(spark, sf_dir):
    _, before = graph(spark, sf_dir, state=BEFORE)
    _, now = graph(spark, sf_dir)
    return before.join(now, "seed_rel_id", "left_semi")


def keep_untouched(spark, sf_dir):
    e, s = graph(spark, sf_dir, state=BEFORE)
    now, _ = graph(spark, sf_dir)
    changed = delta.edge_delta(e, now).select("rel_id").distinct()
    return one_step_membership(e, s).join(changed, "rel_id", "left_anti")


def distinct_rows(spark, sf_dir):
    return load(spark, sf_dir, "orders").select("o_orderstatus", "o_orderpriority").distinct()


def distinct_subset(spark, sf_dir):
    """One row per customer; which one is settled by order date and key, not by chance."""
    orders = load(spark, sf_dir, "orders")
    return orders.groupBy("o_custkey").agg(
        F.min_by("o_orderpriority", F.struct("o_orderdate", "o_orderkey")).alias("first_priority")
    )


def group_min(spark, sf_dir):
    return one_step_membership(*graph(spark, sf_dir))


def candidates(spark, sf_dir):
    customer = load(spark, sf_dir, "customer")
    text = F.when(F.col("c_mktsegment") == "BUILDING", F.lpad(key_as_string("c_custkey"), 9, "0")).otherwise(F.col("c_name"))
    return customer.select(F.col("c_nationkey").cast("bigint").alias("grp"), text.alias("seed")).unionByName(
        customer.select((100 + F.col("c_custkey") % 7).alias("grp"), F.col("c_name").alias("seed"))
    )


def winner_rule(spark, sf_dir):
    return candidates(spark, sf_dir).groupBy("grp").agg(better_root("seed").alias("winner"))


def run_counts(spark, sf_dir):
    return load(spark, sf_dir, "lineitem").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("l_returnflag") == "R").alias("n_returned"),
        F.count_distinct("l_orderkey").alias("n_orders"),
    )


def has_rows(spark, sf_dir):
    """For each nation: does it have customers, and any with a negative balance?"""
    customer = load(spark, sf_dir, "customer")
    nation = load(spark, sf_dir, "nation")
    some = customer.select(F.col("c_nationkey").alias("n_nationkey")).distinct().withColumn("some", F.lit(True))
    low = customer.filter("c_acctbal < 0").select(F.col("c_nationkey").alias("n_nationkey")).distinct().withColumn("low", F.lit(True))
    return nation.join(some, "n_nationkey", "left").join(low, "n_nationkey", "left").select(
        "n_nationkey", F.coalesce("some", F.lit(False)).alias("has_customers"),
        F.coalesce("low", F.lit(False)).alias("has_debtors"),
        F.lit(checks.has_rows(customer)).alias("any_customer"),
    )


def uniqueness(spark, sf_dir):
    """Pairs with entities that reach several seeds, and with line items that repeat a pair."""
    pairs = hop_key_to_entity(spark, sf_dir).select("rel_id", "seed_rel_id")
    lines = load(spark, sf_dir, "lineitem").select(F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string"))
    return checks.uniqueness(pairs.union(lines.select(F.concat(F.lit("p"), "l_partkey"), "l_suppkey")))


def order_rows(spark, sf_dir):
    return load(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderstatus").orderBy("o_custkey", "o_orderkey")


def topk_preview(spark, sf_dir):
    e, _ = graph(spark, sf_dir, "history")
    return preview(e, ["id_key", "rel_id", "source_table"], limit=30)


def union_by_name(spark, sf_dir):
    customer = load(spark, sf_dir, "customer").select(F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"))
    supplier = load(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nation"), F.col("s_name").alias("name"))
    return customer.unionByName(supplier)


def parts_by_flag(spark, sf_dir, flag):
    return load(spark, sf_dir, "lineitem").filter(F.col("l_returnflag") == flag).select("l_partkey", "l_linenumber")


def except_all(spark, sf_dir):
    return delta.bag_delta(parts_by_flag(spark, sf_dir, "A"), parts_by_flag(spark, sf_dir, "R"))


def pair_delta(spark, sf_dir):
    return delta.pair_delta(parts_by_flag(spark, sf_dir, "A"), parts_by_flag(spark, sf_dir, "R"))


def union_distinct(spark, sf_dir):
    customer = load(spark, sf_dir, "customer").select("c_nationkey")
    supplier = load(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("c_nationkey"))
    return customer.unionByName(supplier).distinct()


def scalar_functions(spark, sf_dir):
    orders = load(spark, sf_dir, "orders")
    day = F.col("o_orderdate")
    return orders.select(
        "o_orderkey",
        F.col("o_custkey").cast("string").alias("as_text"),
        F.trim(F.concat(F.lit("  "), "o_orderpriority", F.lit(" "))).alias("trimmed"),
        F.col("o_orderpriority").startswith("1-").alias("urgent"),
        F.col("o_orderpriority").isNotNull().alias("known"),
        (day == F.to_timestamp_ntz(F.lit("1998-10-03 00:00:00"))).alias("on_day"),
        ((F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") != "5-LOW")).alias("both"),
        F.when(F.col("o_orderstatus") == "P", F.lit("closed")).otherwise(F.lit("open")).alias("state"),
        table_name_of(F.col("o_orderpriority")).alias("name"),
        F.col("o_orderpriority").try_cast("bigint").alias("not_a_number"),
    )


def name_normalise(spark, sf_dir):
    return load(spark, sf_dir, "customer").select("c_custkey", table_name_of(F.col("c_name")).alias("table_name"))


QUERIES = {
    "project_alias": project_alias, "key_to_string": key_to_string, "key_to_long": key_to_long,
    "tag_source": tag_source, "rename_col": rename_col, "flag_filter": flag_filter,
    "open_ended": open_ended_rows, "ts_equals": ts_equals, "drop_blank_keys": drop_blank_keys,
    "case_when": case_when, "current_rows": current_rows, "temporal_to_string": temporal_preview,
    "hop_entity_to_key": hop_entity_to_key, "hop_key_to_entity": hop_key_to_entity,
    "hop_seed_counts": hop_seed_counts, "hop_listed_seeds": hop_listed_seeds, "hop_unseeded": hop_unseeded, "anti_one_key": anti_one_key, "anti_two_keys": anti_two_keys,
    "removed_seed_members": removed_seed_members, "impacted_prev_seeds": impacted_prev_seeds,
    "semi_filter": semi_filter, "keep_untouched": keep_untouched, "distinct_rows": distinct_rows,
    "distinct_subset": distinct_subset, "group_min": group_min, "winner_rule": winner_rule,
    "run_counts": run_counts, "has_rows": has_rows, "uniqueness": uniqueness, "order_rows": order_rows,
    "topk_preview": topk_preview, "union_by_name": union_by_name, "except_all": except_all,
    "pair_delta": pair_delta, "union_distinct": union_distinct, "scalar_functions": scalar_functions,
    "name_normalise": name_normalise,
}

CURRENT_GRAPH = ",\n".join([sql.edges("edges", "current"), sql.seeds("seeds")])
BEFORE_GRAPH = ",\n".join([
    sql.edges("b_edges", "current", "register_before", "link_before"), sql.seeds("b_seeds", "register_before")
])
BEFORE_MEMBER = sql.ONE_STEP.replace("FROM seeds", "FROM b_seeds").replace("JOIN edges", "JOIN b_edges")


def now_graph(body: str, extra: str = "") -> str:
    return sql.with_history(NOW, extra=CURRENT_GRAPH + (",\n" + extra if extra else ""), body=body)


def both_graphs(body: str, extra: str = "") -> str:
    ctes = CURRENT_GRAPH + ",\n" + BEFORE_GRAPH + (",\n" + extra if extra else "")
    return sql.with_history(NOW, BEFORE, extra=ctes, body=body)


ONE_HOP = """hop AS (
    SELECT DISTINCT s.seed_rel_id, m.rel_id FROM seeds s
    JOIN edges e ON e.rel_id = s.seed_rel_id JOIN edges m ON m.id_key = e.id_key)"""
FLAGGED = "SELECT l_partkey, l_linenumber FROM lineitem WHERE l_returnflag = '{}'"
R, A = FLAGGED.format("R"), FLAGGED.format("A")

ORACLES = {
    "project_alias": "SELECT o_orderkey AS entity, o_custkey AS owner, o_orderpriority AS priority FROM orders",
    "key_to_string": "SELECT CAST(l_orderkey AS STRING) AS rel_id, CAST(l_partkey AS STRING) AS id_key FROM lineitem",
    "key_to_long": "SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_custkey END AS as_long FROM customer",
    "tag_source": sql.with_history(NOW, body="""
        SELECT 'register' AS source_table, rel_id, id_key FROM register
        UNION ALL SELECT 'link', rel_id, id_key FROM link"""),
    "rename_col": "SELECT n_nationkey, n_name AS nation FROM nation",
    "flag_filter": "SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'BUILDING'",
    "open_ended": sql.with_history(NOW, body="""
        SELECT rel_id, id_key, active_f FROM register WHERE CAST(valid_to AS STRING) LIKE '9999-12-31%'"""),
    "ts_equals": "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderdate = TIMESTAMP '1998-10-03 00:00:00'",
    "drop_blank_keys": """
        SELECT CAST(c_custkey AS STRING) AS rel_id, ' ' || c_name AS id_key FROM customer
        WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD')""",
    "case_when": """
        SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'closed'
            WHEN o_orderpriority = '1-URGENT' THEN 'root' ELSE 'member' END AS role FROM orders""",
    "current_rows": sql.with_history(NOW, body="""
        SELECT rel_id, id_key, del_f FROM link WHERE valid_to >= TIMESTAMP '9999-12-31' AND del_f = 'N'"""),
    "temporal_to_string": "SELECT o_orderkey, CAST(o_orderdate AS STRING) AS o_orderdate FROM orders",
    "hop_entity_to_key": now_graph(
        "SELECT DISTINCT s.seed_rel_id, e.id_key FROM seeds s JOIN edges e ON e.rel_id = s.seed_rel_id"),
    "hop_key_to_entity": now_graph("SELECT seed_rel_id, rel_id FROM hop", ONE_HOP),
    "hop_seed_counts": now_graph("SELECT rel_id, count(*) AS n_seeds FROM hop GROUP BY rel_id", ONE_HOP),
    "hop_listed_seeds": now_graph("SELECT seed_rel_id, rel_id FROM hop", ONE_HOP),
    "hop_unseeded": now_graph("SELECT DISTINCT rel_id FROM hop", ONE_HOP),
    "anti_one_key": now_graph(
        "SELECT DISTINCT rel_id FROM hop WHERE rel_id NOT IN (SELECT seed_rel_id FROM seeds)", ONE_HOP),
    "anti_two_keys": now_graph("SELECT seed_rel_id, rel_id FROM hop WHERE seed_rel_id <> rel_id", ONE_HOP),
    "removed_seed_members": both_graphs("""
        SELECT rel_id FROM member WHERE root_id IN (SELECT seed_rel_id FROM b_seeds)
        AND root_id NOT IN (SELECT seed_rel_id FROM seeds)""", BEFORE_MEMBER),
    "impacted_prev_seeds": both_graphs("""
        SELECT DISTINCT root_id AS seed_rel_id FROM member WHERE rel_id IN (SELECT rel_id FROM moved)""",
        BEFORE_MEMBER + "," + sql.MOVED),
    "semi_filter": both_graphs("SELECT seed_rel_id FROM b_seeds INTERSECT SELECT seed_rel_id FROM seeds"),
    "keep_untouched": both_graphs(
        "SELECT rel_id, root_id FROM member WHERE rel_id NOT IN (SELECT rel_id FROM moved)",
        BEFORE_MEMBER + "," + sql.MOVED),
    "distinct_rows": "SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders",
    "distinct_subset": """
        SELECT o_custkey, o_orderpriority AS first_priority FROM (
            SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders)
        WHERE rn = 1""",
    "group_min": now_graph("SELECT rel_id, root_id FROM member", sql.ONE_STEP),
    "winner_rule": """
        WITH c AS (
            SELECT CAST(c_nationkey AS BIGINT) AS grp,
                   CASE WHEN c_mktsegment = 'BUILDING' THEN lpad(CAST(c_custkey AS STRING), 9, '0') ELSE c_name END AS seed
            FROM customer
            UNION ALL SELECT 100 + c_custkey % 7, c_name FROM customer)
        SELECT grp, seed AS winner FROM (
            SELECT *, row_number() OVER (PARTITION BY grp ORDER BY TRY_CAST(seed AS BIGINT) NULLS LAST, seed) AS rn FROM c)
        WHERE rn = 1""",
    "run_counts": """
        SELECT count(*) AS n_rows, count(*) FILTER (WHERE l_returnflag = 'R') AS n_returned,
               count(DISTINCT l_orderkey) AS n_orders FROM lineitem""",
    "has_rows": """
        SELECT n_nationkey, EXISTS (SELECT 1 FROM customer WHERE c_nationkey = n_nationkey) AS has_customers,
               EXISTS (SELECT 1 FROM customer WHERE c_nationkey = n_nationkey AND c_acctbal < 0) AS has_debtors,
               EXISTS (SELECT 1 FROM customer) AS any_customer FROM nation""",
    "uniqueness": now_graph("""
        SELECT CAST(sum(n) AS BIGINT) AS total_rows, count(*) AS distinct_rows,
               (SELECT count(*) FROM (SELECT a FROM pairs GROUP BY a HAVING count(DISTINCT b) > 1)) AS ambiguous_entities
        FROM (SELECT a, b, count(*) AS n FROM pairs GROUP BY a, b)""", ONE_HOP + """,
        pairs(a, b) AS (SELECT rel_id, seed_rel_id FROM hop
                        UNION ALL SELECT 'p' || l_partkey, CAST(l_suppkey AS STRING) FROM lineitem)"""),
    "order_rows": "SELECT o_custkey, o_orderkey, o_orderstatus FROM orders ORDER BY o_custkey, o_orderkey",
    "topk_preview": sql.with_history(NOW, extra=sql.edges("edges", "history"), body="""
        SELECT * FROM edges ORDER BY id_key, rel_id, source_table LIMIT 30"""),
    "union_by_name": """
        SELECT c_name AS name, c_nationkey AS nation FROM customer
        UNION ALL SELECT s_name, s_nationkey FROM supplier""",
    "except_all": f"""
        SELECT 'inserted' AS kind, * FROM ({R} EXCEPT ALL {A})
        UNION ALL SELECT 'removed', * FROM ({A} EXCEPT ALL {R})""",
    "pair_delta": f"""
        SELECT 'inserted' AS kind, * FROM ({R} EXCEPT {A})
        UNION ALL SELECT 'removed', * FROM ({A} EXCEPT {R})""",
    "union_distinct": "SELECT c_nationkey FROM customer UNION SELECT s_nationkey FROM supplier",
    "scalar_functions": """
        SELECT o_orderkey, CAST(o_custkey AS STRING) AS as_text, trim('  ' || o_orderpriority || ' ') AS trimmed,
               starts_with(o_orderpriority, '1-') AS urgent, o_orderpriority IS NOT NULL AS known,
               o_orderdate = TIMESTAMP '1998-10-03 00:00:00' AS on_day,
               o_orderstatus = 'P' AND o_orderpriority <> '5-LOW' AS both,
               CASE WHEN o_orderstatus = 'P' THEN 'closed' ELSE 'open' END AS state,
               regexp_replace(lower(o_orderpriority), '[^a-z0-9_]', '_', 'g') AS name,
               CAST(NULL AS BIGINT) AS not_a_number FROM orders""",
    "name_normalise": """
        SELECT c_custkey, regexp_replace(lower(c_name), '[^a-z0-9_]', '_', 'g') AS table_name FROM customer""",
}
