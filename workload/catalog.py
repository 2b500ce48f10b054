"""Table operators, each on tables made from the given data in a scratch database."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rootweave.plans import refresh
from rootweave.sources import files, tables
from rootweave.sources.versions import Versions
from rootweave.workspace import Workspace
from workload import oracles as sql
from workload.views import NOW, config, create_tables, load

CUSTOMER_COLUMNS = ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"]
CUSTOMER_SCHEMA = "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_mktsegment STRING"
NATION_SCHEMA = "n_nationkey INT, n_name STRING, n_regionkey INT"


def ingest(spark: SparkSession, sf_dir: str) -> tuple[str, list[str]]:
    """Write tables as delimited text and load the folder; (database, tables)."""
    ws = Workspace(spark)
    folder, db = f"{ws.path}/input", ws.scratch_database()
    texts = {"Customer-List.csv": load(spark, sf_dir, "customer").select(*CUSTOMER_COLUMNS),
             "nation.csv": load(spark, sf_dir, "nation")}
    for name, df in texts.items():
        df.write.option("header", True).option("sep", "\t").csv(f"{folder}/{name}")
    schemas = {"customer_list": CUSTOMER_SCHEMA, "nation": NATION_SCHEMA}
    return db, files.ingest_folder(spark, folder, db, schemas)


def ingest_tsv(spark, sf_dir):
    db, _ = ingest(spark, sf_dir)
    return spark.table(f"{db}.customer_list")


def load_report(spark, sf_dir):
    _, loaded = ingest(spark, sf_dir)
    return files.load_report(spark, loaded)


def with_bad_values(spark, sf_dir) -> DataFrame:
    """Customers as text; in two market segments the nation, or the key, is no number."""
    segment = F.col("c_mktsegment")
    return load(spark, sf_dir, "customer").select(
        F.when(segment == "MACHINERY", F.concat(F.lit("no "), "c_custkey")).otherwise(F.col("c_custkey").cast("string")).alias("c_custkey"),
        "c_name", F.when(segment == "BUILDING", "?").otherwise(F.col("c_nationkey").cast("string")).alias("c_nationkey"), "c_mktsegment",
    )


def rejects(spark, sf_dir) -> tuple[str, DataFrame]:
    """A folder with good and bad lines, loaded with the bad ones set aside; (database, report)."""
    ws = Workspace(spark)
    folder, db = f"{ws.path}/input", ws.scratch_database()
    bad = with_bad_values(spark, sf_dir)
    for name, df in {"all.csv": bad, "part.csv": bad.filter("c_mktsegment IN ('BUILDING', 'FURNITURE')")}.items():
        df.write.option("header", True).option("sep", "\t").csv(f"{folder}/{name}")
    return db, files.ingest_with_rejects(spark, folder, db, {"all": CUSTOMER_SCHEMA, "part": CUSTOMER_SCHEMA}, ws)


def ingest_report(spark, sf_dir):
    _, report = rejects(spark, sf_dir)
    return report.groupBy("table_name").agg(F.sum("loaded").alias("loaded"), F.sum("rejected").alias("rejected"))


def ingest_rejects(spark, sf_dir):
    """Good rows and rejected lines side by side."""
    db, _ = rejects(spark, sf_dir)
    good = spark.table(f"{db}.all").select(F.col("c_custkey").cast("string").alias("what"), F.lit(False).alias("rejected"))
    bad = spark.table(f"{db}.all{files.REJECTS}").select(F.col("line").alias("what"), F.lit(True).alias("rejected"))
    return good.unionByName(bad)


def copy_of(spark, sf_dir, table, columns="*", database=None) -> str:
    """A table copied into a scratch database; its name."""
    db = database or Workspace(spark).scratch_database()
    tables.write_table(load(spark, sf_dir, table).select(columns), f"{db}.{table}")
    return f"{db}.{table}"


def scan_table(spark, sf_dir):
    return spark.table(copy_of(spark, sf_dir, "orders")).select("o_orderkey", "o_custkey", "o_orderstatus")


def write_table(spark, sf_dir):
    name = copy_of(spark, sf_dir, "nation")
    tables.write_table(load(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority"), name)
    return spark.table(name)


def ensure_tables(spark, sf_dir):
    """All state tables and views, created twice; what was written in between is kept, the rest is there and empty."""
    ws = Workspace(spark)
    cfg = config("current", ws.scratch_database(), state_db=ws.scratch_database())
    refresh.ensure_tables(spark, cfg)
    labels = load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("rel_id"), F.col("o_custkey").alias("component_id"), (F.col("o_orderkey") % 4).alias("bucket")
    )
    tables.append_rows(labels, cfg.state(refresh.COMPONENTS))
    refresh.ensure_tables(spark, cfg)
    names = [*refresh.STATE_SCHEMAS, refresh.EDGE_SNAPSHOT, refresh.SEED_SNAPSHOT, refresh.MEMBERS]
    return files.load_report(spark, [cfg.state(name) for name in names] + [cfg.output])


def ctas(spark, sf_dir):
    source = copy_of(spark, sf_dir, "lineitem", ["l_returnflag", "l_linestatus"])
    return tables.create_as_select(
        spark, f"{source}_summary",
        f"SELECT l_returnflag, l_linestatus, count(*) AS n FROM {source} GROUP BY l_returnflag, l_linestatus",
    )


def const_rows(spark, sf_dir):
    """A constant row joins the rows of a table in a new one."""
    source = copy_of(spark, sf_dir, "customer", ["c_custkey", "c_name"])
    return tables.create_as_select(
        spark, f"{source}_marked",
        f"SELECT -1L AS value, 'marker row' AS origin UNION ALL SELECT c_custkey, c_name FROM {source}",
    )


def insert_values(spark, sf_dir):
    db = Workspace(spark).scratch_database()
    create_tables(spark, sf_dir, db)
    spark.sql(f"""
        INSERT INTO {db}.register (rel_id, valid_from, valid_to, id_key, active_f)
        VALUES ('new-entity-a', to_timestamp_ntz('2024-02-29 12:30:00'), to_timestamp_ntz('9999-12-31 00:00:00'), 'new-1', 'Y'),
               ('new-entity-b', to_timestamp_ntz('2024-02-29 12:30:00'), to_timestamp_ntz('9999-12-31 00:00:00'), NULL, 'N')""")
    return spark.table(f"{db}.register").select(
        "rel_id", F.col("valid_to").cast("string").alias("valid_to"), "id_key", "active_f"
    )


def insert_select(spark, sf_dir):
    """Duplicate the first open link of the table."""
    db = Workspace(spark).scratch_database()
    create_tables(spark, sf_dir, db)
    spark.sql(f"""
        INSERT INTO {db}.link SELECT * FROM {db}.link
        WHERE del_f = 'N' AND valid_to = to_timestamp_ntz('9999-12-31 00:00:00')
        ORDER BY rel_id, id_key, valid_from LIMIT 1""")
    return spark.table(f"{db}.link").groupBy("rel_id", "id_key").agg(F.count(F.lit(1)).alias("n"))


def insert_if_absent(spark, sf_dir):
    """Complete a partly filled table, twice."""
    customer = load(spark, sf_dir, "customer").select("c_custkey", "c_name")
    name = f"{Workspace(spark).scratch_database()}.known"
    tables.write_table(load(spark, sf_dir, "customer").filter("c_acctbal < 0").select("c_custkey", "c_name"), name)
    for _ in range(2):
        tables.insert_if_absent(customer, name, ["c_custkey"])
    return spark.table(name)


def list_tables(spark, sf_dir):
    db = Workspace(spark).scratch_database()
    for table in ("region", "nation", "supplier", "customer"):
        copy_of(spark, sf_dir, table, database=db)
    return tables.list_tables(spark, db)


def swap_replace(spark, sf_dir):
    """A table replaced by an aggregate of itself."""
    name = copy_of(spark, sf_dir, "orders")
    totals = spark.table(name).groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders"))
    tables.swap_replace(spark, name, totals)
    return spark.table(name)


def swap_transform(spark, sf_dir):
    name = copy_of(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderstatus"])
    tables.swap_transform(spark, name, lambda df: df.filter("o_orderstatus <> 'P'").withColumn("o_custkey", F.col("o_custkey") + 1))
    return spark.table(name)


def update_where(spark, sf_dir):
    """Flag off where the condition holds; rows where it is NULL stay."""
    name = copy_of(spark, sf_dir, "orders", ["o_orderkey", "o_orderstatus", "o_orderpriority"])
    unknown = F.when(F.col("o_orderstatus") != "O", F.col("o_orderpriority") == "1-URGENT")
    tables.update_where(spark, name, "o_orderpriority", unknown, F.lit("0-NONE"))
    return spark.table(name)


def snapshot_restore(spark, sf_dir):
    """Baseline, damage, restore."""
    name = copy_of(spark, sf_dir, "customer", ["c_custkey", "c_mktsegment"])
    tables.snapshot_table(spark, name)
    tables.update_where(spark, name, "c_mktsegment", F.col("c_custkey") > 0, F.lit("LOST"))
    tables.restore_table(spark, name)
    return spark.table(name)


def version_restore(spark, sf_dir):
    """Two tables replaced together and brought back together by the name of their version."""
    ws = Workspace(spark)
    versions = Versions(spark, ws.scratch_database(), f"{ws.path}/versions")
    customer, orders = (load(spark, sf_dir, t) for t in ("customer", "orders"))
    first = versions.replace({"owner": customer.select("c_custkey", "c_mktsegment"), "bought": orders.select("o_orderkey", "o_custkey")})
    owner, bought = (f"{versions.database}.{t}" for t in ("owner", "bought"))
    versions.replace({"owner": spark.table(owner).filter("c_custkey < 0"), "bought": spark.table(bought).withColumn("o_custkey", F.lit(0))})
    versions.switch(first)
    return spark.table(owner).join(spark.table(bought), F.col("c_custkey") == F.col("o_custkey")).groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("n_orders")
    )


def empty_typed(spark, sf_dir):
    """An empty relation with the schema of a table, rebuilt from JSON, adds nothing to it."""
    df = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    empty = tables.empty_like(spark, StructType.fromJson(df.schema.jsonValue()))
    return df.unionByName(empty)


QUERIES = {
    "ingest_tsv": ingest_tsv, "ingest_report": ingest_report, "ingest_rejects": ingest_rejects,
    "load_report": load_report, "scan_table": scan_table, "write_table": write_table,
    "ensure_tables": ensure_tables, "ctas": ctas, "const_rows": const_rows, "insert_values": insert_values,
    "insert_select": insert_select, "insert_if_absent": insert_if_absent, "list_tables": list_tables,
    "swap_replace": swap_replace, "swap_transform": swap_transform, "update_where": update_where,
    "snapshot_restore": snapshot_restore, "version_restore": version_restore, "empty_typed": empty_typed,
}

ORACLES = {
    "ingest_tsv": "SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer",
    "ingest_report": """
        SELECT 'all' AS table_name, count(*) FILTER (c_mktsegment NOT IN ('BUILDING', 'MACHINERY')) AS loaded,
            count(*) FILTER (c_mktsegment IN ('BUILDING', 'MACHINERY')) AS rejected FROM customer
        UNION ALL SELECT 'part', count(*) FILTER (c_mktsegment = 'FURNITURE'), count(*) FILTER (c_mktsegment = 'BUILDING') FROM customer""",
    "ingest_rejects": """
        SELECT CASE c_mktsegment WHEN 'BUILDING' THEN concat_ws(chr(9), c_custkey, c_name, '?', c_mktsegment)
            WHEN 'MACHINERY' THEN concat_ws(chr(9), 'no ' || c_custkey, c_name, c_nationkey, c_mktsegment)
            ELSE CAST(c_custkey AS STRING) END AS what,
            c_mktsegment IN ('BUILDING', 'MACHINERY') AS rejected FROM customer""",
    "load_report": """
        SELECT 'customer_list' AS table_name, count(*) AS row_count FROM customer
        UNION ALL SELECT 'nation', count(*) FROM nation""",
    "scan_table": "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders",
    "write_table": "SELECT o_orderkey, o_orderpriority FROM orders",
    "ensure_tables": """
        SELECT table_name, CASE WHEN table_name = 'component_snapshot' THEN (SELECT count(*) FROM orders) ELSE 0 END AS row_count
        FROM (VALUES ('edge_log'), ('seed_log'), ('component_snapshot'), ('source_digest'), ('edge_snapshot'),
                     ('seed_snapshot'), ('seed_membership'), ('output')) AS t(table_name)""",
    "ctas": "SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY l_returnflag, l_linestatus",
    "const_rows": "SELECT -1 AS value, 'marker row' AS origin UNION ALL SELECT c_custkey, c_name FROM customer",
    "insert_values": sql.with_history(NOW, body="""
        SELECT rel_id, CAST(valid_to AS STRING) AS valid_to, id_key, active_f FROM register
        UNION ALL VALUES ('new-entity-a', '9999-12-31 00:00:00', 'new-1', 'Y'), ('new-entity-b', '9999-12-31 00:00:00', NULL, 'N')"""),
    "insert_select": sql.with_history(NOW, body="""
        SELECT rel_id, id_key, count(*) AS n FROM (
            SELECT rel_id, id_key FROM link
            UNION ALL (SELECT rel_id, id_key FROM link WHERE del_f = 'N' AND valid_to = TIMESTAMP '9999-12-31 00:00:00'
                       ORDER BY rel_id, id_key, valid_from LIMIT 1))
        GROUP BY rel_id, id_key"""),
    "insert_if_absent": "SELECT c_custkey, c_name FROM customer",
    "list_tables": "SELECT * FROM (VALUES ('region'), ('nation'), ('supplier'), ('customer')) AS t(table_name)",
    "swap_replace": "SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY o_custkey",
    "swap_transform": "SELECT o_orderkey, o_custkey + 1 AS o_custkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'P'",
    "update_where": """
        SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus <> 'O' AND o_orderpriority = '1-URGENT'
            THEN '0-NONE' ELSE o_orderpriority END AS o_orderpriority FROM orders""",
    "snapshot_restore": "SELECT c_custkey, c_mktsegment FROM customer",
    "version_restore": """
        SELECT c_mktsegment, count(*) AS n_orders FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY c_mktsegment""",
    "empty_typed": "SELECT o_orderkey, o_orderpriority FROM orders",
}
