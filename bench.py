"""Time the headline workloads; prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (8), BENCH_RUNS (1, after
a warm-up). With ``--hops`` the closure is also computed hop by hop, for comparison. ``--copies N`` instead
times a refresh and a rebuild over N disjoint copies of the tables.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rootweave.operators import edges, hops
from rootweave.operators.mapping import full_mapping
from rootweave.plans.rebuild import rebuild_mapping
from rootweave.plans.refresh import refresh_mapping
from rootweave.sources.tables import update_where
from rootweave.workspace import Workspace
from workload.views import config, create_tables, history_tables, load

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
RUNS = int(os.environ.get("BENCH_RUNS", "1"))


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]").appName("bench")
        .config("spark.sql.shuffle.partitions", str(CPUS)).config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def consume(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(work) -> float:
    start = time.perf_counter()
    work()
    return time.perf_counter() - start


def rebuild(spark: SparkSession, scope: str) -> None:
    tables, cfg = history_tables(spark, SF_DIR), config(scope)
    with Workspace(spark) as ws:
        consume(full_mapping(edges.edge_rows(tables, cfg), edges.active_seeds(tables, cfg), ws))


def giant_component(spark: SparkSession) -> None:
    """Whole line items keyed by part alone: one component holds nearly all orders."""
    lines = load(spark, SF_DIR, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("rel_id"), F.col("l_partkey").cast("string").alias("id_key")
    )
    urgent = load(spark, SF_DIR, "orders").filter("o_orderpriority = '1-URGENT'")
    with Workspace(spark) as ws:
        consume(full_mapping(lines, urgent.select(F.col("o_orderkey").cast("string").alias("seed_rel_id")), ws))


def incremental(spark: SparkSession) -> dict[str, list[float]]:
    """First refresh, refreshes after about 1 % of the links were toggled, refreshes without a change."""
    with Workspace(spark) as ws:
        cfg = config("current", ws.scratch_database(), state_db=ws.scratch_database())
        create_tables(spark, SF_DIR, cfg.source_db)
        times = {"first_refresh": [timed(lambda: refresh_mapping(spark, cfg))],
                 "incremental_mapping": [], "incremental_noop": []}
        for _ in range(RUNS):
            touched = F.col("valid_from") >= F.expr("TIMESTAMP_NTZ '2001-10-01 00:00:00'")
            update_where(spark, f"{cfg.source_db}.link", "del_f", touched,
                         F.when(F.col("del_f") == "Y", "N").otherwise("Y"))
            times["incremental_mapping"].append(timed(lambda: refresh_mapping(spark, cfg)))
            times["incremental_noop"].append(timed(lambda: refresh_mapping(spark, cfg)))
    return times


def refresh_at_scale(spark: SparkSession, copies: int) -> dict[str, float]:
    """A refresh after about 1 % of the links were toggled, and a rebuild, over disjoint copies of the tables."""
    with Workspace(spark) as ws:
        cfg = config("current", ws.scratch_database(), state_db=ws.scratch_database())
        for name, df in history_tables(spark, SF_DIR).items():
            copy = F.explode(F.sequence(F.lit(1), F.lit(copies))).alias("copy")
            many = df.select("*", copy).withColumns({
                "rel_id": F.concat("copy", F.lpad("rel_id", 9, "0")), "id_key": F.concat_ws("-", "id_key", "copy")}).drop("copy")
            many.write.saveAsTable(f"{cfg.source_db}.{name}")
        times = {"first_refresh": timed(lambda: refresh_mapping(spark, cfg))}
        touched = F.col("valid_from") >= F.expr("TIMESTAMP_NTZ '2001-10-01 00:00:00'")
        flipped = F.when(F.col("del_f") == "Y", "N").otherwise("Y")
        update_where(spark, f"{cfg.source_db}.link", "del_f", touched, flipped)
        times["refresh"] = timed(lambda: print(refresh_mapping(spark, cfg), file=sys.stderr))
        times["refresh_noop"] = timed(lambda: refresh_mapping(spark, cfg))
        with Workspace(spark) as own:
            times["rebuild"] = timed(lambda: rebuild_mapping(spark, cfg, own))
    return {name: round(seconds, 1) for name, seconds in times.items()}


def hop_by_hop(spark: SparkSession, scope: str) -> None:
    """The closure as a growing set of (seed, entity) pairs, one hop per round."""
    tables, cfg = history_tables(spark, SF_DIR), config(scope)
    with Workspace(spark) as ws:
        links = ws.stage(edges.untagged(edges.edge_rows(tables, cfg)), "edges")
        frontier = visited = ws.stage(hops.start_frontier(edges.active_seeds(tables, cfg)), "visited")
        while True:
            found = hops.only_new(hops.key_to_entity(hops.entity_to_key(frontier, links), links), visited)
            frontier, counted = ws.stage_counted(found, "frontier")
            if not counted["rows"]:
                break
            visited = ws.stage(visited.unionByName(frontier), "visited")
        consume(visited.groupBy("rel_id").agg(F.min(F.col("seed_rel_id").try_cast("bigint")).alias("root")))


def main() -> None:
    spark = session()
    if "--copies" in sys.argv:
        copies = int(sys.argv[sys.argv.index("--copies") + 1])
        print(json.dumps({"copies": copies, "seconds": refresh_at_scale(spark, copies)}))
        return
    work = {
        "full_mapping_history": lambda: rebuild(spark, "history"),
        "full_mapping_current": lambda: rebuild(spark, "current"),
        "giant_component": lambda: giant_component(spark),
    }
    if "--hops" in sys.argv:
        work["hop_by_hop_history"] = lambda: hop_by_hop(spark, "history")
    work["full_mapping_history"]()
    times = {name: [timed(run) for _ in range(RUNS)] for name, run in work.items()}
    times.update(incremental(spark))
    seconds = {name: round(statistics.median(t), 3) for name, t in times.items()}
    print(json.dumps({"metric": "total seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": SF_DIR.rstrip("/").split("sf")[-1]}))


if __name__ == "__main__":
    main()
