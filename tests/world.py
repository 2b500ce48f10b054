"""A small mutable pair of history tables with its own configuration."""

from pyspark.sql import functions as F

from rootweave.config import bank_party_config
from rootweave.plans.refresh import COMPONENTS, refresh_mapping
from rootweave.sources.tables import swap_replace
from tests.brute import components as brute_components
from tests.brute import mapping as brute_mapping

OPEN = "9999-12-31 00:00:00"
REGISTER = "rel_id string, edl_valid_from_dts string, edl_valid_to_dts string, np_sbl_id string, drc_bnk_f string"
LINK = "rel_id string, edl_valid_from_dts string, edl_valid_to_dts string, ikb_no string, del_f string"


class World:
    """Rows live in Python lists; ``save`` writes them to the source tables."""

    def __init__(self, spark, ws, **overrides):
        self.spark = spark
        self.db = ws.scratch_database()
        self.cfg = bank_party_config(self.db, self.db, ws.scratch_database(), **overrides)
        self.register, self.link = [], []

    def add(self, rel, key, flag="N", end=OPEN):
        self.register.append([rel, "2020-01-01 00:00:00", end, key, flag])

    def join(self, rel, key, deleted="N", end=OPEN):
        self.link.append([rel, "2020-01-01 00:00:00", end, key, deleted])

    def save(self):
        for name, rows, schema in (("direct_bank", self.register, REGISTER), ("ggm_np", self.link, LINK)):
            df = self.spark.createDataFrame([tuple(r) for r in rows], schema)
            for column in ("edl_valid_from_dts", "edl_valid_to_dts"):
                df = df.withColumn(column, F.col(column).cast("timestamp"))
            swap_replace(self.spark, f"{self.db}.{name}", df)

    def refresh(self):
        self.save()
        return refresh_mapping(self.spark, self.cfg)

    def output(self):
        return [tuple(r) for r in self.spark.table(self.cfg.output).select("REL_ID", "REL_ID_REGIE_KLANT").collect()]

    def graph(self, history=False):
        rows = [(r[0], r[3]) for r in self.register if history or r[2] == OPEN]
        rows += [(r[0], r[3]) for r in self.link if history or (r[2] == OPEN and r[4] == "N")]
        edges = [(rel, key) for rel, key in rows if rel and rel.strip() and key and key.strip()]
        return edges, {r[0] for r in self.register if r[4] == "Y" and r[2] == OPEN}

    def expected(self, history=False):
        return brute_mapping(*self.graph(history))

    def check(self):
        """Output equals a full solution, is unique, and the saved components are right."""
        found = self.output()
        assert len(found) == len(set(found)) == len({rel for rel, _ in found})
        assert set(found) == self.expected()
        saved = self.spark.table(self.cfg.state(COMPONENTS)).groupBy("component_id").agg(
            F.collect_list("rel_id").alias("members"), F.count(F.lit(1)).alias("n")
        ).collect()
        assert {frozenset(r.members) for r in saved} == set(brute_components(*self.graph()).values())
        assert sum(r.n for r in saved) == len({rel for r in saved for rel in r.members})
