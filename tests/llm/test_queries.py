"""Every registered query with SQL against it, and the pipeline against a plain run of its stages."""

import os

import pytest

import check
import corpus_pipeline
from rootweave.llm import mixing, registry
from rootweave.llm import licences

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query(spark, name):
    assert check.compare(spark, check.database(SF_DIR), name, SF_DIR).startswith("ok")


def test_mixing_targets_and_odd_rows(spark, odd, empty, ws):
    docs = spark.createDataFrame([(i, "w " * 10, "big" if i < 900 else f"s{i % 4}") for i in range(1_000)], "doc_id long, text string, source string")
    natural = {r["_source"]: r["weight"] for r in mixing.plan(docs, ws).collect()}
    assert abs(natural["=big"] - 0.9) < 1e-9
    flat = mixing.plan(docs, ws, target_entropy=99.0, budget=5_000).collect()
    assert all(r["take"] == 1_000 for r in flat)
    limited = mixing.plan(docs, ws, max_repeats=3.0)
    taken = mixing.realise(docs, limited).groupBy("source").count().collect()
    assert {r["source"]: r["count"] for r in taken} == {"big": 900, **{f"s{k}": 75 for k in range(4)}}
    assert mixing.realise(odd, mixing.plan(odd, ws, max_repeats=2.0)).count() >= odd.count()
    assert mixing.realise(empty, mixing.plan(empty, ws, target_entropy=1.0)).count() == 0


def test_a_budget_is_met_up_to_one_document(spark, ws):
    docs = spark.createDataFrame([(i, "w " * (1 + i % 17), f"s{i % 3}") for i in range(3_000)], "doc_id long, text string, source string")
    planned = mixing.plan(docs, ws, budget=40_000, target_entropy=1.0)
    rows = mixing.realise(docs, planned).withColumn("n", mixing.n_words("text")).groupBy("source").sum("n").collect()
    take = {r["_source"][1:]: r["take"] for r in planned.collect()}
    assert all(take[r["source"]] - 17 < r["sum(n)"] <= take[r["source"]] for r in rows)


def test_licence_odd_rows_and_spellings(spark, odd, empty):
    known = licences.known_licences(spark)
    texts = [(1, "Copyright 2020 by N. N.\nreleased under the MIT Licence!"), (2, "a\n\n(c) X\nLICENSED UNDER CC BY-NC 4.0\n\nb"), (3, "Released under the MIT License, more or less.")]
    rows = {r["doc_id"]: r for r in licences.scan(spark.createDataFrame(texts, "doc_id long, text string"), known).collect()}
    assert rows[1]["licences"] == ["MIT"] and rows[1]["whole_text"] and rows[2]["licences"] == ["CC-BY-NC-4.0"] and rows[3]["licences"] == []
    assert licences.scan(odd, known).count() == odd.select("doc_id").distinct().count()
    assert licences.scan(empty, known).count() == 0


def test_pipeline_keeps_its_columns_and_its_documents(spark):
    from rootweave.workspace import Workspace

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    ws, columns, ids = Workspace(spark), docs.columns, {r[0] for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = ws.stage(stage(spark, docs, SF_DIR), name)
        assert docs.columns == columns
        left = {r[0] for r in docs.select("doc_id").collect()}
        assert left <= ids and (name not in ("line_dedup", "mixing") or left == ids)
        ids = left
    encoded = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR)
    assert encoded.count() == docs.count()


def test_pipeline_on_odd_rows(spark, odd, empty, tmp_path):
    odd = odd.select("doc_id", "text", "lang", "source", "n_chars")
    for docs in (odd, empty.select(odd.columns)):
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF_DIR)
        docs.count()
