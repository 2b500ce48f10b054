"""The bit-sliced index against plain inner products."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from rootweave.llm import topk


def plain(vectors, asked, k, scale=1024):
    x = {i: np.floor(np.array(v, float) * scale).astype(np.int64) for i, v in vectors}
    out = set()
    for q in asked:
        others = sorted((-int(v @ x[q]), i) for i, v in x.items() if i != q and len(v) == len(x[q]))[:k]
        out |= {(q, rank, i, -s) for rank, (s, i) in enumerate(others, 1)}
    return out


@pytest.mark.parametrize(("bits", "block"), [(1, 1 << 13), (3, 1 << 12), (6, 1 << 20), (12, 1 << 14)])
def test_against_plain_products(spark, ws, monkeypatch, bits, block):
    monkeypatch.setattr(topk, "BLOCK_BYTES", block)
    rng = np.random.default_rng(bits)
    centres = rng.standard_normal((20, 24))
    vectors = np.vstack([centres[rng.integers(0, 20, 900)] + 0.2 * rng.standard_normal((900, 24)), np.repeat(centres[:1], 300, axis=0)])
    vectors[5] *= 400  # an outlier widens the quantisation
    rows = [(i * 3, [float(x) for x in v]) for i, v in enumerate(vectors)]
    rows += [(10_000 + i, [float(x) for x in rng.standard_normal(2)]) for i in range(6)] + [(20_000, [1.5])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("rank", F.lit("x")).withColumn("_id", F.lit(0))
    found = topk.search(frame, ws, F.col("_id") % 100 == 0, bits=bits)
    assert dict(found.dtypes) == {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "bigint"}
    assert {tuple(r) for r in found.collect()} == plain(rows, [i for i, _ in rows if i % 100 == 0], 10)


def test_odd_rows(spark, ws):
    nan, inf = float("nan"), float("inf")
    odd = [None, [], [nan, 1.0], [1.0, inf], [None, 1.0], [1e9, 0.0], [0.0, 0.0], [-1.0, -1.0]]
    rows = [(100 * i, v) for i, v in enumerate(odd)] + [(None, [1.0, 1.0]), (800, [1.0, 2.0]), (800, [1.0, 1.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = {tuple(r) for r in topk.search(frame, ws, F.col("_id") % 100 == 0).collect()}
    assert found == plain([(600, [0.0, 0.0]), (700, [-1.0, -1.0]), (800, [1.0, 1.0])], [600, 700, 800], 10)
    assert topk.search(frame.limit(0), ws, F.col("_id") % 100 == 0).count() == 0
    assert topk.search(frame.filter("vec_id = 700"), ws, F.col("_id") % 100 == 0).count() == 0


def test_bitmap_arithmetic():
    rng = np.random.default_rng(1)
    x = rng.integers(-(1 << 26) + 1, 1 << 26, 200)
    digits = topk.signed_digits(x).astype(np.int64)
    assert (digits @ (1 << np.arange(topk.DIGITS)) == x).all() and not (digits[:, 1:] * digits[:, :-1]).any()
    places = {p: rng.integers(0, 2, (n, 192)).astype(np.uint8) for p, n in ((0, 5), (1, 1), (3, 9))}
    expected = sum((1 << p) * b.sum(axis=0, dtype=np.int64) for p, b in places.items())
    packed = {p: np.packbits(b, axis=1, bitorder="little").view(np.uint64) for p, b in places.items()}
    total = topk.add_bitmaps(packed, 3)
    unpacked = [np.unpackbits(t.view(np.uint8), bitorder="little") for t in total]
    assert (sum(u.astype(np.int64) << i for i, u in enumerate(unpacked)) == expected).all()
    rows = np.packbits(np.arange(192) < 150, bitorder="little").view(np.uint64)
    for k in (1, 7, 150):
        assert topk.kth_sum(total, rows, k) == np.sort(expected[:150])[-k]
    for limit in (0, 1, 17, int(expected.max()), 1 << 20):
        marked = np.unpackbits(topk.at_least(total, rows, limit).view(np.uint8), bitorder="little")
        assert (marked == ((expected >= limit) & (np.arange(192) < 150))).all()


@pytest.mark.parametrize("block", [1 << 13, 8 << 20])
def test_rows_on_their_way_are_vectors_whatever_the_size(spark, ws, monkeypatch, block):
    """What Spark sorts and sends is as long as a vector, and not sent once for every 32 queries."""
    monkeypatch.setattr(topk, "BLOCK_BYTES", block)
    rng = np.random.default_rng(5)
    frame = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(rng.standard_normal((2_000, 16)))], "vec_id long, embedding array<double>")

    def sizes(*_):
        def answer(batches):
            for batch in batches:  # rows, bytes of one, bytes of all
                yield topk.pa.RecordBatch.from_pydict({"query_id": [batch.num_rows], "vec_id": [batch.nbytes // max(1, batch.num_rows)], "score": [batch.nbytes]})

        return answer

    staged, stage = {}, ws.stage
    monkeypatch.setattr(ws, "stage", lambda df, label: staged.setdefault(label, stage(df, label)))
    monkeypatch.setattr(topk, "_answers", sizes)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        topk.search(frame, ws, F.col("_id") % 5 == 0)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    longest, total = staged["found"].agg(F.max("vec_id"), F.sum("score")).first()
    assert longest < 200  # 16 components of four bytes, and some numbers
    assert total < 2_000 * 200 * 16


def test_lanes_blocks_and_chunks(spark, ws, monkeypatch):
    """Several of each, cut anywhere, and two dimensions whose tiles meet in one partition."""
    for name, value in (("BLOCK_BYTES", 1 << 12), ("CHUNK_BYTES", 1 << 12), ("OUT_ROWS", 50)):
        monkeypatch.setattr(topk, name, value)
    rng = np.random.default_rng(6)
    rows = [(i * 5, [float(x) for x in np.round(v, 1)]) for i, v in enumerate(rng.standard_normal((700, 4)))]  # many scores are equal
    rows += [(10_000 + i, [float(x) for x in v]) for i, v in enumerate(rng.standard_normal((150, 30)))]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    found = topk.search(frame, ws, F.col("_id") % 50 == 0, k=3)
    assert {tuple(r) for r in found.collect()} == plain(rows, [i for i, _ in rows if i % 50 == 0], 3)


def test_a_block_that_knows_the_scores_so_far():
    rng = np.random.default_rng(7)
    x = rng.integers(-3_000, 3_000, (500, 12)).astype(np.int32)
    for bits in (1, 4, 14):
        block = topk.Block(np.arange(500), x, bits)
        for query in x[:20]:
            scores = np.sort(x.astype(np.int64) @ query)
            for rank in (1, 5, 40, 500):  # of ``least``: what reaches it is found, ties included
                ids, found = block.best(-1, query, 500, int(scores[-rank]))
                assert (found[:rank] == scores[-rank:][::-1]).all() and ((x[ids].astype(np.int64) @ query) == found).all()
