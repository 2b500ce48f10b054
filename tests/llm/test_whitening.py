"""Whitening and the eigenvalue routine against dense linear algebra."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from rootweave.llm import feast, whitening


@pytest.mark.parametrize("k", [1, 8, 40])
def test_eigenpairs(k):
    rng = np.random.default_rng(k)
    cases = [np.cov(rng.standard_normal((200, 40)) * np.linspace(3, 1, 40), rowvar=False), np.eye(40), np.zeros((40, 40)), np.diag([4.0] * 12 + [1.0] * 28),
             np.diag([1e12, 1e6, 1, 1e-6] + [0.0] * 36), np.diag(np.arange(-20.0, 20.0))]
    for matrix in cases:
        values, vectors = feast.largest(matrix, k)
        expected = np.linalg.eigvalsh(matrix)[::-1][:k]
        scale = max(abs(expected[0]), 1e-300)
        assert np.allclose(values, expected, rtol=0, atol=1e-12 * scale)
        assert np.allclose(matrix @ vectors, vectors * values, rtol=0, atol=1e-11 * scale)
        assert np.allclose(vectors.T @ vectors, np.eye(k), atol=1e-12)
        shift = rng.standard_normal()
        assert feast.Inertia(matrix).below(shift) == (np.linalg.eigvalsh(matrix) < shift).sum()


def test_an_interval_with_another_count_is_refused():
    with pytest.raises(feast.NotFound):
        feast.interval(np.diag([1.0, 2.0, 5.0]), 1.5, 6.0, 3, np.random.default_rng(1))


def expected_rows(vectors, components):
    x = np.floor(1024 * np.array(vectors)).astype(np.int64) + 100_000
    n, total = len(x), x.sum(axis=0)
    centred = x - total / n
    values, columns = np.linalg.eigh(centred.T @ centred / n)
    values, columns = values[::-1], columns[:, ::-1]
    keep = min(components, int((values > 1e-12 * values.sum()).sum()))
    return ((n * x - total) ** 2).sum(axis=1), (centred @ columns / np.sqrt(np.abs(values) + 1e-300))[:, :keep], (values / values.sum())[:keep]


def test_against_dense_linear_algebra(spark, ws):
    rng = np.random.default_rng(5)
    wide = (rng.standard_normal((700, 20)) * np.linspace(2, 0.1, 20) + 3).tolist()
    pairs = rng.standard_normal((30, 2)).tolist()
    nan = float("nan")
    odd = [None, [], [nan] * 20, [None] + [1.0] * 19, [float("inf")] * 20, [1e15] * 20, [1.0, 2.0, 3.0]]
    rows = list(enumerate(wide)) + [(1_000 + i, v) for i, v in enumerate(pairs)] + [(5_000 + i, v) for i, v in enumerate(odd)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({"x": F.lit("x"), "n": F.lit("n"), "_id": F.lit(0)})
    found = whitening.whiten(frame, ws).collect()
    assert len(found) == 700 * 8 + 30 * 2 and {r["vec_id"] for r in found} == {i for i, _ in rows if i < 5_000}
    for first, vectors in ((0, wide), (1_000, pairs)):
        deviation, white, shares = expected_rows(vectors, 8)
        got = [r for r in found if first <= r["vec_id"] < first + len(vectors)]
        matrix = np.zeros_like(white)
        for r in got:
            i, c = r["vec_id"] - first, r["component"] - 1
            matrix[i, c] = r["whitened"]
            assert r["n"] == len(vectors) and r["deviation"] == deviation[i] and abs(r["explained"] / shares[c] - 1) < 1e-9
        signs = np.sign((matrix * white).sum(axis=0))
        assert np.allclose(matrix * signs, white, atol=1e-8)
        (error,) = {r["identity_error"] for r in got}
        assert abs(error - np.abs(np.cov(matrix.T, bias=True) - np.eye(matrix.shape[1])).max()) < 1e-9 and error < 1e-9


def test_flat_single_missing_and_far_vectors(spark, ws):
    def run(rows):
        return whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), ws).collect()

    assert run([]) == [] and run([(1, [1.0, 2.0])]) == [] and run([(1, [1.0, 2.0]), (2, [1.0, 2.0])]) == []
    found = run([(None, [1.0, 2.0]), (None, [1.0, 2.0]), (3, [5.0, 2.0])])
    assert [r["component"] for r in found] == [1, 1, 1] and all(abs(r["explained"] - 1) < 1e-9 for r in found)
    far = run([(1, [1e12]), (2, [-1e12]), (3, [0.0])])
    x = [1024 * 10**12, -1024 * 10**12, 0]
    assert {r["vec_id"]: r["deviation"] for r in far} == {1: None, 2: None, 3: 0} and sum(x) == 0
