import numpy as np
import pytest

from rootweave.llm import shards


@pytest.mark.parametrize("size", [1, 2, 3, 17, 1_000, 65_537])
def test_permutation_is_a_bijection_with_its_inverse(size):
    numbers = np.arange(size)
    for key in (0, 1, 99):
        slots = shards.Permutation(size, key).apply(numbers)
        assert sorted(slots) == list(range(size))
        assert (shards.Permutation(size, key).apply(slots, inverse=True) == numbers).all()
    assert size < 1_000 or (shards.Permutation(size, 1).apply(numbers) != shards.Permutation(size, 2).apply(numbers)).mean() > 0.9


def test_round_trip_and_resume(spark, odd, empty, ws):
    docs = odd.selectExpr("doc_id", "encode(text, 'UTF-8') AS ids", "text")
    path = f"{ws.path}/out"
    total = shards.write(docs, ws, path, width=1, length=7, per_shard=10)
    rows = sorted(shards.read(spark, path, width=1).collect())
    assert [row["slot"] for row in rows] == list(range(total))
    assert all(row["shard"] == row["slot"] // 10 and row["offset"] == row["slot"] % 10 * 23 for row in rows)
    expected = sorted(
        (str(d["doc_id"]), k // 7, bytes(d["ids"][k : k + 7])) for d in docs.collect() for k in range(0, len(d["ids"] or b""), 7)
    )
    assert sorted((str(row["doc_id"]), row["piece"], bytes(row["ids"])) for row in rows) == expected
    assert sorted(shards.read(spark, path, width=1, from_slot=33).collect()) == rows[33:]
    assert shards.write(empty.selectExpr("doc_id", "CAST(ids AS BINARY) ids"), ws, f"{ws.path}/none") == 0
    assert shards.read(spark, f"{ws.path}/none").count() == 0
