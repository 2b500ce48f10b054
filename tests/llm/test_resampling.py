"""Importance resampling against a plain version."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rootweave.llm import resampling
from rootweave.llm.common import BATCH_SETTING

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text, run):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    return words, [" ".join(words[i : i + n]) for n in range(1, run + 1) for i in range(len(words) - n + 1)]


def plain(docs, target, run, buckets, least, percent):
    count = lambda texts: Counter(zlib.crc32(f.encode()) % buckets for t in texts for f in features(t, run)[1])
    s, t = count(x for _, x in docs), count(target)
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets)))) for b in range(buckets)}
    rows = []
    for i, text in docs:
        words, found = features(text, run)
        weight = sum(gain[zlib.crc32(f.encode()) % buckets] for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"2024:{i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None, len(words) >= least])
    able = sorted((r for r in rows if r[5]), key=lambda r: (-r[3], r[0]))
    for place, row in enumerate(able[: percent * len(able) // 100], 1):
        row[4] = place
    return {tuple(r[:5]) for r in rows}


@pytest.mark.parametrize(("run", "buckets", "percent", "pivots"), [(1, 10_000, 10, 15), (2, 50, 35, 2), (3, 70_000, 100, 4)])
def test_against_a_plain_version(spark, ws, run, buckets, percent, pivots):
    rng = random.Random(run)
    words = [f"w{i}" for i in range(300)] + ["Ä", "ä", "É日", "it's", "A-b", "ﬁ x"]
    texts = [(i * 7 % 1009, " ".join(rng.choices(words, k=rng.choice([0, 3, 19, 20, 60])))) for i in range(400)]
    texts += [(5_000 + i, "same old words " * 9) for i in range(50)] + [(9_000, None), (9_001, ""), (9_002, "\n\t")]
    target = [" ".join(rng.choices(words[:40], k=50)) for _ in range(20)] + [None, ""]
    docs = spark.createDataFrame(texts, "doc_id long, text string").withColumn("rank", F.lit("x")).withColumn("_id", F.lit(1))
    aims = spark.createDataFrame([(t,) for t in target], "text string")
    before = spark.conf.get(BATCH_SETTING)
    found = resampling.resample(docs, aims, ws, max_run=run, buckets=buckets, percent=percent, pivots=pivots)
    assert dict(found.dtypes) == dict.fromkeys(["doc_id", "n_features", "weight", "score", "rank"], "bigint")
    assert {tuple(r) for r in found.collect()} == plain(texts, target, run, buckets, 20, percent)
    assert spark.conf.get(BATCH_SETTING) == before


def test_the_kth_key_is_exact_among_ties(spark):
    rng = random.Random(3)
    rows = [(rng.choice([-5, 0, 0, 0, 7]), rng.choice([None, rng.randrange(40)])) for _ in range(500)]
    frame = spark.createDataFrame(rows, "score long, _id long")
    keys = sorted((-s, (1 << 63) - 1 if i is None else i) for s, i in rows)
    for k in (1, 2, 250, 499, 500):
        assert resampling.select_kth(frame, k, pivots=2) == keys[k - 1]
    with pytest.raises(ValueError):
        resampling.select_kth(frame, 501, pivots=5)


def test_repeated_and_missing_ids_and_empty_tables(spark, ws, odd, empty):
    long = "w " * 30
    docs = spark.createDataFrame([(1, long)] * 10 + [(None, long)] * 10, "doc_id long, text string")
    rows = resampling.resample(docs, docs, ws, percent=50).collect()
    assert len(rows) == 20 and sorted(r["rank"] for r in rows if r["rank"]) == list(range(1, 11))
    assert min(r["score"] for r in rows if r["rank"]) >= max(r["score"] for r in rows if not r["rank"])
    assert resampling.resample(odd, odd, ws).count() == odd.count()
    assert resampling.resample(odd, empty, ws, percent=100).filter("rank IS NOT NULL").count() == 4
    assert resampling.resample(empty, odd, ws).count() == 0
