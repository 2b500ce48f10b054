import itertools
import math
import random
import zlib

import numpy as np

from rootweave.llm import toxicity


def corpus(n=1_600):
    rng = random.Random(9)
    plain = ["calm", "river", "stone", "garden", "letter", "window", "morning", "paper", "silver", "travel"]
    bad = ["vilewort", "grimscum", "dregling"]
    docs, labels = [], []
    for i in range(n):
        words = [rng.choice(plain) + rng.choice(["", "s", "ly"]) for _ in range(rng.randint(20, 90))]
        toxic = rng.random() < 0.2
        if toxic:
            for _ in range(3):
                words[rng.randrange(len(words))] = rng.choice(bad).capitalize() + "!"
        docs.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return docs, labels


def test_held_out_documents(spark, ws, odd, empty):
    docs, labels = corpus()
    frame, marks = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.train(frame, marks, ws)
    rows = toxicity.score(frame, model).withColumn("held_out", toxicity.is_held_out("doc_id")).collect()
    truth, texts = dict(labels), dict(docs)
    assert all(row["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 4 == 2) for row in rows)
    held = [row for row in rows if row["held_out"]]
    assert sum((row["toxicity"]["score"] >= 0.3) == truth[row["doc_id"]] for row in held) >= 0.97 * len(held)
    words = {texts[r["doc_id"]][s["start"] : s["end"]].strip("!").lower() for r in held for s in r["toxicity"]["spans"]}
    assert words == {"vilewort", "grimscum", "dregling"}
    assert toxicity.score(odd, model).count() == odd.count()
    assert toxicity.score(empty, model).count() == 0
    none = toxicity.train(empty, marks, ws)
    assert {r["toxicity"]["score"] for r in toxicity.score(odd, none).collect()} == {0.0}


def test_labels_of_held_out_documents_are_not_used(spark, ws):
    docs, labels = corpus(300)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    turned = [(i, 1 - y if zlib.crc32(str(i).encode()) % 4 == 2 else y) for i, y in labels]
    models = [toxicity.train(frame, spark.createDataFrame(m, "doc_id long, toxic int"), ws) for m in (labels, turned)]
    assert models[0].level == models[1].level and models[0].logit == models[1].logit


def test_marginals_are_those_of_all_paths():
    weight = np.array([-1.5, 0.7, 2.0] + [0.0] * (toxicity.LEVELS - 3))
    model = toxicity.Model({}, weight, into=-0.8, stay=0.6, leave=0.3)
    levels = [0, 0, 1, 0, 2, 2, 0, 0, 1]
    total, marginal = 0.0, np.zeros(len(levels))
    for path in itertools.product((0, 1), repeat=len(levels)):
        x, before = 0.0, 0
        for state, level in zip(path, levels):
            x += {(0, 0): 0.0, (0, 1): model.into, (1, 0): model.leave, (1, 1): model.stay}[before, state] + state * weight[level]
            before = state
        total += math.exp(x)
        marginal += math.exp(x) * np.array(path)
    for i, p in toxicity.Tagger(model).marginals(levels):
        assert abs(p - marginal[i] / total) < 1e-9
