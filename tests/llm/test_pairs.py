"""The two similarity joins against brute force."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from rootweave.llm import embeddings, jaccard

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def classes(nodes, linked):
    name = {}
    for start in sorted(nodes):
        todo = [start] if start not in name else []
        while todo:
            at = todo.pop()
            if at not in name:
                name[at] = start
                todo += [b for b in nodes if b not in name and linked(at, b)]
    return name


def shingles(text, size):
    words = WORDS.findall(text.lower() if text else "")
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if len(words) >= size else {tuple(words)} if words else set()


@pytest.mark.parametrize(("size", "percent"), [(3, 90), (5, 80)])
def test_jaccard_components(spark, ws, size, percent):
    rng = random.Random(size)
    vocabulary = [f"w{k}" for k in range(400)]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    texts = []
    for length in (2, 3, 9, 10, 11, 19, 20, 40, 150, 400):
        base = [rng.choice(vocabulary) for _ in range(length)]
        for _ in range(14):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, length // 40))):
                copy[rng.randrange(length)] = rng.choice(vocabulary)
            texts.append(" ".join(copy))
    texts += [" ".join(passage + [rng.choice(vocabulary) for _ in range(40)]) for _ in range(30)]
    texts += ["one two", "One TWO", "Äpfel two three", "äpfel two three", "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r for r in jaccard.jaccard_components(docs, ws, size=size, percent=percent).collect()}
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = {}
    for i, t in enumerate(texts):
        words = WORDS.findall((t or "").translate(lower))
        sets[i] = {tuple(words[k : k + size]) for k in range(len(words) - size + 1)} if len(words) >= size else {tuple(words)} if words else set()
    linked = lambda a, b: bool(sets[a]) and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]) and bool(sets[b])
    expected = classes(list(sets), linked)
    assert {i: r["component_id"] for i, r in found.items()} == expected
    assert {i: r["n_shingles"] for i, r in found.items()} == {i: len(s) for i, s in sets.items()}


def met_rows(monkeypatch):
    """How many rows each join on the token makes, as a list that fills."""
    counts, meet = [], jaccard._meet

    def counted(*args):
        rows = meet(*args)
        counts.append(rows.count())
        return rows

    monkeypatch.setattr(jaccard, "_meet", counted)
    return counts


def variants(rng, number, length, changed):
    base = [f"b{k}" for k in range(length)]
    texts = []
    for _ in range(number):
        copy = list(base)
        for at in rng.sample(range(length), changed):
            copy[at] = f"v{rng.randrange(10**9)}"
        texts.append(copy)
    return texts


def test_variants_that_do_not_link_make_no_rows_under_a_token(spark, ws, monkeypatch):
    """Texts of a thousand words, alike by a half to two thirds: their tokens meet, and sketches of 512 bits are full."""
    texts = variants(random.Random(3), 24, 1_000, 30)
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    counts = met_rows(monkeypatch)
    rows = jaccard.jaccard_components(docs, ws).collect()
    assert all(r["component_id"] == r["doc_id"] for r in rows)
    assert len(counts) == 2 and sum(counts) == 0


def test_a_turn_offers_each_set_one_set_of_another_group(spark):
    rows = [(i, token, i % 40 if i < 80 else i, i >= 80) for i in range(120) for token in (1, 2, 3)] + [(500, 9, 500, True)]
    placed = spark.createDataFrame(rows, "_id long, token long, g long, alone boolean")
    group = {i: g for i, _, g, _ in rows}
    turns = [{r["a"]: r["b"] for r in jaccard._offered(placed, turn).collect()} for turn in (1, 2)]
    for offers in turns:
        assert offers.keys() == set(range(120)) and all(group[a] != group[b] for a, b in offers.items())
        assert len(set(offers.values())) <= 2  # of each token the same two
    assert turns[0] != turns[1]


def test_sets_alone_ask_groups_and_meet_each_other_once(spark):
    rows = [(i, 1, 0 if i < 5 else i, i >= 5, 9, 10, [0] * 8) for i in range(9)]
    placed = spark.createDataFrame(rows, "_id long, token long, g long, alone boolean, sets long, n long, sketch array<long>")
    held = placed.filter("alone OR _id = 0")
    first = {tuple(r) for r in jaccard._meet(placed, held, False, 80).collect()}
    assert first == {(a, b, b) for a in range(5, 9) for b in range(5, a)} | {(a, 0, 0) for a in range(5, 9)}
    again = {tuple(r) for r in jaccard._meet(placed, placed, True, 80).collect()}
    assert again == {(a, 0, b) for a in range(5, 9) for b in range(5)}


def test_sketches_of_other_widths_are_folded(spark):
    rng = np.random.default_rng(6)
    base = np.unique(rng.integers(0, 1 << 63, 2_500, dtype=np.uint64))
    for n in (100, 800, 900, 1_300, 2_500):
        part = base[:n]
        words = jaccard.sketch(jaccard.wide_sketch(part), n)
        assert jaccard.BITS <= 64 * len(words) <= jaccard.MOST_BITS
        for m in (100, 700, 2_400):
            other = base[:m]
            rows = [(n, words.tolist(), m, jaccard.sketch(jaccard.wide_sketch(other), m).tolist())]
            row = spark.createDataFrame(rows, "n long, sketch array<long>, m long, other array<long>")
            x, y = row.select("n", "sketch").alias("x"), row.select(F.col("m").alias("n"), F.col("other").alias("sketch")).alias("y")
            least = 100 * min(n, m) // max(n, m)  # the sets link at this percentage and no sketch may deny it
            assert x.join(y, jaccard._close(least)).count() == 1


def test_jaccard_odd_rows(spark, odd, empty, ws):
    rows = jaccard.jaccard_components(odd, ws).collect()
    assert len(rows) == odd.count()
    assert all(r["component_id"] == r["doc_id"] for r in rows if r["doc_id"] not in (7, 8))
    assert all(r["component_id"] == 7 for r in rows if r["doc_id"] in (7, 8))
    assert jaccard.jaccard_components(empty, ws).count() == 0


def test_vectors_against_brute_force(spark, ws):
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((60, 24))
    near = centres[rng.integers(0, 60, 1_500)] + 0.22 * rng.standard_normal((1_500, 24))
    vectors = np.vstack([near, rng.standard_normal((1_500, 24)), np.repeat(centres[:1] * 3, 300, axis=0)])
    rows = [(i, [float(x) for x in v], 0) for i, v in enumerate(vectors)]
    unit = vectors / np.linalg.norm(vectors, axis=1)[:, None]
    links = (unit @ unit.T >= 0.9) & ~np.eye(len(unit), dtype=bool)
    odd = [None, [], [0.0] * 24, [float("nan")] + [1.0] * 23, [float("inf")] + [1.0] * 23, [None] + [1.0] * 23, [1.0, 2.0]]
    rows += [(10_000 + i, v, None) for i, v in enumerate(odd)] + [(None, rows[0][1], 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found = embeddings.near_duplicates(frame, ws, sample=1_000, leaf=60).collect()
    assert len(found) == len(rows)
    by_id = {r["vec_id"]: r for r in found}
    degree = links.sum(axis=1)
    got = np.array([by_id[i]["n_links"] for i in range(len(unit))])
    assert (got <= degree).all() and got.sum() >= 0.9 * degree.sum()
    assert all(by_id[10_000 + i]["n_links"] == 0 and by_id[10_000 + i]["kept"] for i in range(len(odd)))
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in found if r["vec_id"] is not None)
    assert embeddings.near_duplicates(frame.limit(0), ws).count() == 0


def test_sketches_never_count_more_than_the_sets_differ_in():
    rng = np.random.default_rng(5)
    for n in (0, 1, 3, 250, 257, 1_000, 5_000, 40_000):
        base = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        for gone, added in ((0, 0), (n // 50, n // 20), (n // 9, 0), (n, 7), (n // 2, 3 * n)):
            other = np.unique(np.concatenate([base[gone:], rng.integers(0, 1 << 63, added, dtype=np.uint64)]))
            differ = len(np.setxor1d(base, other))
            apart = jaccard.least_apart(jaccard.wide_sketch(base), jaccard.wide_sketch(other))
            assert apart <= differ and apart == jaccard.least_apart(jaccard.wide_sketch(other), jaccard.wide_sketch(base))
            if 0 < differ <= len(base) // 4:  # a small difference is hardly hidden
                assert apart >= 0.6 * differ
