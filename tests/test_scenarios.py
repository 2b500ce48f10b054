"""Sequences of changes on the same tables; deltas and counters come from brute force."""

import random

from rootweave.operators.checks import golden_compare
from rootweave.operators.edges import active_seeds, build_edges, load_sources, untagged
from rootweave.plans.rebuild import rebuild_mapping
from rootweave.plans.scenario import Scenario, run_scenario, run_sequence
from tests.world import OPEN, World

PAIR = "REL_ID string, REL_ID_REGIE_KLANT string"
DELTA = f"kind string, {PAIR}"
ENDED = "2021-11-11 11:11:11"


def random_world(spark, ws, seed=5, entities=24, keys=20, **overrides):
    """Some entities with a register row, every third of them a root, and random links, some of which have ended."""
    rng = random.Random(seed)
    w = World(spark, ws, **overrides)
    names = [str(rng.randrange(10, 5_000)) if i % 4 else f"ent-{i}" for i in range(entities)]
    for i, name in enumerate(names[: entities // 2]):
        w.add(name, f"key{rng.randrange(keys)}", "N" if i % 3 else "Y", OPEN if rng.random() < 0.8 else ENDED)
    for name in names:
        w.join(name, f"key{rng.randrange(keys)}", rng.choice("NNNY"), OPEN if rng.random() < 0.7 else ENDED)
    return w


def state(w):
    edges, seeds = w.graph()
    return set(edges), seeds, w.expected()


def test_history_scope(spark, ws):
    w = random_world(spark, ws, edge_scope="history")
    w.save()
    sources = load_sources(spark, w.cfg)
    edges, seeds = w.graph(history=True)
    assert untagged(build_edges(sources, w.cfg)).count() == len(set(edges))
    assert {r[0] for r in active_seeds(sources, w.cfg).collect()} == seeds
    golden = spark.createDataFrame(sorted(w.expected(history=True)), PAIR)
    assert golden_compare(rebuild_mapping(spark, w.cfg, ws), golden).isEmpty()


def test_sequence(spark, ws):
    w = random_world(spark, ws)
    edges, seeds, mapped = state(w)
    stats = w.refresh()
    assert (stats.changed_edges, stats.added_seeds, stats.output_rows) == (len(edges), len(seeds), len(mapped))
    rooted = sorted((rel, key) for rel, key in edges if rel in {rel for rel, _ in mapped})
    key = rooted[0][1]
    root = next(r for r in w.register if r[4] == "Y" and r[2] == OPEN and r[0] != rooted[0][0])

    def change(name, column, value):
        next(r for r in w.link if r[0] == name)[column] = value

    steps = {
        "new root": lambda: w.add("fresh", "fresh key", "Y"),
        "root lost": lambda: root.__setitem__(4, "N"),
        "entity joins": lambda: w.join("guest", key),
        "entity renamed": lambda: change("guest", 0, "renamed"),
        "nothing": lambda: None,
        "further key": lambda: w.join(rooted[0][0], "further key"),
        "same link again": lambda: w.join("renamed", key),
        "link to end": lambda: w.join("short", key),
        "root and link": lambda: (w.add("pair", "pair key", "Y"), w.join("partner", "pair key")),
        "register and link": lambda: (w.add("left", key, "N"), w.join("right", key)),
        "nothing again": lambda: None,
        "link ended": lambda: change("short", 2, ENDED),
        "link open again": lambda: change("short", 2, OPEN),
        "link moved": lambda: change("partner", 3, key),
    }
    for case, step in steps.items():
        edges, seeds, mapped = state(w)
        step()
        edges_now, seeds_now, mapped_now = state(w)
        delta = [("inserted", *p) for p in mapped_now - mapped] + [("removed", *p) for p in mapped - mapped_now]
        result = run_scenario(
            spark, w.cfg, Scenario(case, lambda *_: w.save(), spark.createDataFrame(delta, DELTA)), ws
        )
        assert result.passed, (case, [tuple(r) for r in result.delta.collect()])
        stats = result.stats
        moves = (len(edges ^ edges_now), len(seeds_now - seeds), len(seeds - seeds_now), len(mapped_now))
        assert (stats.changed_edges, stats.added_seeds, stats.removed_seeds, stats.output_rows) == moves, case
        assert set(w.output()) == mapped_now, case


def test_results_name_the_cause_of_a_failure(spark, ws):
    w = random_world(spark, ws)
    w.refresh()
    nothing = spark.createDataFrame([], DELTA)

    def new_root(*_):
        w.add("fresh", "fresh key", "Y")
        w.save()

    none_such = spark.table(f"{w.db}.ggm_np").filter("rel_id = 'nobody'")
    results = run_sequence(spark, w.cfg, [
        Scenario("lacks a row", new_root, nothing, needs=(none_such,)),
        Scenario("other delta", new_root, nothing),
        Scenario("idle", lambda *_: None, nothing),
    ], ws)
    assert [tuple(r) for r in results.collect()] == [
        ("lacks a row", False, 0, 0, "data precondition"),
        ("other delta", False, 1, 0, "logic"),
        ("idle", True, 0, 0, None),
    ]
