import random

import pytest

from rootweave.operators import skew
from rootweave.plans import refresh
from rootweave.plans.rebuild import rebuild_mapping
from rootweave.sources import tables
from tests.world import OPEN, World


def pick(rng, g, what, n):
    return f"{g}{what}{rng.randrange(n):02d}"


@pytest.mark.parametrize("limit, steps", [(skew.BROADCAST_ROWS, 3), (0, 2)])
def test_random_changes_keep_refresh_equal_to_rebuild(spark, ws, monkeypatch, limit, steps):
    """60 random graphs in one pair of tables; both with short and with long key lists."""
    for module in (skew, refresh):
        monkeypatch.setattr(module, "BROADCAST_ROWS", limit)
    rng = random.Random(11 + limit)
    world = World(spark, ws)
    for g in range(100, 160):
        for _ in range(rng.randint(3, 30)):
            add = world.add if rng.random() < 0.5 else world.join
            add(pick(rng, g, "0", 12), pick(rng, g, "k", 10), rng.choice("YNNN"))
    world.refresh()
    world.check()
    for _ in range(steps):
        for row in rng.sample(world.register, len(world.register) // 12):
            row[4] = "N" if row[4] == "Y" else "Y"
        for row in rng.sample(world.register, len(world.register) // 20):
            row[2] = "2021-01-01 00:00:00" if row[2] == OPEN else OPEN
        for row in rng.sample(world.link, len(world.link) // 12):
            row[4] = "N" if row[4] == "Y" else "Y"
        for row in rng.sample(world.link, len(world.link) // 20):
            row[3] = row[3][:3] + f"k{rng.randrange(10):02d}"
        for row in rng.sample(world.link, len(world.link) // 30):
            row[0] = row[0][:3] + f"0{rng.randrange(12):02d}"
        world.link = [r for r in world.link if rng.random() > 0.03]
        before = set(world.output())
        stats = world.refresh()
        world.check()
        assert stats.output_rows == len(world.output())
        assert len({r for r, _ in before ^ set(world.output())}) <= stats.impacted_rel_ids
    assert world.refresh() == refresh.RunStats(0, 0, 0, 0, stats.output_rows)


def test_adversarial_cases(spark, ws):
    """Each case uses names of its own, so that one refresh covers them all."""
    w = World(spark, ws)
    w.add("100", "dom", "Y"), w.add("200", "dom", "Y"), w.join("300", "dom")            # dominated seed
    w.add("1100", "leave", "Y"), w.join("1300", "leave")                                # seed leaves its key
    w.add("2100", "a", "Y"), w.add("2200", "b", "Y")                                    # two-seed split
    w.join("2300", "a"), w.join("2300", "b"), w.join("2400", "b")
    w.add("3100", "c", "Y"), w.add("3200", "d", "Y"), w.join("3400", "d")               # merge
    w.add("4100", "  ", "Y")                                                            # seed without an edge
    w.add("99", "num", "Y"), w.add("5000", "num", "Y")                                  # numeric, not lexical
    w.add("X1", "text", "Y"), w.add("A7", "text", "Y")                                  # no numbers
    w.add("007", "bond", "Y")                                                           # leading zeros
    for key in (None, "", "  ", " k", "k"):
        w.join(f"dirty{key}", key)
    w.add("6100", " k", "Y")
    w.refresh()
    w.check()
    found = dict(w.output())
    assert [found[r] for r in ("100", "200", "300")] == ["100"] * 3
    assert {found[r] for r in ("2100", "2200", "2300", "2400")} == {"2100"}
    assert found["4100"] == "4100" and found["5000"] == "99" and found["X1"] == "A7" and found["007"] == "007"
    assert found["dirty k"] == "6100" and "dirtyk" not in found

    w.register[0][4] = "N"
    w.register[2][3] = "elsewhere"
    w.link[3][4] = "Y"
    w.join("3400", "c")
    w.add("5", "text", "Y")
    w.refresh()
    w.check()
    found = dict(w.output())
    assert [found[r] for r in ("100", "200", "300")] == ["200"] * 3
    assert found["1100"] == "1100" and "1300" not in found
    assert [found[r] for r in ("2100", "2300", "2200", "2400")] == ["2100", "2100", "2200", "2200"]
    assert {found[r] for r in ("3100", "3200", "3400")} == {"3100"}
    assert {found[r] for r in ("X1", "A7", "5")} == {"5"}


def test_interrupted_commit_leads_to_a_rebuild(spark, ws):
    w = World(spark, ws)
    w.add("1", "a", "Y"), w.join("2", "a")
    w.refresh()
    edges = w.cfg.state(refresh.EDGES)
    tables.set_properties(spark, edges, {refresh.RUN_ID: "current-other"})
    assert refresh.committed_run(spark, w.cfg) is None
    tables.swap_transform(spark, w.cfg.output, lambda df: df.limit(0))
    w.join("3", "a")
    w.refresh()
    w.check()
    assert refresh.committed_run(spark, w.cfg)

    spark.sql(f"ALTER TABLE {w.cfg.output} RENAME TO {w.cfg.output}{tables.OLD}")
    assert w.refresh() == refresh.RunStats(0, 0, 0, 0, 3)
    w.check()


def test_carry_forward_keeps_and_later_drops_unknown_rows(spark, ws):
    w = World(spark, ws, carry_forward=True)
    w.add("1", "a", "Y"), w.add("5", "b", "Y"), w.join("2", "a")
    refresh.ensure_tables(spark, w.cfg)
    old = spark.createDataFrame([("8", "1"), ("9", "5"), ("7", "gone"), ("2", "5")], "REL_ID string, REL_ID_REGIE_KLANT string")
    tables.swap_replace(spark, w.cfg.output, old)
    w.refresh()
    assert set(w.output()) == {("1", "1"), ("2", "1"), ("5", "5"), ("8", "1"), ("9", "5")}
    w.register[1][4] = "N"
    w.refresh()
    assert set(w.output()) == {("1", "1"), ("2", "1"), ("8", "1")}


def test_rebuild_of_both_scopes_writes_the_output(spark, ws):
    for scope in ("history", "current"):
        w = World(spark, ws, edge_scope=scope)
        w.add("1", "a", "Y"), w.join("2", "a", deleted="Y"), w.join("3", "a", end="2021-01-01 00:00:00"), w.join("4", "a")
        w.save()
        rows = {tuple(r) for r in rebuild_mapping(spark, w.cfg, ws).collect()}
        assert rows == set(w.output()) == w.expected(history=scope == "history")
        assert {tuple(r) for r in rebuild_mapping(spark, w.cfg, ws, write=False).collect()} == rows
