from collections import Counter

from rootweave.llm import rules


def plain_repeats(text):
    words = rules._WORDS(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    count = Counter(windows)
    return len({i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(3)})


def test_measures():
    text = "a b c d a b c\nsame line\nsame line\n\n# * x"
    found = dict(zip(rules.MEASURES, rules.measure(text)))
    assert found["n_repeat_words"] == plain_repeats(text)
    assert (found["n_words"], found["n_dup_lines"], found["n_symbols"], found["n_lines"]) == (14, 1, 2, 4)
    assert rules.measure("a\x0bb\x0cc\xa0d")[0] == 3


def test_policies_are_masks_and_ablations_count_bits(spark, odd, empty):
    rows = rules.ledger(odd)
    found = rows.select("text", "failed_bits", rules.passes(rules.BASE).alias("base"), rules.passes(rules.PROSE_2).alias("all")).collect()
    assert len(found) == odd.count()
    assert all(row["base"] == (row["failed_bits"] & 3 == 0) and row["all"] == (row["failed_bits"] == 0) for row in found)
    bits = {rule.name: 1 << rule.bit for rule in rules.RULES}
    effects = {(r["policy"], r["version"], r["rule"]): r for r in rules.ablations(rows).collect()}
    assert len(effects) == sum(len(p.rules) for p in rules.POLICIES)
    for policy in rules.POLICIES:
        for name in policy.rules:
            effect = effects[policy.name, policy.version, name]
            assert effect["failed"] == sum(row["failed_bits"] & bits[name] != 0 for row in found)
            assert effect["only_this"] == sum(row["failed_bits"] & policy.mask == bits[name] for row in found)
            assert effect["kept"] == sum(row["failed_bits"] & policy.mask == 0 for row in found)
    assert rules.ledger(empty).count() == 0 and rules.ablations(rules.ledger(empty)).count() == 0
