"""Plain Python answers for small graphs."""

from collections import defaultdict


def components(edges, also=()):
    """entity -> frozenset of its component, for (rel_id, id_key) edges."""
    by_key, by_rel = defaultdict(set), defaultdict(set)
    for rel, key in edges:
        by_key[key].add(rel)
        by_rel[rel].add(key)
    found = {}
    for start in [*by_rel, *also]:
        if start in found:
            continue
        seen, todo = {start}, [start]
        while todo:
            for key in by_rel.get(todo.pop(), ()):
                fresh = by_key[key] - seen
                seen |= fresh
                todo.extend(fresh)
        group = frozenset(seen)
        found.update(dict.fromkeys(group, group))
    return found


def rank(seed):
    try:
        return (0, int(seed), seed)
    except ValueError:
        return (1, 0, seed)


def mapping(edges, seeds):
    """Set of (rel_id, root_id)."""
    groups = components(edges, seeds)
    result = set()
    for group in set(groups.values()):
        roots = group & set(seeds)
        if roots:
            best = min(roots, key=rank)
            result |= {(rel, best) for rel in group}
    return result
