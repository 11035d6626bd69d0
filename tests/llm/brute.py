"""Plain, slow versions of the operators, for comparison on small tables."""

from __future__ import annotations

import re
from collections import Counter
from itertools import combinations

BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"


def words(text):
    folded = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in re.split(f"[{BLANKS}]+", folded) if w]


def shingles(text, size=5):
    found = words(text)
    if not found:
        return frozenset()
    return frozenset(tuple(found[k : k + size]) for k in range(max(1, len(found) - size + 1)))


def jaccard_components(rows, percent=80):
    """(doc_id, n_shingles, component_id) of rows (doc_id, text), in their order."""
    sets = [shingles(text) for _, text in rows]
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in combinations(range(len(rows)), 2):
        if sets[a] and sets[b]:
            both = len(sets[a] & sets[b])
            if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                root[max(find(a), find(b))] = min(find(a), find(b))
    least = {}
    for k, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(k)] = min(least.get(find(k), doc_id), doc_id)
    return [(d, len(sets[k]), least.get(find(k))) for k, (d, _) in enumerate(rows)]


def generalised_jaccard(a, b):
    x, y = Counter(words(a)), Counter(words(b))
    larger = sum((x | y).values())
    return sum((x & y).values()) / larger if larger else 1.0


def targets(sizes, weights=(5, 2, 1), most=3):
    """Target per source of {source: size}, resharing the excess until none is above its stop."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    total, stopped = sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in stopped]
        share = sum(weight[s] for s in free)
        level = (total - sum(stopped.values())) / share if share else 0.0
        above = [s for s in free if level * weight[s] > most * sizes[s]]
        if not above:
            return {**stopped, **{s: level * weight[s] for s in free}}
        stopped.update({s: float(most * sizes[s]) for s in above})
