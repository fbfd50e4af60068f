"""Plain versions of the operators, for small inputs."""
from __future__ import annotations

import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingles(text: str | None) -> frozenset:
    words = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()


def components(sets: list[frozenset]) -> list[int]:
    """Least position reachable over links of a similarity of 0.75 or more."""
    parent = list(range(len(sets)))

    def top(k):
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    holders = defaultdict(list)
    for k, s in enumerate(sets):
        for x in s:
            holders[x].append(k)
    for k, s in enumerate(sets):
        shared = Counter(j for x in s for j in holders[x] if j < k)
        for j, both in shared.items():
            if 100 * both >= 75 * (len(s) + len(sets[j]) - both):
                a, b = top(k), top(j)
                parent[max(a, b)] = min(a, b)
    return [top(k) for k in range(len(sets))]


def near_duplicates(rows: list[tuple]) -> list[tuple]:
    """(doc_id, n_shingles, component_id, kept) of (doc_id, text) rows."""
    sets = [shingles(t) for _, t in rows]
    comp = components(sets)
    members = defaultdict(list)
    for k, c in enumerate(comp):
        members[c].append(rows[k][0])
    out = []
    for k, (i, _) in enumerate(rows):
        own = [x for x in members[comp[k]] if x is not None] if sets[k] else [i]
        least = min(own, default=None) if sets[k] else i
        out.append((i, len(sets[k]), least, i == least))
    return out
