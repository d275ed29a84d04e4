"""Plain single-machine versions that the operators are held against."""

from __future__ import annotations

from collections import Counter, defaultdict


def shingle_set(text):
    words = (text or "").lower().split()
    if not words:
        return frozenset()
    width = min(5, len(words))
    return frozenset(tuple(words[i:i + width]) for i in range(len(words) - width + 1))


def near_classes(rows, threshold=0.8):
    """{row number: (class id, links)} of (doc_id, text) rows by comparing all sets that share a shingle."""
    sets = [shingle_set(t) for _, t in rows]
    by_set = defaultdict(list)
    for i, s in enumerate(sets):
        by_set[s].append(i)
    nodes = list(by_set)
    holders = defaultdict(list)
    for n, s in enumerate(nodes):
        for x in s:
            holders[x].append(n)
    links, parent = defaultdict(set), list(range(len(nodes)))

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for n, s in enumerate(nodes):
        shared = Counter(m for x in s for m in holders[x] if m > n)
        for m, k in shared.items():
            if k >= threshold * (len(s) + len(nodes[m]) - k):
                links[n].add(m)
                links[m].add(n)
                parent[root(n)] = root(m)
    ids = defaultdict(list)
    for n, s in enumerate(nodes):
        ids[root(n)] += [rows[i][0] for i in by_set[s] if rows[i][0] is not None]
    out = {}
    for n, s in enumerate(nodes):
        k = len(by_set[s]) - 1 + sum(len(by_set[nodes[m]]) for m in links[n])
        for i in by_set[s]:
            out[i] = (min(ids[root(n)], default=None), k)
    return out
