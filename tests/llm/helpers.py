"""Brute-force versions that the operators are held against."""

import re
from collections import Counter


def roots(ids, links):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def shingle_counts(text, width=5):
    w = re.findall(r"\w+", (text or "").lower())
    return Counter(tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))) if w else Counter()


def weighted_jaccard(a, b):
    shared = sum((a & b).values())
    total = sum(a.values()) + sum(b.values()) - shared
    return shared / total if total else 0.0


def classes(docs, least=0.8):
    """{doc_id: class} of (doc_id, text) rows by comparing all pairs."""
    sets = [(i, shingle_counts(t)) for i, t in docs if i is not None]
    links = [(i, j) for n, (i, a) in enumerate(sets) for j, b in sets[:n] if a and b and weighted_jaccard(a, b) >= least]
    return roots({i for i, _ in sets}, links)
