"""Plain-Python versions of what the operators compute, and small inputs."""

import re
from collections import Counter

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return _WORD.findall((text or "").translate(_LOWER))


def bag(text, k=5):
    w = words(text)
    n = min(k, len(w))
    return Counter(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if n else Counter()


def jaccard(a, b):
    union = sum((a | b).values())
    return sum((a & b).values()) / union if union else 0.0


def classes(rows, alike):
    """Smallest id of each connected group; ``alike`` tells of two row numbers."""
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if root(i) != root(j) and alike(i, j):
                parent[root(i)] = root(j)
    smallest = {}
    for i, (doc_id, _) in enumerate(rows):
        r = root(i)
        smallest[r] = min((x for x in (smallest.get(r), doc_id) if x is not None), default=None)
    return [smallest[root(i)] for i in range(len(rows))]
