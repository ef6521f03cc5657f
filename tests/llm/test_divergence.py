import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from flightlake.llm import divergence

SCHEMA = "lang string, source string, text string"


def brute(rows):
    docs, count, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        found = [t.decode() for t in divergence.terms(text)]
        docs[lang].update(set(found))
        count[lang, source].update(found)
        groups[lang].add(source)
    out = []
    for lang, sources in groups.items():
        kept = sorted(t for t, n in docs[lang].items() if n >= 3)
        whole = Counter()
        for s in sources:
            whole.update(count[lang, s])

        def shares(c):
            total = sum(c[t] for t in kept) + len(kept)
            return [1 + 10**9 * (c[t] + 1) // total for t in kept]

        p = {s: shares(count[lang, s]) for s in sources}
        q = shares(whole)
        for s in sources:
            pairs = [(sum((a - b) ** 2 // b for a, b in zip(p[s], p[o])), o) for o in sources if o != s]
            own = [((a - b) ** 2 // b, t) for a, b, t in zip(p[s], q, kept) if count[lang, s][t] and a > b]
            for part, items in (("pair", pairs), ("term", own)):
                items = sorted(items, key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, t, v, i + 1) for i, (v, t) in enumerate(items) if part == "pair" or i < 200]
    return sorted(out)


def found(df):
    return sorted(map(tuple, df.select("lang", "source", "part", "item", "value", "rank").collect()))


def corpus(seed, n, sources):
    rng = random.Random(seed)
    names = ["Ab", "c", "über", "Éa", "zz", "_x", "k9", *(f"w{chr(97 + i)}" for i in range(20))]
    return [("en" if rng.random() < 0.7 else "de", rng.choice(sources), " ".join(rng.choices(names, k=rng.randrange(30))))
            for _ in range(n)]


ODD = [(None, None, "a b"), ("en", None, None), ("", "s1", "a a a"), ("fr", "s1", "rare words"), ("fr", "s2", None),
       ("", None, "a"), ("xx", "alone", "one two"), ("en", "s0", "ab, " * 4000), ("en", "s0", "same"), ("en", "s0", "same")]


@pytest.mark.parametrize("options", [{}, {"block_terms": 4, "bucket_groups": 2}])
def test_against_brute_force(spark, options):
    rows = corpus(1, 150, [f"s{i}" for i in range(7)]) + ODD
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA + ", term string")  # a clashing name
    assert found(divergence.audit_sources(df, **options)) == brute(rows)


def test_counts_are_handed_on_in_parts(spark, monkeypatch):
    monkeypatch.setattr(divergence, "HELD_TERMS", 5)
    rows = corpus(2, 60, ["a", "b"])
    assert found(divergence.audit_sources(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_empty(spark):
    assert divergence.audit_sources(spark.createDataFrame([], SCHEMA)).collect() == []


def test_equal_subtrees_are_one_node_and_priced_once():
    counts = np.zeros((2, 1024), dtype=np.int64)
    counts[1, 512:] = 3
    trees = divergence.SharedTrees(counts)
    assert [len(left) for left, _ in trees.kids] == [2] * 9 + [2]
    pair, x, y, times = trees.walk(np.array([0]), np.array([1]))
    assert sorted(zip(x.tolist(), y.tolist(), times.tolist())) == [(0, 0, 512), (0, 3, 512)]


def test_prices_are_exact_beyond_a_long():
    counts = np.array([[1 << 40, 0], [5, 7]], dtype=np.int64)
    totals = counts.sum(axis=1) + 2
    there, back = divergence.pair_prices(counts, totals, np.array([0]), np.array([1]))
    p, q = ([1 + 10**9 * (int(c) + 1) // int(t) for c in row] for row, t in zip(counts, totals))
    assert there[0] == sum((a - b) ** 2 // b for a, b in zip(p, q))
    assert back[0] == sum((a - b) ** 2 // a for a, b in zip(p, q))
