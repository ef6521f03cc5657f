import random
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from flightlake.llm import bagminhash, queries
from flightlake.llm.components import connected_components
from tests.llm.util import SF01, bag, classes, jaccard


def make(seed=2):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(500)]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    rows = []
    base = text(300)
    for i in range(60):  # a group of many different near copies
        w = base.split()
        for _ in range(rng.randint(0, 6)):
            w[rng.randrange(len(w))] = rng.choice(vocabulary)
        rows.append((i, " ".join(w)))
    for i in range(100, 160):
        rows.append((i, text(rng.randint(1, 80))))
    for i in range(200, 230):  # copies and near copies of some of them
        w = rows[rng.randrange(60, 120)][1].split()
        if rng.random() < 0.5 and len(w) > 60:
            w[5] = "changed"
        rows.append((i, " ".join(w)))
    loop = "again and again the same line of words "
    rows += [(300, loop * 10), (301, loop * 11), (302, loop * 30), (303, loop * 31), (304, loop)]
    rows += [(400, ""), (401, ""), (402, None), (403, None), (404, "!!"), (405, "one"), (406, "One."), (407, "one two")]
    rows += [(500, base), (500, base), (None, base), (None, "alone here without any id at all"), (3, base + " more")]
    return rows


def test_classes_against_all_pairs(spark):
    rows = make()
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, bag string, n int")
    bags = [bag(t) for _, t in rows]

    def alike(i, j):
        if rows[i][1] is None or rows[j][1] is None:
            return False
        if not bags[i] or not bags[j]:
            return rows[i][1] == rows[j][1]
        return jaccard(bags[i], bags[j]) >= 0.8

    want = classes(rows, alike)
    got = bagminhash.near_duplicates(df).collect()
    assert Counter((r.doc_id, r.class_id) for r in got) == Counter((i, c) for (i, _), c in zip(rows, want))


def test_small_blocks_find_the_same(spark):
    df = spark.createDataFrame(make(), "doc_id long, text string")
    a = Counter(map(tuple, bagminhash.near_duplicates(df).collect()))
    assert a == Counter(map(tuple, bagminhash.near_duplicates(df, block_items=3_000).collect()))


def test_links_without_a_common_centre(spark):
    """Chains: each text is like the next one only, so a star finds few links."""
    rng = random.Random(4)
    w = [f"v{rng.randrange(900)}" for _ in range(200)]
    rows = []
    for i in range(40):
        rows.append((i, " ".join(w)))
        for _ in range(3):
            w[rng.randrange(len(w))] = f"n{rng.randrange(10**6)}"
    bags = [bag(t) for _, t in rows]
    want = classes(rows, lambda i, j: jaccard(bags[i], bags[j]) >= 0.8)
    got = {r.doc_id: r.class_id for r in bagminhash.near_duplicates(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: c for (i, _), c in zip(rows, want)}


def test_signatures_are_unbiased():
    rng = np.random.default_rng(0)
    off = []
    for _ in range(150):
        s = np.sort(rng.integers(0, 2**63, 50).astype(np.uint64))
        a = rng.integers(0, 12, 50)
        b = np.where(rng.random(50) < 0.6, a, rng.integers(0, 12, 50))
        j = np.minimum(a, b).sum() / np.maximum(a, b).sum()
        x, y = bagminhash.signatures([(s[a > 0], a[a > 0]), (s[b > 0], b[b > 0])])
        off.append(((x == y).mean() - j) / np.sqrt(j * (1 - j) / len(x)))
    assert abs(np.mean(off)) < 0.3 and 0.8 < np.std(off) < 1.25


def test_dedup_keeps_one_of_each(spark):
    df = spark.createDataFrame(make(), "doc_id long, text string").filter("doc_id <> 500 OR doc_id IS NULL")
    kept = bagminhash.drop_near_duplicates(df).collect()
    classes_ = bagminhash.near_duplicates(df).collect()
    want = {r.class_id for r in classes_ if r.doc_id is not None}
    assert {r.doc_id for r in kept if r.doc_id is not None} == want
    assert sum(r.doc_id is None for r in kept) == 2


def test_dedup_goes_by_row(spark):
    """Repeated rows, copies without an id, and an id shared with a copy."""
    base, other, third = (" ".join(f"{c}{i}" for i in range(40)) for c in "abc")
    rows = [(1, base, "x"), (1, base, "x"), (1, base, "y"), (2, base, "x"), (2, other, "clean"), (None, base, "x"),
            (None, third, "z"), (None, third, "z"), (7, None, "null"), (7, None, "null")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = bagminhash.drop_near_duplicates(df, null_ids_stay=False)
    assert kept.columns == df.columns
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter(
        [(1, base), (2, other), (None, third), (7, None), (7, None)])
    assert {(r.doc_id, r.text) for r in corpus_pipeline.drop_copies(spark, df, "").collect()} == {
        (1, base), (2, other), (None, third), (7, None)}


def test_query_on_small_tables(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF01}/documents.parquet").collect()]
    bags = [bag(t) for _, t in docs]
    sizes = [sum(b.values()) for b in bags]

    def alike(i, j):
        if min(sizes[i], sizes[j]) < 0.8 * max(sizes[i], sizes[j]) - 1e-9 or not (bags[i].keys() & bags[j].keys()):
            return False
        return jaccard(bags[i], bags[j]) >= 0.8

    got = {r.doc_id: r.class_id for r in queries.op7_bagminhash(spark, SF01).collect()}
    assert got == {i: c for (i, _), c in zip(docs, classes(docs, alike))}
    assert len(set(got.values())) < len(got)


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert bagminhash.near_duplicates(df).collect() == []
    assert connected_components(spark.createDataFrame([], "src long, dst long")).collect() == []
