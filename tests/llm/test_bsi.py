import math
import random

import numpy as np
import pytest

from flightlake.llm import bsi


def brute(rows, k=10):
    def q(v):
        if v is None or any(x is None or not math.isfinite(x) for x in v):
            return None
        return [math.floor(1024 * x) if math.isfinite(1024 * x) else math.floor(x) * 1024 for x in v]

    kept = [(n, i, q(v)) for n, (i, v) in enumerate(rows) if i is not None and q(v) is not None]
    long = (1 << 63) - 1
    out = []
    for n, qi, qv in kept:
        if qi % 100 == 0:
            scored = sorted((-max(-long, min(long, sum(a * b for a, b in zip(qv, v)))), i)
                            for m, i, v in kept if m != n and len(v) == len(qv))
            out += [(qi, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def vectors(seed, n, dim=8, scale=1.0):
    rng = random.Random(seed)
    return [(i, [rng.gauss(0, scale) for _ in range(dim)]) for i in range(n)]


ODD = [(2000, None), (2100, [1.0, None] + [0.0] * 6), (2200, [float("nan")] * 8), (2300, [float("inf")] + [0.0] * 7),
       (None, [1.0] * 8), (2400, []), (2401, []), (2500, [0.5] * 3), (2501, [-0.5] * 3), (2600, [0.0] * 8),
       (2700, [1e300] + [0.0] * 7), (2800, [1e308, -1e308] + [1.0] * 6), (2900, [70_000.0] + [0.0] * 7),
       (2901, [90_000.0] + [0.0] * 7), (2902, [80_000.0] + [0.0] * 7), (2903, [3e6, -2.0] + [0.0] * 6),
       (2904, [5e6, 3e9] + [0.0] * 6)]


@pytest.mark.parametrize("block_rows,query_rows", [(bsi.BLOCK_ROWS, bsi.QUERY_ROWS), (130, 3)])
def test_against_brute_force(spark, block_rows, query_rows):
    base = vectors(1, 900)
    rows = base + [(100, base[9][1]), (100, base[100][1]), (0, base[3][1])] + [(1000 + i, base[5][1]) for i in range(80)] + ODD + [(3100, base[7][1])] * 3 + [(3200, base[8][1])]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, score string")
    got = sorted(map(tuple, bsi.top_k(df, "vec_id % 100 = 0", block_rows=block_rows, query_rows=query_rows).collect()))
    assert got == brute(rows)


def test_fewer_than_k_and_none(spark):
    df = spark.createDataFrame(vectors(2, 4, 3), "vec_id long, embedding array<double>")
    assert sorted(map(tuple, bsi.top_k(df, "vec_id = 0").collect())) == brute(vectors(2, 4, 3))
    assert bsi.top_k(df.limit(0), "vec_id = 0").collect() == []
    assert bsi.top_k(df, "vec_id = 77").collect() == []


def test_large_components_keep_their_order(spark):
    rows = [(0, [1.0]), (1, [70_000.0]), (2, [90_000.0]), (3, [80_000.0]), (4, [4e6]), (5, [3e6]), (6, [-3e6])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert [r.vec_id for r in bsi.top_k(df, "vec_id = 0").orderBy("rank").collect()] == [4, 5, 2, 3, 1, 6]


def test_slices_add_and_compare():
    rng = np.random.default_rng(3)
    vals = rng.integers(-900, 900, (200, 6)).astype(np.int32)
    block = bsi.SlicedBlock(np.arange(200), np.arange(200), vals)
    weights = rng.integers(0, 200, 6)
    negative = rng.random(6) < 0.5
    slices = block.score_slices(weights, negative)
    coarse = (vals - vals.min(axis=0)) >> block.shift
    coarse = np.where(negative, (1 << block.bits) - 1 - coarse, coarse)
    want = coarse @ weights
    got = sum(np.unpackbits(s.view(np.uint8), bitorder="little")[:200].astype(int) << b for b, s in enumerate(slices))
    assert (got == want).all()
    for k in (1, 7, 200):
        assert block.kth_value(slices, block.all, k) == np.sort(want)[-k]
    assert block.kth_value(slices, block.all, 201) == 0
    v = int(np.median(want))
    rows = np.flatnonzero(np.unpackbits(block.at_least(slices, v).view(np.uint8), bitorder="little"))
    assert rows.tolist() == np.flatnonzero(want >= v).tolist()


def test_products_beyond_a_long_saturate():
    big = np.full((1, 4096), bsi.LIMIT - 1, dtype=np.int32)
    assert bsi.exact_products(big, big[0].astype(np.int64)).tolist() == [(1 << 63) - 1]
