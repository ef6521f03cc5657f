import random

import numpy as np

from pyspark.sql import functions as F

from flightlake.operators.spatial import _cells_around, _placed, spatial_nms, sure_maxima

SCHEMA = "lat_cluster double, lon_cluster double, flight_count long"


def greedy(points, thr=0.2):
    pts = sorted(points, key=lambda r: (-r[2], r[0], r[1]))
    active = [True] * len(pts)
    for i, (la, lo, _) in enumerate(pts):
        if not active[i]:
            continue
        for j in range(i + 1, len(pts)):
            d = (pts[j][0] - la) ** 2 + ((pts[j][1] - lo) * np.cos(np.radians(la))) ** 2
            if d < thr * thr:
                active[j] = False
    return [p for p, a in zip(pts, active) if a]


def run(spark, pts):
    """Walked by one task, and in rounds to the end: the same."""
    df = spark.createDataFrame(pts, SCHEMA)
    walked = [tuple(r) for r in spatial_nms(df).collect()]
    assert [tuple(r) for r in spatial_nms(df, local_rows=0).collect()] == walked
    return walked


def test_chain_equal_and_antimeridian(spark):
    pts = [(10.0, 10.0, 5), (10.15, 10.0, 4), (10.3, 10.0, 3),     # A suppresses B; C survives
           (20.0, 20.0, 2), (20.0, 20.1, 2),                       # equal strength: lower lon wins
           (80.0, 30.0, 3), (80.0, 30.9, 2),                       # 0.9 deg lon at 80 N is ~0.156 scaled
           (0.0, -179.95, 1), (0.0, 179.95, 1)]                    # no wrap at the antimeridian
    got = run(spark, pts)
    assert got == greedy(pts)
    assert (10.3, 10.0, 3) in got and (10.15, 10.0, 4) not in got
    assert (20.0, 20.1, 2) not in got and (80.0, 30.9, 2) not in got
    assert (0.0, -179.95, 1) in got and (0.0, 179.95, 1) in got


def test_random_against_sequential(spark):
    rnd = random.Random(7)
    pts = list({(round(rnd.uniform(40, 41), 2), round(rnd.uniform(5, 6), 2)) for _ in range(250)})
    pts = [(a, b, rnd.randint(1, 4)) for a, b in pts]
    got = run(spark, pts)
    assert got == greedy(pts)
    # survivors are pairwise apart; every suppressed point has a stronger survivor nearby
    for i, p in enumerate(got):
        for q in got[i + 1:]:
            assert (q[0] - p[0]) ** 2 + ((q[1] - p[1]) * np.cos(np.radians(p[0]))) ** 2 >= 0.04


def test_duplicate_positions(spark):
    pts = [(1.0, 1.0, 3), (1.0, 1.0, 5), (1.1, 1.0, 4), (5.0, 5.0, 1), (5.0, 5.0, 1)]
    got = run(spark, pts)
    assert got == [(1.0, 1.0, 5), (5.0, 5.0, 1)]


def test_nothing_to_suppress(spark):
    assert run(spark, [(1.0, 1.0, 1), (5.0, 1.0, 2)]) == [(5.0, 1.0, 2), (1.0, 1.0, 1)]
    assert spatial_nms(spark.createDataFrame([], SCHEMA)).collect() == []


def test_rounds_near_the_poles_and_over_bands(spark):
    rnd = random.Random(11)
    pts = [(rnd.choice([1, -1]) * round(rnd.uniform(84, 90), 1), round(rnd.uniform(-180, 180), 0), rnd.randint(1, 9)) for _ in range(120)]
    pts += [(round(rnd.uniform(59.5, 60.5), 2), round(rnd.uniform(-0.6, 0.6), 2), rnd.randint(1, 50)) for _ in range(200)]
    best = {}
    for a, b, s in pts:
        best[a, b] = max(s, best.get((a, b), 0))
    pts = [(a, b, s) for (a, b), s in best.items()]
    assert run(spark, pts) == greedy(pts)


def test_candidates_without_position_or_strength(spark):
    pts = [(1.0, 1.0, 3), (None, 1.0, 9), (1.05, 1.0, 2), (1.0, 1.01, None)]
    assert sorted(map(str, run(spark, pts))) == sorted(map(str, [(None, 1.0, 9), (1.0, 1.0, 3)]))


def test_work_is_linear_in_dense_areas(spark):
    """Four times the candidates in one dense square: rows of the joins grow about four times, not sixteen."""
    def joined(n):
        rnd = random.Random(5)
        pts = list({(round(50 + rnd.randrange(100) / 100, 2), round(8 + rnd.randrange(n) / 100, 2)) for _ in range(40 * n)})
        df = spark.createDataFrame([(a, b, rnd.randrange(10**6)) for a, b in pts], "lat double, lon double, s long")
        sure = sure_maxima(df)
        met = _cells_around(sure.select("lat", "lon"), 0.2, F.cos(F.radians("lat"))).join(_placed(df, 0.2), ["band", "col"])
        return len(pts), _cells_around(_placed(df, 0.2).groupBy("band", "col").agg(F.min("lat").alias("lat"), F.min("lon").alias("lon"))
                                       .select("lat", "lon"), 0.2).count() + met.count()
    (n1, a), (n2, b) = joined(40), joined(160)
    assert b / a < 1.6 * n2 / n1 and b < 30 * n2
