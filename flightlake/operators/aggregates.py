"""Aggregations and distinct.

Per-key "first row" operators rank rows with a limit of 1 that is applied below
the exchange too: one scan, and a hot key sends one row per map task. Scalars
that a row-level expression needs (min/max of a column) are scalar subqueries,
so they run with the query, not while it is built.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flightlake.functions import grid_cell
from flightlake.operators.filters import on_ground_points, reported_on_ground, typed


def attach_scalars(df: DataFrame, scalars: DataFrame) -> DataFrame:
    """Append the columns of a one-row aggregate to every row of ``df``.

    Each is a scalar subquery: evaluated once when the query runs, no join.
    """
    return df.withColumns({c: scalars.select(c).scalar() for c in scalars.columns})


def _order_cols(order_by: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order_by]


def first_per_key(df: DataFrame, key: str | Sequence[str], order_by: Sequence[str | Column]) -> DataFrame:
    """One row per key: the smallest by ``order_by``, missing values last (A2, A3).

    A rank with a limit of 1, which the optimizer also puts below the exchange:
    every map task sorts its rows by (key, order) and sends one row a key, so
    the input is scanned once and no raw row is shuffled, however many a key
    has. The sort is the cost: n log n comparisons inside each task, spilled
    where a task's rows exceed its memory. Deterministic for any partitioning
    as long as ``order_by`` is a total order within a key.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if len(keys) == len(df.columns):
        return df.select(*keys).distinct()
    window = Window.partitionBy(*keys).orderBy(*[c.asc_nulls_last() for c in _order_cols(order_by)])
    return df.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") == 1).drop("_rank")


def one_vote(df: DataFrame, key: str = "icao24",
             order_by: Sequence[str | Column] | None = None) -> DataFrame:
    """One plane, one vote: the earliest state vector per aircraft (A2).

    Default order: epoch time as a number (times that do not parse come last),
    then every other column, so the pick does not depend on the input layout.
    """
    if order_by is None:
        order_by = [F.col("time").try_cast(T.LongType())] + [F.col(c) for c in df.columns if c != key]
    return first_per_key(df, key, order_by)


def grid_count(df: DataFrame, lat: str = "lat", lon: str = "lon", digits: int = 2,
               count_name: str = "flight_count") -> DataFrame:
    """Count per rounded (lat, lon) cell, strongest first (A4, L1).

    Partial + final hash aggregate; the cell count is bounded by geography.
    """
    return (df.groupBy(grid_cell(lat, digits).alias("lat_cluster"), grid_cell(lon, digits).alias("lon_cluster"))
            .agg(F.count(F.lit(1)).alias(count_name))
            .orderBy(F.desc(count_name), "lat_cluster", "lon_cluster"))


def airport_candidates(states: DataFrame, digits: int = 2) -> DataFrame:
    """F3 -> A2 -> P5 -> A4: grid cells where distinct aircraft sit on the ground."""
    ground = on_ground_points(states)
    return grid_count(one_vote(ground.select("icao24", "time", "lat", "lon")), digits=digits)


def ground_sites_count(states: DataFrame, strict: bool = True) -> DataFrame:
    """Reported-on-ground rows -> one per aircraft -> number of exact (lat, lon) groups."""
    g = reported_on_ground(states.select("icao24", "time", "lat", "lon", "onground"), strict)
    voted = one_vote(g.select("icao24", "time", "lat", "lon"))
    return voted.select("lat", "lon").distinct().agg(F.count(F.lit(1)).alias("n_sites"))


def histogram(df: DataFrame, col: str, bins: int | None = 50) -> DataFrame:
    """Equal-width histogram over [min, max], last bin closed (A11); without
    ``bins`` their number follows the data (``auto_bins``).

    Rows with a NULL value are left out. Output: bin, bin_lo, bin_hi, n.
    """
    bins = auto_bins(df, col) if bins is None else bins
    x = F.col(col)
    vals = df.select(x.cast(T.DoubleType()).alias("_x")).filter(F.col("_x").isNotNull())
    stats = vals.agg(F.min("_x").alias("_lo"), F.max("_x").alias("_hi"))
    w = (F.col("_hi") - F.col("_lo")) / F.lit(float(bins))
    raw = F.floor((F.col("_x") - F.col("_lo")) / w)
    b = F.when(w > 0, F.least(raw, F.lit(bins - 1))).otherwise(F.lit(0)).cast(T.IntegerType())
    binned = attach_scalars(vals, stats).select(b.alias("bin"), F.col("_lo"), w.alias("_w"))
    return (binned.groupBy("bin", "_lo", "_w").agg(F.count(F.lit(1)).alias("n"))
            .select("bin", (F.col("_lo") + F.col("bin") * F.col("_w")).alias("bin_lo"),
                    (F.col("_lo") + (F.col("bin") + 1) * F.col("_w")).alias("bin_hi"), "n")
            .orderBy("bin"))


def exact_quantiles(df: DataFrame, col: str, shares: Sequence[float], bins: int = 4096, small: int = 65_536) -> list[float]:
    """Exact quantiles of a numeric column (linear between neighbouring ranks,
    NULL and NaN left out; NaN for no rows), all of them narrowed together.

    Every round counts the rows of the open intervals in ``bins`` equal steps,
    in one pass for all ranks, and keeps for each rank the step it falls in;
    when the open steps hold few rows, those are sorted. An interval that can
    be split no further holds one value. What reaches the driver is a bounded
    table of counts and at most ``small`` values; ``df`` is read a few times.
    """
    x = df.select(F.col(col).cast(T.DoubleType()).alias("x")).filter("x IS NOT NULL AND NOT isnan(x)")
    n, lo, hi = x.agg(F.count("x"), F.min("x"), F.max("x")).first()
    if not n:
        return [float("nan")] * len(shares)
    at = [s * (n - 1) for s in shares]
    value: dict[int, float] = {0: lo, n - 1: hi}
    # rank -> (rows below the interval, its ends); intervals of different ranks are equal or disjoint
    open_ranks = {r: (0, lo, hi) for a in at for r in (math.floor(a), math.ceil(a)) if r not in value}
    rows = n
    while open_ranks:
        spans = sorted(set(open_ranks.values()))
        for r, (_, a, b) in list(open_ranks.items()):
            if a == b or math.nextafter(a, b) == b and rows > small:
                value[r] = _rank_between_neighbours(x, a, b, r - open_ranks[r][0]) if a != b else a
                del open_ranks[r]
        if not open_ranks:
            break
        inside = reduce(Column.__or__, [F.col("x").between(a, b) for _, a, b in spans])
        if rows <= small:
            values = sorted(v for v, in x.filter(inside).collect())
            for r, (below, a, _) in open_ranks.items():
                value[r] = values[bisect_left(values, a) + r - below]
            break
        step, first = F.lit(None).cast("int"), F.lit(None).cast("int")
        for i, (_, a, b) in enumerate(spans):
            here = F.col("x").between(a, b)
            width = b / bins - a / bins
            step = F.when(here, F.least(F.floor((F.col("x") - a) / width), F.lit(bins - 1)).cast("int")
                          if width > 0 else F.when(F.col("x") == a, 0).otherwise(1)).otherwise(step)
            first = F.when(here, F.lit(i)).otherwise(first)
        counted = (x.filter(inside).groupBy(first.alias("i"), step.alias("b"))
                   .agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi")).collect())
        held = 0
        narrowed = {}
        for i, (below, a, b) in enumerate(spans):
            upto = below
            for c in sorted((c for c in counted if c.i == i), key=lambda c: c.b):
                ranks = [r for r, span in open_ranks.items() if span == spans[i] and upto <= r < upto + c.n]
                narrowed |= {r: (upto, c.lo, c.hi) for r in ranks}
                held += c.n if ranks else 0
                upto += c.n
        open_ranks, rows = narrowed, held
    return [value[math.floor(a)] + (value[math.ceil(a)] - value[math.floor(a)]) * (a - math.floor(a)) for a in at]


def _rank_between_neighbours(x: DataFrame, a: float, b: float, rank: int) -> float:
    """The value of a rank where only two neighbouring numbers are left."""
    return a if rank < x.filter(F.col("x") == a).count() else b


def auto_bins(df: DataFrame, col: str) -> int:
    """Number of equal-width bins for a column (A11): the narrower of the
    Freedman-Diaconis width, 2 IQR / n^(1/3), and the Sturges width, range /
    (log2(n) + 1); Sturges alone if half the rows are equal. Both quartiles come
    from one narrowing."""
    x = df.select(F.col(col).cast(T.DoubleType()).alias("x")).filter("x IS NOT NULL AND NOT isnan(x)")
    n, lo, hi = x.agg(F.count("x"), F.min("x"), F.max("x")).first()
    if not n or lo == hi:
        return 1
    q1, q3 = exact_quantiles(x, "x", [0.25, 0.75])
    sturges = (hi - lo) / (math.log2(n) + 1)
    fd = 2 * (q3 - q1) / n ** (1 / 3)
    return max(1, math.ceil((hi - lo) / (min(fd, sturges) if fd > 0 else sturges)))


def phase_profile(points: DataFrame, alt: str | None = None, ndigits: int = 6) -> DataFrame:
    """Per phase count, mean/min/max speed and altitude."""
    alt = alt or next(c for c in points.columns if c.endswith("altitude"))
    return (points.groupBy("phase").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.avg("velocity_kmh"), ndigits).alias("avg_speed_kmh"),
        F.min("velocity_kmh").alias("min_speed_kmh"),
        F.max("velocity_kmh").alias("max_speed_kmh"),
        F.round(F.avg(alt), ndigits).alias("avg_altitude"),
        F.min(alt).alias("min_altitude"),
        F.max(alt).alias("max_altitude"))
        .orderBy("phase"))


def position_heatmap(states: DataFrame, digits: int = 1, ndigits: int = 6) -> DataFrame:
    """Positions per rounded cell with mean geometric altitude."""
    t = typed(states.select("lat", "lon", "geoaltitude"), ["lat", "lon", "geoaltitude"])
    t = t.dropna(subset=["lat", "lon"])
    return (t.groupBy(grid_cell("lat", digits).alias("lat_cell"), grid_cell("lon", digits).alias("lon_cell"))
            .agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("geoaltitude"), ndigits).alias("avg_geoaltitude")))
