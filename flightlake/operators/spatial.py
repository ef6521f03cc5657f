"""Greedy spatial non-maximum suppression as a DataFrame fix-point.

Sequential definition: walk the candidates from strongest to weakest; a
candidate that is still active suppresses every weaker candidate closer than
``threshold`` degrees (latitude difference and cos(lat)-scaled longitude
difference, cos of the stronger point's latitude).

Parallel form, identical result for any input, without a list of the edges
between neighbours (which grows with the square of a dense area):

1. Candidates lie in cells half a threshold wide. Only the strongest of a cell
   can be sure of its place: it is kept if no cell that could hold a neighbour
   of it has a stronger maximum. This compares one row a cell with the some 25
   cells around it.
2. Every undecided candidate closer than the threshold to a kept one is
   dropped. Kept candidates are a threshold apart, so few reach any one cell,
   and each candidate meets a bounded number of them.
3. Repeat with what is undecided. The strongest of all is always sure, so each
   round decides something; a candidate kept here has, in the sequential walk,
   only dropped stronger neighbours.

When few candidates are left (``local_rows``, a bound on what a task holds), one
task walks them in order. A round is one job, which writes what is left to the
shared checkpoint folder (lineage stays short, lost executors recompute nothing
older) and counts it on the way.

Cells: latitude bands of half a threshold; within a band, columns as wide as
half a threshold is at the band's largest cos(lat). Near the poles (cos -> 0) a
band is one cell. Candidates sharing a position are first collapsed to the
strongest (the sequential walk suppresses the rest at distance 0).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flightlake.functions import deg_dist_sq
from flightlake.session import stored

# Suppression radius in degrees (about 20 km).
NMS_THRESHOLD_DEG = 0.2

#: Undecided candidates that one task walks to the end.
LOCAL_ROWS = 50_000
#: Bands whose smallest cos(lat) is below this are one cell.
_POLAR = 0.05


def _band(lat: Column, thr: float) -> Column:
    return F.floor(lat / F.lit(thr / 2)).cast(T.LongType())


def _cosines(band: Column, thr: float) -> tuple[Column, Column]:
    """(smallest, largest) cos(lat) in a band."""
    a, b = F.abs(band * F.lit(thr / 2)), F.abs((band + 1) * F.lit(thr / 2))
    far, near = F.least(F.greatest(a, b), F.lit(90.0)), F.least(a, b)
    return F.cos(F.radians(far)), F.cos(F.radians(F.least(near, F.lit(90.0))))


def _column(lon: Column, band: Column, thr: float) -> Column:
    """Column of a longitude in a band."""
    smallest, largest = _cosines(band, thr)
    return F.when(smallest < F.lit(_POLAR), F.lit(0)).otherwise(
        F.floor(lon * largest / F.lit(thr / 2))).cast(T.LongType())


def _cells_around(points: DataFrame, thr: float, cos: Column | None = None) -> DataFrame:
    """``points`` (lat, lon) once for each cell (band, col) that could hold a
    point within the threshold, the scale being ``cos`` or, if it is not known,
    the smallest in the other band."""
    margin = 1e-6  # cells are taken generously: rounding must not hide a neighbour
    bands = F.sequence(_band(F.col("lat") - F.lit(thr * (1 + margin)), thr), _band(F.col("lat") + F.lit(thr * (1 + margin)), thr))
    spread = points.withColumn("band", F.explode(bands))
    smallest, _ = _cosines(F.col("band"), thr)
    reach = F.least(F.lit(thr * (1 + margin)) / (smallest if cos is None else cos), F.lit(720.0))
    columns = F.when(smallest < F.lit(_POLAR), F.array(F.lit(0).cast("long"))).otherwise(F.sequence(
        _column(F.col("lon") - reach, F.col("band"), thr), _column(F.col("lon") + reach, F.col("band"), thr)))
    return spread.withColumn("col", F.explode(columns))


def _placed(points: DataFrame, thr: float) -> DataFrame:
    band = _band(F.col("lat"), thr)
    return points.withColumns({"band": band, "col": _column(F.col("lon"), band, thr)})


def sure_maxima(points: DataFrame, threshold: float = NMS_THRESHOLD_DEG) -> DataFrame:
    """The candidates (lat, lon, s) that are the strongest of their cell and of
    every cell that could hold a neighbour of theirs."""
    thr = float(threshold)
    strength = F.struct((-F.col("s")).alias("n"), "lat", "lon")  # smaller is stronger
    top = _placed(points, thr).groupBy("band", "col").agg(F.min(strength).alias("best"))
    mine = top.select(F.col("best.lat").alias("lat"), F.col("best.lon").alias("lon"), (-F.col("best.n")).alias("s"),
                      F.col("best").alias("own"))
    # A neighbour that is stronger sets the scale by its own latitude: each band's smallest is safe.
    around = _cells_around(mine, thr).join(top, ["band", "col"])
    return (around.groupBy("lat", "lon", "s", "own").agg(F.min("best").alias("strongest"))
            .filter("strongest = own").select("lat", "lon", "s"))


def near_kept(points: DataFrame, kept: DataFrame, threshold: float = NMS_THRESHOLD_DEG) -> DataFrame:
    """The candidates (lat, lon) closer than ``threshold`` to a kept one, itself included."""
    thr = float(threshold)
    cos = F.cos(F.radians("lat"))
    reach = _cells_around(kept.select("lat", "lon"), thr, F.greatest(cos, F.lit(1e-9)))
    reach = reach.select("band", "col", F.col("lat").alias("k_lat"), F.col("lon").alias("k_lon"))
    close = deg_dist_sq("k_lat", "k_lon", "lat", "lon") < F.lit(thr * thr)
    return _placed(points, thr).join(reach, ["band", "col"]).filter(close).select("lat", "lon").distinct()


def _walk(points: DataFrame, thr: float) -> DataFrame:
    """The sequential definition in one task, for a bounded number of rows; kept
    candidates are looked up by the square they reach."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted(((-s, la, lo, c) for b in batches
                       for la, lo, s, c in zip(*(b.column(n).to_pylist() for n in ("lat", "lon", "s", "cos")))))
        reached: dict[tuple[int, int], list[tuple[float, float, float]]] = {}
        kept = []
        for s, la, lo, c in rows:
            here = (math.floor(la / thr), math.floor(lo / thr))
            if any((la - a) ** 2 + ((lo - b) * k) ** 2 < thr * thr for a, b, k in reached.get(here, ())):
                continue
            kept.append((la, lo, -s))
            side = min(thr / max(c, 1e-9), 360.0) * (1 + 1e-6)
            for i in range(here[0] - 1, here[0] + 2):
                for j in range(math.floor((lo - side) / thr), math.floor((lo + side) / thr) + 1):
                    reached.setdefault((i, j), []).append((la, lo, c))
        yield pa.RecordBatch.from_arrays([pa.array([k[i] for k in kept], t) for i, t in enumerate(kinds)],
                                         names=["lat", "lon", "s"])

    kind = points.schema["s"].dataType
    kinds = [pa.float64(), pa.float64(), pa.int64() if isinstance(kind, T.LongType) else pa.float64()]
    typed = points.select("lat", "lon", F.col("s").cast(kind if isinstance(kind, T.LongType) else T.DoubleType()).alias("s"),
                          F.cos(F.radians("lat")).alias("cos"))
    out = "lat double, lon double, s " + ("long" if isinstance(kind, T.LongType) else "double")
    return typed.repartition(1).mapInArrow(walk, out)


def spatial_nms(cands: DataFrame, lat: str = "lat_cluster", lon: str = "lon_cluster", strength: str = "flight_count",
                threshold: float = NMS_THRESHOLD_DEG, local_rows: int = LOCAL_ROWS) -> DataFrame:
    """Candidates that survive greedy suppression, strongest first (X1). A
    candidate without a position neither suppresses nor is suppressed; one
    without a strength is left out."""
    # exact duplicates of a position: the strongest suppresses the rest (distance 0)
    base = (cands.groupBy(F.col(lat).cast("double").alias("lat"), F.col(lon).cast("double").alias("lon"))
            .agg(F.max(F.col(strength)).alias("s")))
    counted = Observation()
    placed = F.col("lat").isNotNull() & F.col("lon").isNotNull() & F.col("s").isNotNull()
    base = stored(base.observe(counted, F.count_if(placed).alias("left")), "candidates")
    kept = [base.filter("s IS NOT NULL AND (lat IS NULL OR lon IS NULL)")]
    undecided, left = base.filter(placed), counted.get["left"]
    while left > local_rows:
        sure = stored(sure_maxima(undecided, threshold), "maxima")
        counted = Observation()
        rest = undecided.join(near_kept(undecided, sure, threshold), ["lat", "lon"], "left_anti")
        undecided = stored(rest.observe(counted, F.count(F.lit(1)).alias("left")), "undecided")
        kept.append(sure)
        left = counted.get["left"]
    kept.append(_walk(undecided, float(threshold)))
    every = kept[0]
    for more in kept[1:]:
        every = every.unionByName(more)
    return (every.select(F.col("lat").alias(lat), F.col("lon").alias(lon), F.col("s").alias(strength))
            .orderBy(F.desc(strength), lat, lon))


def top_hubs(cands: DataFrame, k: int = 50, **kw) -> DataFrame:
    """L3: the ``k`` strongest surviving candidates."""
    strength = kw.get("strength", "flight_count")
    lat, lon = kw.get("lat", "lat_cluster"), kw.get("lon", "lon_cluster")
    return spatial_nms(cands, **kw).orderBy(F.desc(strength), lat, lon).limit(k)
