"""User-level jobs composed from the operators.

Each job returns DataFrames (or writes a run directory). What reaches the
driver is bounded: the isolation-forest model (a size fixed by its parameters),
single values and the counts of a quantile's bins.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flightlake.functions import num, select_existing
from flightlake.operators import aggregates as A
from flightlake.operators import filters as Fl
from flightlake.operators import iforest
from flightlake.operators import ingest as N
from flightlake.operators import joins as J
from flightlake.operators import quality as Q
from flightlake.operators import sampling as L
from flightlake.operators import spatial as X
from flightlake.operators import windows as W
from flightlake.schemas import STATE_COLUMNS
from flightlake.session import stored
from flightlake.sources import files as S

# Input columns of the risk table in output order, each with our label for it.
RISK_COLUMNS = {
    "anomaly_score": "risk_score",
    "icao24": "icao_id",
    "manufacturerName": "manufacturer",
    "model": "model",
    "typecode": "type",
    "velocity_kmh": "speed_kmh",
    "baroaltitude": "altitude_m",
    "operator": "airline",
}
POINT_COLUMNS = ["velocity_kmh", "baroaltitude", "lat", "lon", "icao24"]
FOREST_FEATURES = ["velocity_kmh", "baroaltitude"]


def ingest_states(spark: SparkSession, archives: DataFrame | Sequence[str], out_root: str, run_id: int,
                  mode: str = "lenient") -> str | None:
    """JB1: archives -> accepted rows -> typed clean -> run directory, checked by
    re-reading it (S16); returns its path, or None when nothing was selected
    (N8: the selection is looked at, not the data) or no row survived.

    ``archives`` is a selection (S1/S2) with a ``path`` column or a list of
    paths; members are listed and read in tasks.
    """
    from flightlake.sources.tarstates import read_archive_members
    if not isinstance(archives, DataFrame):
        archives = spark.createDataFrame([(p,) for p in archives], "path string")
    if archives.isEmpty():
        return None
    states = N.clean_states(N.accept_members(read_archive_members(archives), mode))
    path = S.write_run(states, out_root, run_id)
    if not S.run_manifest(spark, path).rows:
        S.remove_tree(spark, path)
        return None
    S.verify_run(spark, path)
    return path


@dataclass(frozen=True)
class Ingested:
    """A run and its quarantine (paths; None where nothing was written) and the rows that went to each."""
    run: str | None
    rejects: str | None
    accepted: int
    rejected: int


def ingest_with_rejects(spark: SparkSession, archives: DataFrame, out_root: str, rejects_root: str, run_id: int,
                        mode: str = "lenient") -> Ingested:
    """JB1 with a quarantine: the archives are scanned once; accepted rows become
    the run, all others a run of (archive, member, position, text, reason) under
    ``rejects_root``, faults of archives and members among them (reason 'fault',
    the text says which). Both are checked like any run; their rows add up to the
    rows that were read, which were counted on the way."""
    from flightlake.sources.tarstates import read_archive_members
    seen = Observation()
    every = N.sort_out_members(read_archive_members(archives), mode).observe(seen, F.count(F.lit(1)).alias("rows"))
    sorted_out = stored(every, "sorted-out")
    kept = sorted_out.filter("reason IS NULL").select(*STATE_COLUMNS)
    left = sorted_out.filter("reason IS NOT NULL").select("archive", "member", "position", "text", "reason")
    paths, counts = [], []
    for df, root in ((kept, out_root), (left, rejects_root)):
        path = S.write_run(df, root, run_id)
        counts.append(S.run_manifest(spark, path).rows)
        if counts[-1]:
            S.verify_run(spark, path)
        else:
            S.remove_tree(spark, path)
        paths.append(path if counts[-1] else None)
    if sum(counts) != seen.get["rows"]:
        raise RuntimeError(f"{sum(counts)} rows of {seen.get['rows']} came out of the ingest")
    return Ingested(*paths, *counts)


def ingest_aircraft(spark: SparkSession, csv_path: str, out_path: str) -> DataFrame:
    """JB2: master-data CSV -> projection + first row per icao24 -> write-once
    Parquet; returns what is stored (an older file if there was one)."""
    raw = S.read_aircraft_csv(spark, csv_path)
    clean = N.clean_aircraft(raw, order_col="_pos")
    S.write_once(clean, out_path)
    return S.read_run(spark, out_path)


def speed_altitude_points(states: DataFrame, fraction: float | None = None, row_cap: int | None = None,
                          seed: int = 42) -> DataFrame:
    """JB3: all airborne points (km/h). A caller that draws them may ask for a
    hash sample of a fraction, and for at most ``row_cap`` rows (those with the
    smallest seeded hashes)."""
    pts = select_existing(Fl.airborne(states), POINT_COLUMNS)
    if fraction is not None:
        pts = L.sample_hash(pts, fraction, seed)
    return L.cap(pts, row_cap, seed) if row_cap else pts


def _forest_input(points: DataFrame) -> DataFrame:
    return points.withColumns({c: F.coalesce(F.col(c).cast(T.DoubleType()), F.lit(0.0)) for c in FOREST_FEATURES})


def detect_anomalies(points: DataFrame, trees: int = 100, sample: int = 256,
                     contamination: float | None = 0.01, seed: int = 42, spread: int | None = None) -> DataFrame:
    """JB4: forest over (velocity_kmh, baroaltitude); per aircraft its most
    extreme anomalous row (label -1), lat/lon numeric.

    The points are written once, so that fitting and scoring read numbers and
    do not build the points again, and the scored rows once; the offset is their
    exact contamination quantile, and only rows below it (about that share) go on
    to the choice of each aircraft's lowest score.
    """
    feats = stored(_forest_input(points), "points")
    model = iforest.fit(feats, FOREST_FEATURES, trees, sample, None, seed)
    scored = stored(iforest.score_samples(feats, model, "anomaly_score", spread), "scores")
    offset = -0.5 if contamination is None else iforest.exact_quantile(scored, "anomaly_score", contamination)
    score = F.col("anomaly_score") - F.lit(offset)
    below = scored.withColumn("anomaly_score", score).filter(F.col("anomaly_score") < 0)
    worst = W.extreme_per_key(below, "icao24", "anomaly_score", [c for c in feats.columns if c != "icao24"])
    return worst.select(*feats.columns, "anomaly_score", F.lit(-1).alias("anomaly_label")).withColumns(
        {"lat": num("lat"), "lon": num("lon")})


def batch_inference(points: DataFrame, model: iforest.ForestModel, factor: float, seed: int = 42,
                    spread: int | None = None) -> DataFrame:
    """Score ``factor`` times the points (U1/U2 upscaling) with a fitted forest."""
    return iforest.score(L.upscale(_forest_input(points), factor, seed), model, spread=spread)


def risk_table(worst: DataFrame, aircraft: DataFrame, k: int | None = 50) -> DataFrame:
    """J1 + F6 + P10 + L2: identified aircraft, report columns, lowest scores first."""
    ident = Fl.identified(J.enrich(worst, aircraft))
    have = [c for c in RISK_COLUMNS if c in ident.columns]
    out = ident.select(*have)
    rounding = {"anomaly_score": 4, "velocity_kmh": 1}
    out = out.withColumns({c: F.bround(c, d) for c, d in rounding.items() if c in have})
    if "baroaltitude" in have:
        out = out.withColumn("baroaltitude", F.bround("baroaltitude", 0).cast(T.IntegerType()))
    out = out.withColumnsRenamed({c: RISK_COLUMNS[c] for c in have})
    out = out.orderBy("risk_score", "icao_id")
    return out.limit(k) if k else out


def risk_report(states: DataFrame, aircraft: DataFrame, k: int = 50, **forest) -> DataFrame:
    """JB6: forest anomalies -> master data -> top-k risk table."""
    return risk_table(detect_anomalies(speed_altitude_points(states), **forest), aircraft, k)


def metadata_coverage(states: DataFrame, aircraft: DataFrame) -> DataFrame:
    """JB5."""
    return Q.coverage(states, aircraft)


def flight_phases(states: DataFrame, fraction: float | None = None) -> tuple[DataFrame, DataFrame]:
    """JB7: phase points (optionally sampled) and the per-phase profile."""
    pts = Fl.phase_points(states)
    if fraction is not None:
        pts = L.sample_hash(pts, fraction)
    return pts, A.phase_profile(pts)


def detect_airports(states: DataFrame, k: int = 50) -> DataFrame:
    """JB8: ground cells by distinct aircraft, suppressed within 0.2 degrees, top k."""
    return X.top_hubs(A.airport_candidates(states), k)


def validation_report(states: DataFrame) -> tuple[DataFrame, DataFrame]:
    """JB9: rule table and missing-value table."""
    return Q.validate(states), Q.missing_report(states, numeric=Q.VALIDATION_NUMERIC, only_missing=True)


def profile_run(states: DataFrame) -> dict[str, DataFrame]:
    """JB10: counts, missing values, histograms, position map."""
    return {
        "rows": states.agg(F.count(F.lit(1)).alias("rows")),
        "missing": Q.missing_report(states),
        "velocity_hist": A.histogram(Fl.typed(states, ["velocity"]), "velocity"),
        "altitude_hist": A.histogram(Fl.typed(states, ["geoaltitude"]), "geoaltitude"),
        "positions": A.position_heatmap(states),
    }


def telemetry_report(tele: DataFrame, log: DataFrame, bench: DataFrame) -> dict[str, DataFrame]:
    """JB11: stage summary and intervals, run KPIs, benchmark summary."""
    return {
        "stages": W.stage_summary(tele),
        "intervals": W.stage_intervals(tele),
        "kpis": W.run_kpis(log),
        "bench": W.bench_summary(bench),
    }


def scaling_workloads(states: DataFrame, copies: int = 10) -> dict[str, DataFrame]:
    """JB12: upscaled distinct-site count, and an upscaled local sort to a no-op sink."""
    up = L.upscale(states, copies)
    return {
        "sites": A.ground_sites_count(up),
        "sorted": L.sort_local(Fl.typed(up, ["velocity"]), ["velocity"]),
    }
