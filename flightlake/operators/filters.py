"""Flight-state filters and predicates.

Inputs may hold raw text columns (as ingested) or typed ones; ``typed``
converts the named columns with ``num`` once, so every filter below is a
plain built-in predicate that Catalyst can push into the Parquet scan when
the stored column is already typed.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightlake.functions import altitude_col, flag, flight_phase, num, to_kmh

# Thresholds of the reference's ground and climb-rate rules.
GROUND_MAX_GEOALT_M = 500.0
GROUND_MAX_SPEED_KMH = 50.0
GROUND_VERTRATE_BAND = 0.5          # m/s, inclusive on both sides
PHASE_VERTRATE_KMH_BAND = 90.0      # km/h, inclusive on both sides
CONTRADICTION_ALT_M = 4000.0        # on ground but higher than this (strict)


def typed(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Replace text columns by doubles (``num``); typed doubles pass through."""
    conv = {c: num(c) for c in cols if c in df.columns}
    return df.withColumns(conv) if conv else df


def _prefilter(df: DataFrame, not_null: Iterable[str] = (), equal: dict[str, str] | None = None) -> DataFrame:
    """Conjuncts on the stored columns that the full predicate implies.

    Stated before any conversion so Parquet can skip row groups
    (PushedFilters); the exact predicate is applied afterwards.
    """
    conds = [F.col(c).isNotNull() for c in not_null if c in df.columns]
    conds += [F.col(c) == F.lit(v) for c, v in (equal or {}).items() if c in df.columns]
    if not conds:
        return df
    cond = conds[0]
    for c in conds[1:]:
        cond = cond & c
    return df.filter(cond)


def airborne_pred(onground: str = "onground", velocity: str = "velocity",
                  altitude: str = "baroaltitude") -> Column:
    """onground is exactly 'False' and both numbers are present (F1).

    A filter predicate: NULL drops the row like false.
    """
    return (F.col(onground) == F.lit("False")) & F.col(velocity).isNotNull() & F.col(altitude).isNotNull()


def airborne(df: DataFrame) -> DataFrame:
    """F1 + P2: airborne rows with ``velocity_kmh`` added."""
    pre = _prefilter(df, ["velocity", "baroaltitude"], {"onground": "False"})
    t = typed(pre, ["velocity", "baroaltitude"])
    return t.filter(airborne_pred()).withColumn("velocity_kmh", to_kmh("velocity"))


def phase_points(df: DataFrame, eps: float = GROUND_VERTRATE_BAND) -> DataFrame:
    """F2 + P4 + P17: rows usable for the flight-phase view.

    Altitude is ``geoaltitude`` when the schema has it, else ``baroaltitude``;
    ground rows stay in. Output: velocity_kmh, <altitude>, vertrate_kmh, phase.
    """
    alt = altitude_col(df)
    t = typed(_prefilter(df, ["velocity", alt, "vertrate"]), ["velocity", alt, "vertrate"])
    t = t.withColumns({"velocity_kmh": to_kmh("velocity"), "vertrate_kmh": to_kmh("vertrate")})
    band = PHASE_VERTRATE_KMH_BAND
    t = t.filter(F.col("velocity").isNotNull() & F.col(alt).isNotNull() & F.col("vertrate").isNotNull()
                 & F.col("vertrate_kmh").between(-band, band))
    return t.select("velocity_kmh", alt, "vertrate_kmh", flight_phase("vertrate", eps).alias("phase"))


def ground_pred() -> Column:
    """F3 over typed lat, lon, velocity, geoaltitude, vertrate.

    Reported on-ground, or physically on ground (low, slow, level); NULLs in
    the physics branch make it false (SQL three-valued logic, then coalesce).
    """
    physics = ((F.col("geoaltitude") < F.lit(GROUND_MAX_GEOALT_M))
               & (to_kmh("velocity") < F.lit(GROUND_MAX_SPEED_KMH))
               & F.col("vertrate").between(-GROUND_VERTRATE_BAND, GROUND_VERTRATE_BAND))
    return (F.col("lat").isNotNull() & F.col("lon").isNotNull()
            & (flag("onground") | F.coalesce(physics, F.lit(False))))


def on_ground_points(df: DataFrame) -> DataFrame:
    """rows of aircraft on (or at) the ground, coordinates typed."""
    cols = ["lat", "lon", "velocity", "geoaltitude", "vertrate"]
    return typed(_prefilter(df, ["lat", "lon"]), cols).filter(ground_pred())


def reported_on_ground(df: DataFrame, strict: bool = True) -> DataFrame:
    """onground flag only (strict: exactly 'True', pushable to the scan)."""
    return df.filter(F.col("onground") == F.lit("True")) if strict else df.filter(flag("onground", False))


def anomalies_only(df: DataFrame, label: str = "anomaly_label") -> DataFrame:
    """rows labelled -1."""
    return df.filter(F.col(label) == -1)


def identified(df: DataFrame, cols: Iterable[str] = ("manufacturerName", "model")) -> DataFrame:
    """drop rows whose listed columns are all NULL ('' counts as known)."""
    cols = [c for c in cols if c in df.columns]
    return df.dropna(how="all", subset=cols) if cols else df


def contradiction_pred(onground: str = "onground", altitude: str = "baroaltitude") -> Column:
    """reported on ground (case-insensitive) and higher than 4000 m."""
    return flag(onground, strict=False) & F.coalesce(F.col(altitude) > F.lit(CONTRADICTION_ALT_M), F.lit(False))


def ground_contradictions(df: DataFrame) -> DataFrame:
    """F7 row-level: the rows that violate the ground-logic rule."""
    return typed(df, ["baroaltitude"]).filter(contradiction_pred())


def non_null(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """rows with all listed columns present."""
    return df.dropna(how="any", subset=list(cols))
