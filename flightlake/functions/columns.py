"""Scalar column functions.

All helpers return ``Column`` expressions built from Spark built-ins, so they
compile into whole-stage codegen and push down where Parquet allows.
Every helper accepts a column name or a ``Column``.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnOrName = Column | str

# Alternative field names of state-vector records, tried in this
# order after the column's own name (the record schema varies between dumps).
STATE_ALIASES: dict[str, list[str]] = {
    "lat": ["latitude", "lat"],
    "lon": ["longitude", "lon"],
    "velocity": ["velocity", "speed"],
    "heading": ["heading", "track"],
    "vertrate": ["vertical_rate", "vertrate"],
    "geoaltitude": ["geo_altitude", "altitude", "geoaltitude"],
}

# Factor m/s -> km/h.
MS_TO_KMH = 3.6


def col_(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def num(c: ColumnOrName) -> Column:
    """Text -> double; blank, garbage and NaN become NULL.

    ``try_cast`` because ANSI mode makes ``cast`` raise on bad text; NaN is
    removed because Spark orders NaN above every number (NaN > 4000 is true).
    """
    return F.nanvl(col_(c).try_cast(T.DoubleType()), F.lit(None).cast(T.DoubleType()))


def to_kmh(c: ColumnOrName) -> Column:
    """m/s -> km/h."""
    return col_(c) * F.lit(MS_TO_KMH)


def flag(c: ColumnOrName, strict: bool = True) -> Column:
    """Boolean text test; NULL or any other text is false.

    strict: exact ``'True'``; otherwise case-insensitive ``'true'``.
    """
    c = col_(c)
    test = (c == F.lit("True")) if strict else (F.lower(c) == F.lit("true"))
    return F.coalesce(test, F.lit(False))


def norm_key(c: ColumnOrName) -> Column:
    """Lower-case and strip surrounding whitespace of any kind.

    Spark's ``trim`` removes only spaces, hence the regular expression.
    """
    return F.lower(F.regexp_replace(col_(c), r"^\s+|\s+$", ""))


def blank_to_null(c: ColumnOrName) -> Column:
    """Empty or whitespace-only text -> NULL."""
    c = col_(c)
    return F.when(c.rlike(r"^\s*$"), F.lit(None).cast(T.StringType())).otherwise(c)


def fill_zero(c: ColumnOrName) -> Column:
    """NULL -> 0.0 for model features."""
    return F.coalesce(col_(c).cast(T.DoubleType()), F.lit(0.0))


def safe_ratio(a: ColumnOrName, b: ColumnOrName, default: float = 0.0) -> Column:
    """a / b, or ``default`` when b is not positive or NULL."""
    a, b = col_(a), col_(b)
    return F.when(b > 0, a.cast(T.DoubleType()) / b.cast(T.DoubleType())).otherwise(F.lit(float(default)))


def grid_cell(c: ColumnOrName, digits: int = 2) -> Column:
    """Round a coordinate to ``digits`` decimals (P5; 2 digits ~ 1.1 km)."""
    return F.round(col_(c), digits)


def deg_dist_sq(lat_i: ColumnOrName, lon_i: ColumnOrName,
                lat_j: ColumnOrName, lon_j: ColumnOrName) -> Column:
    """Planar squared distance in degrees, longitude scaled by cos(lat_i).

    lat_i is the latitude of the reference (stronger) point; no wrap at the
    antimeridian.
    """
    dlat = col_(lat_j) - col_(lat_i)
    dlon = (col_(lon_j) - col_(lon_i)) * F.cos(F.radians(col_(lat_i)))
    return dlat * dlat + dlon * dlon


def coverage_grade(pct: ColumnOrName) -> Column:
    """> 80 good, > 50 medium, else poor."""
    p = col_(pct)
    return F.when(p > 80, "good").when(p > 50, "medium").otherwise("poor")


def flight_phase(rate: ColumnOrName, eps: float = 0.5) -> Column:
    """climb / descent / cruise from a vertical rate.

    The threshold is ours: the ground rule's +-0.5 m/s band counts as level.
    """
    r = col_(rate)
    return (F.when(r.isNull(), F.lit(None).cast(T.StringType()))
            .when(r > eps, "climb").when(r < -eps, "descent").otherwise("cruise"))


def seconds_between(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Seconds from ``start`` to ``end`` as double."""
    return F.timestamp_diff("MICROSECOND", col_(start), col_(end)).cast(T.DoubleType()) / F.lit(1_000_000.0)


# ---------------------------------------------------------------- schema helpers

def select_existing(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Project the wanted columns that exist, in the wanted order."""
    have = {c.lower(): c for c in df.columns}
    return df.select(*[have[c.lower()] for c in cols if c.lower() in have])


def resolve_col(df: DataFrame, name: str) -> str | None:
    """Case-insensitive column lookup."""
    return next((c for c in df.columns if c.lower() == name.lower()), None)


def altitude_col(df: DataFrame) -> str:
    """``geoaltitude`` if the schema has it, else ``baroaltitude``."""
    return resolve_col(df, "geoaltitude") or "baroaltitude"


def _as_text(df: DataFrame, name: str) -> Column:
    dtype = df.schema[name].dataType
    c = F.col(name)
    if isinstance(dtype, T.BooleanType):
        # Python's str(True) is 'True'; Spark's cast gives 'true'.
        return F.initcap(c.cast(T.StringType()))
    return c.cast(T.StringType())


def coalesce_alias(df: DataFrame, columns: Sequence[str],
                   aliases: Mapping[str, Sequence[str]] = STATE_ALIASES,
                   keep: Sequence[str] = ()) -> DataFrame:
    """One text column per target: own name, else first non-null alias, else '' (N5).

    ``keep`` lists input columns passed through unchanged in front.
    """
    present = set(df.columns)
    out = [F.col(c) for c in keep]
    for target in columns:
        names = [target] + [a for a in aliases.get(target, []) if a != target]
        cands = [_as_text(df, n) for n in names if n in present]
        value = F.coalesce(*cands, F.lit("")) if cands else F.lit("")
        out.append(value.alias(target))
    return df.select(*out)
