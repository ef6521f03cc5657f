"""Joins with aircraft master data.

Whether the master side is broadcast is left to the optimizer, which decides
from measured sizes at run time; a caller may ask for a hint below a size of
its own. Feed keys are de-duplicated with a partial aggregate before any
shuffle, so a hot aircraft costs one row per map task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightlake.functions import norm_key
from flightlake.operators.aggregates import first_per_key

def estimated_size(df: DataFrame) -> int | None:
    """Catalyst's size estimate of ``df`` in bytes (None when unavailable)."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:  # noqa: BLE001 - estimate is advisory
        return None


def maybe_broadcast(df: DataFrame, limit: int) -> DataFrame:
    """Broadcast hint only for a side whose estimated size is within ``limit``.

    The estimate of a Parquet side is its compressed size on disk; leave room
    for what it takes in memory.
    """
    size = estimated_size(df)
    return F.broadcast(df) if size is not None and size <= limit else df


def normalised(df: DataFrame, key: str) -> DataFrame:
    return df.withColumn(key, norm_key(key)).filter(F.col(key).isNotNull())


def feed_keys(feed: DataFrame, key: str = "icao24") -> DataFrame:
    """Distinct normalised non-null keys of a feed."""
    return normalised(feed.select(key), key).distinct()


def dedupe_dim(dim: DataFrame, key: str = "icao24", normalize: bool = True, null_safe: bool = False,
               order_col: str = "_pos") -> DataFrame:
    """One master row per (normalised) key: the first in file order where the
    table has ``order_col`` (which is dropped), else the smallest known
    attributes, column by column. Null keys go unless ``null_safe``."""
    d = dim.withColumn(key, norm_key(key)) if normalize else dim
    d = d if null_safe else d.filter(F.col(key).isNotNull())
    rest = [c for c in d.columns if c not in (key, order_col)]
    order = [order_col, *rest] if order_col in d.columns else rest
    return first_per_key(d, key, order).drop(order_col)


def enrich(df: DataFrame, dim: DataFrame, key: str = "icao24", how: str = "left",
           normalize: bool = True, dedupe: bool = True, null_safe: bool = False,
           broadcast_limit: int | None = None) -> DataFrame:
    """J1 + J3: attach master data to every row of ``df``.

    Keys are normalised on both sides (lower + strip) unless ``normalize`` is
    false; the master side is de-duplicated on the key so rows never multiply.
    With ``null_safe`` a null key finds a master row with a null key.
    """
    left = df.withColumn(key, norm_key(key)) if normalize else df
    if dedupe:
        right = dedupe_dim(dim, key, normalize, null_safe)
    else:
        right = dim.withColumn(key, norm_key(key)) if normalize else dim
        right = right if null_safe else right.filter(F.col(key).isNotNull())
    if broadcast_limit is not None:
        right = maybe_broadcast(right, broadcast_limit)
    if null_safe:
        r = right.withColumnRenamed(key, "_rk")
        return left.join(r, left[key].eqNullSafe(r["_rk"]), how).drop("_rk")
    return left.join(right, key, how)


def known_aircraft(dim: DataFrame, feed: DataFrame, key: str = "icao24") -> DataFrame:
    """Master rows (normalised key) whose key occurs in the feed."""
    return normalised(dim, key).join(feed_keys(feed, key), key, "left_semi")


def unknown_aircraft(feed: DataFrame, dim: DataFrame, key: str = "icao24") -> DataFrame:
    """Feed aircraft (normalised keys) that have no master row."""
    return feed_keys(feed, key).join(normalised(dim.select(key), key), key, "left_anti")
