"""Data-quality reports: rule validation, missing values, coverage.

Each report is one aggregation pass over the data (one partial aggregate per
task, one tiny final row), unpivoted into report rows afterwards.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flightlake.functions import blank_to_null, coverage_grade, safe_ratio
from flightlake.operators.aggregates import attach_scalars
from flightlake.operators.filters import contradiction_pred, typed
from flightlake.operators.joins import feed_keys, known_aircraft

# Numeric state columns the validation converts before checking.
VALIDATION_NUMERIC = ["lat", "lon", "velocity", "geoaltitude", "baroaltitude"]
# WARN above this share of passing rows (percent).
WARN_ABOVE_PCT = 90.0
# Master-data attributes whose coverage is reported.
COVERAGE_ATTRIBUTES = ["manufacturerName", "model", "typecode", "operator"]


@dataclass(frozen=True)
class Rule:
    """A row-level check: ``condition`` true means the row passes."""
    name: str
    condition: Callable[[], Column]
    description: str
    columns: Sequence[str] = field(default_factory=tuple)


def _lat_ok() -> Column:
    return F.col("lat").isNull() | F.col("lat").between(-90.0, 90.0)


def _lon_ok() -> Column:
    return F.col("lon").isNull() | F.col("lon").between(-180.0, 180.0)


STATE_RULES: list[Rule] = [
    Rule("PK Exists", lambda: F.col("icao24").isNotNull() & (F.col("icao24") != F.lit("")),
         "every row needs an icao24 id", ("icao24",)),
    Rule("Lat Range", _lat_ok, "lat must lie between -90 and 90", ("lat",)),
    Rule("Lon Range", _lon_ok, "lon must lie between -180 and 180", ("lon",)),
    Rule("Ground Logic", lambda: ~contradiction_pred(), "contradiction: on ground but above 4000 m",
         ("onground", "baroaltitude")),
]


def validate(df: DataFrame, rules: Sequence[Rule] = STATE_RULES, numeric: Iterable[str] = VALIDATION_NUMERIC,
             ndigits: int = 2) -> DataFrame:
    """A5: per rule failed rows, % passed, PASS / WARN / FAIL, description.

    A rule is skipped when one of its columns is missing. PASS: no failure;
    WARN: more than 90 % pass; else FAIL. A NULL condition counts as a failure.
    """
    t = typed(df, numeric)
    active = [r for r in rules if all(c in t.columns for c in r.columns)]
    if not active:
        raise ValueError("no rule applies to this schema")
    aggs = [F.count(F.lit(1)).alias("total")]
    aggs += [F.count_if(~F.coalesce(r.condition(), F.lit(False))).alias(f"f{i}") for i, r in enumerate(active)]
    counts = t.agg(*aggs)
    args = [F.lit(len(active))]
    for i, r in enumerate(active):
        args += [F.lit(i), F.lit(r.name), F.lit(r.description), F.col(f"f{i}")]
    rows = counts.select("total", F.stack(*args).alias("rule_no", "rule", "description", "failed_rows"))
    pct_ok = F.lit(100.0) - safe_ratio("failed_rows", "total") * F.lit(100.0)
    pct_ok = F.when(F.col("total") > 0, pct_ok).otherwise(F.lit(0.0))
    status = (F.when(F.col("failed_rows") == 0, "PASS")
              .when(pct_ok > F.lit(WARN_ABOVE_PCT), "WARN").otherwise("FAIL"))
    return (rows.select("rule_no", "rule", status.alias("status"), F.col("failed_rows").cast(T.LongType()),
                        F.round(pct_ok, ndigits).alias("pct_passed"), "description")
            .orderBy("rule_no"))


def missing_report(df: DataFrame, blank_is_null: bool = False, only_missing: bool = False,
                   numeric: Iterable[str] = (), ndigits: int = 6) -> DataFrame:
    """Per column total rows, missing count, missing %, by % descending.

    Only NULL counts as missing unless ``blank_is_null``; columns in
    ``numeric`` are converted with ``num`` first (unparsable -> missing).
    ``only_missing`` keeps columns with a share above 0 (F8).
    """
    t = typed(df, numeric)
    cols = t.columns

    def missing(c: str) -> Column:
        v = blank_to_null(F.col(c)) if blank_is_null and isinstance(t.schema[c].dataType, T.StringType) else F.col(c)
        return F.count_if(v.isNull())

    counts = t.agg(F.count(F.lit(1)).alias("total_rows"), *[missing(c).alias(f"m{i}") for i, c in enumerate(cols)])
    args = [F.lit(len(cols))]
    for i, c in enumerate(cols):
        args += [F.lit(c), F.col(f"m{i}")]
    rows = counts.select("total_rows", F.stack(*args).alias("column_name", "missing"))
    rows = rows.withColumn("missing_pct", F.round(safe_ratio("missing", "total_rows") * F.lit(100.0), ndigits))
    if only_missing:
        rows = rows.filter(F.col("missing_pct") > 0)
    return rows.select("column_name", "total_rows", "missing", "missing_pct").orderBy(F.desc("missing_pct"), "column_name")


def coverage(feed: DataFrame, dim: DataFrame, key: str = "icao24",
             attributes: Sequence[str] = COVERAGE_ATTRIBUTES, ndigits: int = 6) -> DataFrame:
    """A6 + P16: how much master data the feed's aircraft have.

    feed_aircraft: distinct normalised non-null keys of the feed;
    matched_rows: master-data rows whose normalised key is in the feed;
    per attribute: non-blank values among matched rows / feed_aircraft * 100
    (0 when the column is missing). One row per attribute, best first.
    """
    keys = feed_keys(feed, key)
    matched = known_aircraft(dim, feed, key)
    have = {c.lower(): c for c in dim.columns}
    per_attr = []
    for a in attributes:
        real = have.get(a.lower())
        per_attr.append((F.count(blank_to_null(F.col(real))) if real else F.lit(0).cast(T.LongType())).alias(a))
    m = matched.agg(F.count(F.lit(1)).alias("matched_rows"), *per_attr)
    total = keys.agg(F.count(F.lit(1)).alias("feed_aircraft"))
    both = attach_scalars(m, total)
    args = [F.lit(len(attributes))]
    for a in attributes:
        args += [F.lit(a), F.col(f"`{a}`")]
    rows = both.select("feed_aircraft", "matched_rows", F.stack(*args).alias("attribute", "valid_count"))
    pct = F.round(safe_ratio("valid_count", "feed_aircraft") * F.lit(100.0), ndigits)
    rate = F.round(safe_ratio("matched_rows", "feed_aircraft") * F.lit(100.0), ndigits)
    return (rows.select("attribute", F.col("valid_count").cast(T.LongType()), pct.alias("percentage"),
                        coverage_grade(pct).alias("grade"), "feed_aircraft", "matched_rows",
                        rate.alias("match_rate"))
            .orderBy(F.desc("percentage"), "attribute"))
