"""Registered queries: one Spark plan per operator group, with its DuckDB oracle.

Each query reads whole driver tables through the views in ``views`` and
returns a DataFrame; ``ORACLE`` holds the equivalent SQL over the same
tables (views inlined as CTEs). Column names are identical on both sides;
floating aggregates are rounded to 6 decimals on both sides so that the
summation order of the engines does not matter.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flightlake.functions import select_existing
from flightlake.operators import aggregates as A
from flightlake.operators import filters as Fl
from flightlake.operators import joins as J
from flightlake.operators import quality as Q
from flightlake.operators import spatial as X
from flightlake.operators import windows as W
from flightlake.plans import views as V
from flightlake.plans.views import duckdb_ctes
from flightlake.session import stored

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


# --------------------------------------------------------------- SQL pieces
# Typed state columns, shared by many oracles.
_TYPED = """, s AS (SELECT *, TRY_CAST(lat AS DOUBLE) AS la, TRY_CAST(lon AS DOUBLE) AS lo,
 TRY_CAST(velocity AS DOUBLE) AS v, TRY_CAST(baroaltitude AS DOUBLE) AS b,
 TRY_CAST(geoaltitude AS DOUBLE) AS g, TRY_CAST(vertrate AS DOUBLE) AS vr FROM states)
"""
_K = "CAST(3.6 AS DOUBLE)"
_MIB = "CAST(1048576 AS DOUBLE)"
_NORM = "lower(regexp_replace({c}, '^\\s+|\\s+$', '', 'g'))"
_AIRBORNE = f"""SELECT v * {_K} AS velocity_kmh, b AS baroaltitude, lat, lon, icao24 FROM s
 WHERE onground = 'False' AND v IS NOT NULL AND b IS NOT NULL"""
_GROUND = """SELECT * FROM s WHERE la IS NOT NULL AND lo IS NOT NULL AND (onground = 'True'
 OR coalesce(g < 500 AND v * CAST(3.6 AS DOUBLE) < 50 AND vr BETWEEN -0.5 AND 0.5, false))"""
_VOTE = """SELECT icao24, time, la AS lat, lo AS lon FROM (SELECT *, row_number() OVER (PARTITION BY icao24
 ORDER BY TRY_CAST(time AS BIGINT), time, la, lo) AS rn FROM ground) x WHERE rn = 1"""
_CAND = """SELECT round(lat, 2) AS lat_cluster, round(lon, 2) AS lon_cluster, count(*) AS flight_count
 FROM vote GROUP BY 1, 2"""


def _states_sql(body: str, *extra: str) -> str:
    return duckdb_ctes("states", *extra) + _TYPED + body


# --------------------------------------------------------------- projections, filters

@register("airborne_points", _states_sql(_AIRBORNE))
def q_airborne_points(spark, sf):
    """Airborne state vectors with speed in km/h."""
    return _airborne_points(spark, sf)


def _airborne_points(spark: SparkSession, sf: str) -> DataFrame:
    """Airborne state vectors: speed in km/h, altitude, position, aircraft."""
    return select_existing(Fl.airborne(V.states(spark, sf)), ["velocity_kmh", "baroaltitude", "lat", "lon", "icao24"])


_PHASE = f"""SELECT v * {_K} AS velocity_kmh, g AS geoaltitude, vr * {_K} AS vertrate_kmh,
 CASE WHEN vr > 0.5 THEN 'climb' WHEN vr < -0.5 THEN 'descent' ELSE 'cruise' END AS phase
 FROM s WHERE v IS NOT NULL AND g IS NOT NULL AND vr IS NOT NULL AND vr * {_K} BETWEEN -90 AND 90"""


@register("phase_points", _states_sql(_PHASE))
def q_phase_points(spark, sf):
    """Points for the flight-phase view."""
    return Fl.phase_points(V.states(spark, sf))


@register("phase_profile", _states_sql(f""", p AS ({_PHASE})
SELECT phase, count(*) AS n, round(avg(velocity_kmh), 6) AS avg_speed_kmh, min(velocity_kmh) AS min_speed_kmh,
 max(velocity_kmh) AS max_speed_kmh, round(avg(geoaltitude), 6) AS avg_altitude, min(geoaltitude) AS min_altitude,
 max(geoaltitude) AS max_altitude FROM p GROUP BY phase"""))
def q_phase_profile(spark, sf):
    """Per-phase profile."""
    return A.phase_profile(Fl.phase_points(V.states(spark, sf)))


@register("ground_points", _states_sql(f"""SELECT event_id, icao24, time, la AS lat, lo AS lon, v AS velocity,
 g AS geoaltitude, vr AS vertrate, onground FROM ({_GROUND}) x"""))
def q_ground_points(spark, sf):
    """state vectors of aircraft on the ground."""
    g = Fl.on_ground_points(V.states(spark, sf))
    return g.select("event_id", "icao24", "time", "lat", "lon", "velocity", "geoaltitude", "vertrate", "onground")


@register("one_vote_ground", _states_sql(f", ground AS ({_GROUND})\n{_VOTE}"))
def q_one_vote_ground(spark, sf):
    """A2: earliest ground state per aircraft."""
    g = Fl.on_ground_points(V.states(spark, sf)).select("icao24", "time", "lat", "lon")
    return A.one_vote(g)


@register("airport_candidates", _states_sql(f", ground AS ({_GROUND}), vote AS ({_VOTE})\n{_CAND}"))
def q_airport_candidates(spark, sf):
    """F3 -> A2 -> P5 -> A4 + L1: ground grid cells by distinct aircraft."""
    return A.airport_candidates(V.states(spark, sf))


_HUBS = _states_sql(f""", ground AS ({_GROUND}), vote AS ({_VOTE}), cand AS ({_CAND}),
c AS (SELECT row_number() OVER (ORDER BY flight_count DESC, lat_cluster, lon_cluster) AS rn, * FROM cand),
g(i, kept) AS (
  SELECT CAST(0 AS BIGINT), []::STRUCT(rn BIGINT, la DOUBLE, lo DOUBLE)[]
  UNION ALL
  SELECT i + 1, CASE WHEN len(list_filter(kept, lambda k: pow(c.lat_cluster - k.la, 2)
           + pow((c.lon_cluster - k.lo) * cos(radians(k.la)), 2) < 0.2 * 0.2)) = 0
         THEN list_append(kept, {{'rn': c.rn, 'la': c.lat_cluster, 'lo': c.lon_cluster}}) ELSE kept END
  FROM g JOIN c ON c.rn = g.i + 1),
f AS (SELECT unnest(kept) AS k FROM (SELECT kept FROM g ORDER BY i DESC LIMIT 1))
SELECT c.lat_cluster, c.lon_cluster, c.flight_count FROM c WHERE rn IN (SELECT k.rn FROM f) ORDER BY rn LIMIT 50""")
_HUBS = _HUBS.replace("WITH states AS", "WITH RECURSIVE states AS", 1)


@register("airport_hubs", _HUBS)
def q_airport_hubs(spark, sf):
    """X1 + L3: top-50 airports after greedy spatial suppression."""
    return X.top_hubs(A.airport_candidates(V.states(spark, sf)), 50)


_SITES = """SELECT count(*) AS n_sites FROM (SELECT DISTINCT lat, lon FROM (SELECT *, row_number() OVER
 (PARTITION BY icao24 ORDER BY TRY_CAST(time AS BIGINT), time, lat, lon) AS rn FROM states WHERE onground = 'True') x
 WHERE rn = 1) y"""


@register("ground_sites_count", duckdb_ctes("states") + _SITES)
def q_ground_sites_count(spark, sf):
    """F4 + A13: number of exact ground positions, one vote per aircraft."""
    return A.ground_sites_count(V.states(spark, sf))


@register("upscaled_ground_sites", duckdb_ctes("states") + f"""SELECT
 (SELECT count(*) * 10 FROM states WHERE onground = 'True') AS n_rows, ({_SITES}) AS n_sites""")
def q_upscaled_ground_sites(spark, sf):
    """U1 + F4 + A13: the scaling workload over 10 copies of the feed."""
    from flightlake.operators.sampling import upscale
    up = upscale(V.states(spark, sf).select("icao24", "time", "lat", "lon", "onground"), 10)
    g = Fl.reported_on_ground(up)
    rows = g.agg(F.count(F.lit(1)).alias("n_rows"))
    return A.attach_scalars(rows, A.ground_sites_count(up))


# --------------------------------------------------------------- quality reports

_RULE_ROWS = [
    (0, "PK Exists", "every row needs an icao24 id", "NOT coalesce(icao24 IS NOT NULL AND icao24 <> '', false)"),
    (1, "Lat Range", "lat must lie between -90 and 90", "NOT coalesce(la IS NULL OR la BETWEEN -90 AND 90, false)"),
    (2, "Lon Range", "lon must lie between -180 and 180", "NOT coalesce(lo IS NULL OR lo BETWEEN -180 AND 180, false)"),
    (3, "Ground Logic", "contradiction: on ground but above 4000 m",
     "NOT coalesce(NOT (coalesce(lower(onground) = 'true', false) AND coalesce(b > 4000, false)), false)"),
]


def _validation_sql() -> str:
    cnt = ", ".join(f"count(*) FILTER (WHERE {cond}) AS f{i}" for i, _, _, cond in _RULE_ROWS)
    rows = " UNION ALL ".join(
        f"SELECT {i} AS rule_no, '{name}' AS rule, '{desc}' AS description, f{i} AS failed_rows, total FROM c"
        for i, name, desc, _ in _RULE_ROWS)
    return _states_sql(f""", c AS (SELECT count(*) AS total, {cnt} FROM s), r AS ({rows}),
p AS (SELECT *, CASE WHEN total > 0 THEN CAST(100 AS DOUBLE) - (CAST(failed_rows AS DOUBLE) / CAST(total AS DOUBLE)) * CAST(100 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS ok FROM r)
SELECT rule_no, rule, CASE WHEN failed_rows = 0 THEN 'PASS' WHEN ok > 90 THEN 'WARN' ELSE 'FAIL' END AS status,
 failed_rows, round(ok, 2) AS pct_passed, description FROM p ORDER BY rule_no""")


@register("validation_report", _validation_sql())
def q_validation_report(spark, sf):
    """A5: rule table PASS / WARN / FAIL."""
    return Q.validate(V.states(spark, sf))


_STATE_VIEW_COLS = ["event_id", "time", "icao24", "lat", "lon", "velocity", "heading", "vertrate", "callsign",
                    "onground", "alert", "spi", "squawk", "baroaltitude", "geoaltitude", "lastposupdate",
                    "lastcontact"]


def _missing_sql() -> str:
    numeric = set(Q.VALIDATION_NUMERIC)
    expr = {c: (f"TRY_CAST({c} AS DOUBLE)" if c in numeric else c) for c in _STATE_VIEW_COLS}
    rows = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS total_rows, count(*) FILTER (WHERE {expr[c]} IS NULL) AS missing FROM states"
        for c in _STATE_VIEW_COLS)
    return duckdb_ctes("states") + f""", r AS ({rows})
SELECT column_name, total_rows, missing, round(CASE WHEN total_rows > 0 THEN CAST(missing AS DOUBLE) / CAST(total_rows AS DOUBLE) ELSE CAST(0 AS DOUBLE) END * CAST(100 AS DOUBLE), 6) AS missing_pct
FROM r ORDER BY missing_pct DESC, column_name"""


@register("missing_report", _missing_sql())
def q_missing_report(spark, sf):
    """Missing values per column (numeric text that does not parse counts)."""
    return Q.missing_report(V.states(spark, sf), numeric=Q.VALIDATION_NUMERIC)


@register("missing_report_nonzero", _missing_sql().replace("FROM r ORDER BY", "FROM r WHERE missing > 0 ORDER BY"))
def q_missing_report_nonzero(spark, sf):
    """A7 + F8: only columns with missing values."""
    return Q.missing_report(V.states(spark, sf), numeric=Q.VALIDATION_NUMERIC, only_missing=True)


@register("ground_contradictions", _states_sql("""SELECT event_id, icao24, onground, b AS baroaltitude FROM s
 WHERE lower(onground) = 'true' AND b > 4000"""))
def q_ground_contradictions(spark, sf):
    """rows reported on ground above 4000 m."""
    return Fl.ground_contradictions(V.states(spark, sf)).select("event_id", "icao24", "onground", "baroaltitude")


# --------------------------------------------------------------- master data

_FEED = f"SELECT DISTINCT {_NORM.format(c='icao24')} AS icao24 FROM states WHERE icao24 IS NOT NULL"
_DIM = (f"SELECT {_NORM.format(c='icao24')} AS icao24, manufacturerName, model, typecode, operator FROM aircraft "
        f"WHERE icao24 IS NOT NULL")
_DIM_FIRST = (f"SELECT icao24, manufacturerName, model, typecode, operator FROM (SELECT * REPLACE ({_NORM.format(c='icao24')}"
              f" AS icao24), row_number() OVER (PARTITION BY {_NORM.format(c='icao24')} ORDER BY _pos) AS rn FROM aircraft"
              f" WHERE icao24 IS NOT NULL) x WHERE rn = 1")


@register("known_aircraft", duckdb_ctes("states", "aircraft") + f""", feed AS ({_FEED}), dim AS ({_DIM})
SELECT * FROM dim WHERE icao24 IN (SELECT icao24 FROM feed)""")
def q_known_aircraft(spark, sf):
    """P6 + J2: master rows of aircraft seen in the feed."""
    return J.known_aircraft(V.aircraft(spark, sf).drop("_pos"), V.states(spark, sf))


@register("unknown_aircraft", duckdb_ctes("states", "aircraft") + f""", feed AS ({_FEED}), dim AS ({_DIM})
SELECT icao24 FROM feed WHERE icao24 NOT IN (SELECT icao24 FROM dim)""")
def q_unknown_aircraft(spark, sf):
    """Anti-join: feed aircraft without master data."""
    return J.unknown_aircraft(V.states(spark, sf), V.aircraft(spark, sf))


def _coverage_sql() -> str:
    attrs = Q.COVERAGE_ATTRIBUTES
    cnt = ", ".join(f"count(CASE WHEN regexp_matches({a}, '^\\s*$') THEN NULL ELSE {a} END) AS \"{a}\"" for a in attrs)
    rows = " UNION ALL ".join(f"SELECT '{a}' AS attribute, \"{a}\" AS valid_count, matched_rows, feed_aircraft FROM m"
                              for a in attrs)
    pct = "round(CASE WHEN feed_aircraft > 0 THEN CAST({x} AS DOUBLE) / CAST(feed_aircraft AS DOUBLE) ELSE 0 END * CAST(100 AS DOUBLE), 6)"
    return duckdb_ctes("states", "aircraft") + f""", feed AS ({_FEED}), dim AS ({_DIM}),
m AS (SELECT count(*) AS matched_rows, {cnt}, (SELECT count(*) FROM feed) AS feed_aircraft
      FROM dim WHERE icao24 IN (SELECT icao24 FROM feed)),
r AS ({rows}), p AS (SELECT *, {pct.format(x='valid_count')} AS percentage, {pct.format(x='matched_rows')} AS match_rate FROM r)
SELECT attribute, valid_count, percentage, CASE WHEN percentage > 80 THEN 'good' WHEN percentage > 50 THEN 'medium' ELSE 'poor' END AS grade,
 feed_aircraft, matched_rows, match_rate FROM p ORDER BY percentage DESC, attribute"""


@register("metadata_coverage", _coverage_sql())
def q_metadata_coverage(spark, sf):
    """A6 + P7 + P16: master-data coverage of the feed's aircraft."""
    return Q.coverage(V.states(spark, sf), V.aircraft(spark, sf))


_ENRICHED = f""", air AS ({_AIRBORNE}), dim AS ({_DIM_FIRST}),
e AS (SELECT a.velocity_kmh, a.baroaltitude, a.lat, a.lon, {_NORM.format(c='a.icao24')} AS icao24,
 d.manufacturerName, d.model, d.typecode, d.operator FROM air a LEFT JOIN dim d ON {_NORM.format(c='a.icao24')} = d.icao24)
"""


@register("enriched_states", _states_sql(_ENRICHED + "SELECT * FROM e", "aircraft"))
def q_enriched_states(spark, sf):
    """J1 + J3: airborne states with master data (size-checked broadcast)."""
    air = _airborne_points(spark, sf)
    return J.enrich(air, V.aircraft(spark, sf))


@register("identified_aircraft", _states_sql(
    _ENRICHED + "SELECT * FROM e WHERE manufacturerName IS NOT NULL OR model IS NOT NULL", "aircraft"))
def q_identified_aircraft(spark, sf):
    """J1 + F6: enriched states with a known manufacturer or model."""
    air = _airborne_points(spark, sf)
    return Fl.identified(J.enrich(air, V.aircraft(spark, sf)))


_EXTREME = f""", air AS (SELECT *, CASE WHEN baroaltitude % 5 <> 0 THEN velocity_kmh END AS score FROM ({_AIRBORNE}) z),
x AS (SELECT velocity_kmh, baroaltitude, lat, lon, icao24, score FROM (SELECT *, row_number() OVER (PARTITION BY icao24
 ORDER BY score NULLS LAST, baroaltitude, lat, lon, velocity_kmh) AS rn FROM air) y WHERE rn = 1)
"""


@register("extreme_per_aircraft", _states_sql(_EXTREME + "SELECT * FROM x"))
def q_extreme_per_aircraft(spark, sf):
    """Per aircraft its most extreme row (score = speed, lowest first; some scores are missing)."""
    air = _airborne_points(spark, sf)
    scored = air.withColumn("score", F.when(F.col("baroaltitude") % 5 != 0, F.col("velocity_kmh")))
    return W.extreme_per_key(scored, "icao24", "score", ["baroaltitude", "lat", "lon", "velocity_kmh"])


_RISK = f""", air AS ({_AIRBORNE}), sc AS (SELECT *, -velocity_kmh / CAST(1000 AS DOUBLE) AS anomaly_score FROM air),
x AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY icao24
 ORDER BY anomaly_score, velocity_kmh, baroaltitude, lat, lon) AS rn FROM sc) y WHERE rn = 1), dim AS ({_DIM_FIRST}),
e AS (SELECT x.*, d.manufacturerName, d.model, d.typecode, d.operator FROM x LEFT JOIN dim d ON x.icao24 = d.icao24
 WHERE d.manufacturerName IS NOT NULL OR d.model IS NOT NULL)
SELECT round(anomaly_score, 4) AS risk_score, icao24 AS icao_id, manufacturerName AS manufacturer, model,
 typecode AS type, round(velocity_kmh, 1) AS speed_kmh, CAST(round(baroaltitude, 0) AS INTEGER) AS altitude_m,
 operator AS airline FROM e ORDER BY risk_score, icao_id LIMIT 50"""


@register("top_risks", _states_sql(_RISK, "aircraft"))
def q_top_risks(spark, sf):
    """W1 + J1 + F6 + P10 + L2 on a speed-based score: the 50 most extreme aircraft.

    The score is -speed/1000 (fastest first) so the risk-report chain can be
    checked exactly; ``risk_report`` runs the same chain on forest scores.
    """
    from flightlake.plans.jobs import risk_table
    air = _airborne_points(spark, sf)
    scored = air.withColumn("anomaly_score", -F.col("velocity_kmh") / F.lit(1000.0))
    worst = W.extreme_per_key(scored, "icao24", "anomaly_score", ["velocity_kmh", "baroaltitude", "lat", "lon"])
    return risk_table(worst, V.aircraft(spark, sf), k=50)


# --------------------------------------------------------------- telemetry

@register("stage_summary", duckdb_ctes("telemetry") + """SELECT stage,
 CAST(date_diff('microsecond', min(timestamp), max(timestamp)) AS DOUBLE) / CAST(1000000 AS DOUBLE) AS duration_s,
 round(sum(net_recv_mb), 6) AS net_recv_mb_sum, round(avg(cpu_percent), 6) AS cpu_avg, max(ram_gb) AS ram_gb_max
 FROM telemetry GROUP BY stage ORDER BY duration_s DESC, stage""")
def q_stage_summary(spark, sf):
    """Per-stage duration, traffic, CPU, RAM."""
    return W.stage_summary(V.telemetry(spark, sf))


@register("stage_intervals", duckdb_ctes("telemetry") + """, st AS (SELECT stage, min(timestamp) AS start FROM telemetry GROUP BY stage),
iv AS (SELECT stage, start, coalesce(lead(start) OVER (ORDER BY start, stage), (SELECT max(timestamp) FROM telemetry)) AS "end" FROM st)
SELECT stage, start, "end", CAST(date_diff('microsecond', start, "end") AS DOUBLE) / CAST(1000000 AS DOUBLE) AS duration_s,
 start + to_microseconds(CAST(floor(date_diff('microsecond', start, "end") / 2) AS BIGINT)) AS midpoint FROM iv""")
def q_stage_intervals(spark, sf):
    """Stage spans from first appearances."""
    return W.stage_intervals(V.telemetry(spark, sf))


@register("counter_delta", duckdb_ctes("telemetry") + f"""SELECT sample_id, timestamp, CAST(bytes_recv AS DOUBLE) AS bytes_recv,
 CAST(bytes_recv - coalesce(last_value(bytes_recv IGNORE NULLS) OVER (ORDER BY timestamp, sample_id
 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), bytes_recv) AS DOUBLE) / {_MIB} AS bytes_recv_delta_mb
 FROM telemetry""")
def q_counter_delta(spark, sf):
    """Per-interval MB from a cumulative byte counter."""
    t = V.telemetry(spark, sf).select("sample_id", "timestamp", F.col("bytes_recv").cast("double"))
    return W.counter_delta(t, "timestamp", ["bytes_recv"], seq="sample_id")


@register("counter_since_start", duckdb_ctes("telemetry") + f"""SELECT sample_id, timestamp, CAST(bytes_recv AS DOUBLE) AS bytes_recv,
 CAST(bytes_recv - first_value(bytes_recv IGNORE NULLS) OVER (ORDER BY timestamp, sample_id
 ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS DOUBLE) / {_MIB} AS bytes_recv_since_start_mb
 FROM telemetry""")
def q_counter_since_start(spark, sf):
    """MB received since the first sample."""
    t = V.telemetry(spark, sf).select("sample_id", "timestamp", F.col("bytes_recv").cast("double"))
    return W.counter_since_start(t, "timestamp", ["bytes_recv"], seq="sample_id")


@register("run_stats", duckdb_ctes("telemetry") + f"""SELECT
 CAST(date_diff('microsecond', min(timestamp), max(timestamp)) AS DOUBLE) / CAST(1000000 AS DOUBLE) AS duration_s,
 round(avg(cpu_percent), 6) AS avg_cpu, round(avg(ram_percent), 6) AS avg_ram,
 arg_max(disk_mb, (timestamp, sample_id)) FILTER (WHERE disk_mb IS NOT NULL) AS total_disk_mb,
 CAST(arg_max(bytes_recv, (timestamp, sample_id)) FILTER (WHERE bytes_recv IS NOT NULL)
 - arg_min(bytes_recv, (timestamp, sample_id)) FILTER (WHERE bytes_recv IS NOT NULL) AS DOUBLE) / {_MIB} AS total_net_mb,
 count(*) AS samples FROM telemetry""")
def q_run_stats(spark, sf):
    """A10: monitor aggregates of a run."""
    return W.run_stats(V.telemetry(spark, sf), seq="sample_id", disk="disk_mb")


@register("experiment_summary", duckdb_ctes("experiment_runs") + """SELECT max(disk_mb) AS max_disk_mb,
 max(CASE WHEN duration_sec > 0 THEN n_rows / duration_sec ELSE CAST(0 AS DOUBLE) END) AS peak_throughput,
 round(avg(cpu_percent / CAST(100 AS DOUBLE)), 6) AS avg_cpu_factor FROM experiment_runs""")
def q_experiment_summary(spark, sf):
    """Most disk MB, peak throughput and mean CPU factor over experiment runs."""
    return W.experiment_summary(V.view(spark, sf, "experiment_runs"))


@register("run_kpis", duckdb_ctes("metric_log") + """, d AS (SELECT (SELECT value FROM metric_log WHERE metric = 'Duration' ORDER BY timestamp DESC, seq DESC LIMIT 1) AS duration,
 coalesce((SELECT value FROM metric_log WHERE metric = 'RowCount' ORDER BY timestamp DESC, seq DESC LIMIT 1), CAST(0 AS DOUBLE)) AS row_count)
SELECT duration, row_count, CASE WHEN duration > 0 THEN row_count / duration ELSE CAST(0 AS DOUBLE) END AS throughput FROM d""")
def q_run_kpis(spark, sf):
    """A9 + W6: last duration, last row count, throughput."""
    return W.run_kpis(V.metric_log(spark, sf))


@register("bench_summary", duckdb_ctes("bench_history") + """SELECT files_count, duration_sec, avg_cpu, avg_ram, net_mb, disk_mb,
 CASE WHEN files_count > 0 THEN duration_sec / CAST(files_count AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS sec_per_file
 FROM (SELECT *, row_number() OVER (PARTITION BY files_count ORDER BY seq DESC) AS rn FROM bench_history) x WHERE rn = 1 ORDER BY files_count""")
def q_bench_summary(spark, sf):
    """W3 + P14: last run per file count, seconds per file."""
    return W.bench_summary(V.bench_history(spark, sf))


# --------------------------------------------------------------- distributions

def _hist_sql(expr: str) -> str:
    return _states_sql(f""", vals AS (SELECT {expr} AS x FROM s WHERE {expr} IS NOT NULL),
st AS (SELECT min(x) AS lo, max(x) AS hi FROM vals),
bb AS (SELECT CAST(CASE WHEN (hi - lo) / CAST(50 AS DOUBLE) > 0 THEN least(floor((x - lo) / ((hi - lo) / CAST(50 AS DOUBLE))), 49) ELSE 0 END AS INTEGER) AS bin,
 lo, (hi - lo) / CAST(50 AS DOUBLE) AS w FROM vals, st)
SELECT bin, lo + bin * w AS bin_lo, lo + (bin + 1) * w AS bin_hi, count(*) AS n FROM bb GROUP BY bin, lo, w ORDER BY bin""")


@register("velocity_histogram", _hist_sql("v"))
def q_velocity_histogram(spark, sf):
    """50-bin speed histogram."""
    return A.histogram(Fl.typed(V.states(spark, sf), ["velocity"]), "velocity", 50)


@register("altitude_histogram", _hist_sql("g"))
def q_altitude_histogram(spark, sf):
    """50-bin geometric-altitude histogram."""
    return A.histogram(Fl.typed(V.states(spark, sf), ["geoaltitude"]), "geoaltitude", 50)


# Freedman-Diaconis and Sturges widths from exact quartiles.
_AUTO = """st AS (SELECT count(*) AS n, min(x) AS lo, max(x) AS hi, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.75) AS q3 FROM vals),
wd AS (SELECT *, (hi - lo) / (log2(n) + 1) AS sturges, 2 * (q3 - q1) / pow(n, 1.0::DOUBLE / 3) AS fd FROM st),
k AS (SELECT *, CASE WHEN hi = lo THEN 1 ELSE greatest(1, ceil((hi - lo) / CASE WHEN fd > 0 THEN least(fd, sturges) ELSE sturges END)) END
 ::DOUBLE AS bins FROM wd),
bb AS (SELECT CAST(CASE WHEN (hi - lo) / bins > 0 THEN least(floor((x - lo) / ((hi - lo) / bins)), bins - 1) ELSE 0 END AS INTEGER) AS bin,
 lo, (hi - lo) / bins AS w FROM vals, k)
SELECT bin, lo + bin * w AS bin_lo, lo + (bin + 1) * w AS bin_hi, count(*) AS n FROM bb GROUP BY bin, lo, w ORDER BY bin"""


@register("altitude_histogram_auto", _states_sql(", vals AS (SELECT g AS x FROM s WHERE g IS NOT NULL), " + _AUTO))
def q_altitude_histogram_auto(spark, sf):
    """Geometric-altitude histogram whose width follows the quartiles."""
    return A.histogram(Fl.typed(V.states(spark, sf), ["geoaltitude"]), "geoaltitude", None)


@register("baro_histogram_auto", _states_sql(", vals AS (SELECT b AS x FROM s WHERE b IS NOT NULL), " + _AUTO))
def q_baro_histogram_auto(spark, sf):
    """Barometric-altitude histogram whose width follows the quartiles."""
    return A.histogram(Fl.typed(V.states(spark, sf), ["baroaltitude"]), "baroaltitude", None)


@register("position_heatmap", _states_sql("""SELECT round(la, 1) AS lat_cell, round(lo, 1) AS lon_cell, count(*) AS n,
 round(avg(g), 6) AS avg_geoaltitude FROM s WHERE la IS NOT NULL AND lo IS NOT NULL GROUP BY 1, 2"""))
def q_position_heatmap(spark, sf):
    """Positions per 0.1-degree cell with mean altitude."""
    return A.position_heatmap(V.states(spark, sf), digits=1)


@register("feed_aircraft", duckdb_ctes("states") + _FEED)
def q_feed_aircraft(spark, sf):
    """Distinct normalised aircraft ids of the feed."""
    return J.feed_keys(V.states(spark, sf))


@register("max_altitude", _states_sql("SELECT max(b) AS max_baroaltitude, max(g) AS max_geoaltitude, count(*) AS n_rows FROM s"))
def q_max_altitude(spark, sf):
    """A1 + A12: row count and altitude maxima."""
    t = Fl.typed(V.states(spark, sf), ["baroaltitude", "geoaltitude"])
    return t.agg(F.max("baroaltitude").alias("max_baroaltitude"), F.max("geoaltitude").alias("max_geoaltitude"),
                 F.count(F.lit(1)).alias("n_rows"))



# --------------------------------------------------------------- ingest rules and sources

_LEN_SPLIT = "string_split(regexp_replace(line, '^\\s+|\\s+$', '', 'g'), ',')"
_COLS16 = ["time", "icao24", "lat", "lon", "velocity", "heading", "vertrate", "callsign", "onground", "alert",
           "spi", "squawk", "baroaltitude", "geoaltitude", "lastposupdate", "lastcontact"]
_PADDED = ", ".join(f"coalesce(p[{i + 1}], '') AS {c}" for i, c in enumerate(_COLS16))
_LENIENT = (duckdb_ctes("lines") + f""", sp AS (SELECT event_id, {_LEN_SPLIT} AS p FROM lines)
SELECT event_id, {_PADDED} FROM sp WHERE len(p) >= 10 AND regexp_full_match(p[1], '[0-9]+')""")
_STRICT = (duckdb_ctes("lines") + f""", sp AS (SELECT event_id, {_LEN_SPLIT} AS p FROM lines
 WHERE length(regexp_replace(line, '^\\s+|\\s+$', '', 'g')) > 0 AND NOT (contains(line, 'time') AND contains(line, 'icao24')))
SELECT event_id, {_PADDED} FROM sp WHERE len(p) = 16""")


@register("accepted_rows_lenient", _LENIENT)
def q_accepted_rows_lenient(spark, sf):
    """Lenient line acceptance (>= 10 fields, numeric time, pad/truncate to 16)."""
    from flightlake.operators.ingest import accept_rows
    return accept_rows(V.view(spark, sf, "lines"), "lenient", "line", keep=["event_id"])


@register("accepted_rows_strict", _STRICT)
def q_accepted_rows_strict(spark, sf):
    """N2 + N3: strict acceptance (no blank/header lines, exactly 16 fields)."""
    from flightlake.operators.ingest import accept_rows
    return accept_rows(V.view(spark, sf, "lines"), "strict", "line", keep=["event_id"])


@register("clean_states", _LENIENT.replace("SELECT event_id, coalesce", ", acc AS (SELECT event_id, coalesce", 1)
          + """)
SELECT event_id, time, icao24, TRY_CAST(velocity AS DOUBLE) AS velocity, TRY_CAST(geoaltitude AS DOUBLE) AS geoaltitude
FROM acc WHERE TRY_CAST(velocity AS DOUBLE) IS NOT NULL""")
def q_clean_states(spark, sf):
    """N1 + N7: typed clean of accepted lines (velocity required)."""
    from flightlake.operators.ingest import accept_rows, clean_states
    acc = accept_rows(V.view(spark, sf, "lines"), "lenient", "line", keep=["event_id"])
    return clean_states(acc).select("event_id", "time", "icao24", "velocity", "geoaltitude")


@register("alias_coalesced", duckdb_ctes("records") + """SELECT event_id, coalesce(time, '') AS time, coalesce(icao24, '') AS icao24,
 coalesce(lat, latitude, '') AS lat, coalesce(longitude, '') AS lon, coalesce(speed, '') AS velocity,
 coalesce(track, '') AS heading, coalesce(vertical_rate, '') AS vertrate, coalesce(callsign, '') AS callsign,
 coalesce(CASE WHEN onground THEN 'True' WHEN NOT onground THEN 'False' END, '') AS onground, '' AS alert, '' AS spi,
 coalesce(squawk, '') AS squawk, '' AS baroaltitude, coalesce(geo_altitude, altitude, '') AS geoaltitude,
 '' AS lastposupdate, '' AS lastcontact FROM records""")
def q_alias_coalesced(spark, sf):
    """N5 + N6: records with alternative field names -> the 16 text columns."""
    from flightlake.functions import coalesce_alias
    rec = V.view(spark, sf, "records")
    return coalesce_alias(rec, _COLS16, keep=["event_id"])


_ARCH = duckdb_ctes("archive_keys") + """SELECT path, 0 AS prefix_rank FROM archive_keys WHERE suffix(path, '.tar')
 AND NOT contains(path, '/.') AND regexp_matches(path, '/20[12][0-9]-') ORDER BY path LIMIT 100"""


@register("archive_selection", _ARCH)
def q_archive_selection(spark, sf):
    """The first 100 valid archive keys in key order."""
    from flightlake.sources.files import select_archives
    return select_archives(V.view(spark, sf, "archive_keys"), n=100)


@register("archive_selection_prefixed", duckdb_ctes("archive_keys") + """SELECT path, CASE WHEN starts_with(path, 'states/2021-') THEN 0 ELSE 1 END AS prefix_rank
 FROM archive_keys WHERE suffix(path, '.tar') AND NOT contains(path, '/.') AND regexp_matches(path, '/20[12][0-9]-')
 AND (starts_with(path, 'states/2021-') OR starts_with(path, 'states/2016-')) ORDER BY prefix_rank, path LIMIT 100""")
def q_archive_selection_prefixed(spark, sf):
    """Prefix-ranked selection (first prefix first), first 100."""
    from flightlake.sources.files import select_archives
    return select_archives(V.view(spark, sf, "archive_keys"), n=100, prefixes=["states/2021-", "states/2016-"])


@register("aircraft_deduped", duckdb_ctes("aircraft_raw") + """SELECT icao24, manufacturerName, model, typecode, categoryDescription, operator
 FROM (SELECT *, row_number() OVER (PARTITION BY icao24 ORDER BY _pos) AS rn FROM aircraft_raw) x WHERE rn = 1""")
def q_aircraft_deduped(spark, sf):
    """N9 + A3: first master row per raw icao24 in file order."""
    from flightlake.operators.ingest import clean_aircraft
    return clean_aircraft(V.view(spark, sf, "aircraft_raw"), order_col="_pos")


@register("aircraft_deduped_normalised", duckdb_ctes("aircraft_raw") + f"""SELECT icao24, manufacturerName, model, typecode, categoryDescription, operator
 FROM (SELECT * REPLACE ({_NORM.format(c='icao24')} AS icao24), row_number() OVER (PARTITION BY {_NORM.format(c='icao24')} ORDER BY _pos) AS rn
 FROM aircraft_raw) x WHERE rn = 1""")
def q_aircraft_deduped_normalised(spark, sf):
    """N9 on the normalised key (one row per aircraft, not per spelling)."""
    from flightlake.operators.ingest import clean_aircraft
    return clean_aircraft(V.view(spark, sf, "aircraft_raw"), order_col="_pos", normalise_key=True)


# --------------------------------------------------------------- rows-only (hash sampling, model, files)

@register("hash_sample")
def q_hash_sample(spark, sf):
    """50 % seeded hash sample of the airborne points (layout-independent)."""
    from flightlake.operators.sampling import sample_hash
    air = _airborne_points(spark, sf)
    return sample_hash(air, 0.5, 42)


@register("exact_sample")
def q_exact_sample(spark, sf):
    """Exactly min(1000, rows) airborne points by seeded hash rank."""
    from flightlake.operators.sampling import sample_n
    air = _airborne_points(spark, sf)
    return sample_n(air, 1000, 42)


@register("fractional_upscale")
def q_fractional_upscale(spark, sf):
    """2.5 times the state vectors (two copies plus a half sample)."""
    from flightlake.operators.sampling import upscale
    return upscale(V.states(spark, sf), 2.5, copy_col="copy")


@register("speed_altitude_points", _states_sql(_AIRBORNE))
def q_speed_altitude_points(spark, sf):
    """JB3 (P1, P2, P3, F1): all airborne points; sample and cap are the caller's."""
    from flightlake.plans.jobs import speed_altitude_points
    return speed_altitude_points(V.states(spark, sf))


@register("upscaled_local_sort", _states_sql(
    "SELECT icao24, time, v AS velocity FROM s, (SELECT unnest(range(20)))"))
def q_upscaled_local_sort(spark, sf):
    """JB12 (U1, L7): 20 copies of the feed sorted by speed inside each partition (spill workload)."""
    from flightlake.operators.sampling import sort_local, upscale
    rows = Fl.typed(V.states(spark, sf).select("icao24", "time", "velocity"), ["velocity"])
    # Copies lie beside their row, so rows sorted before are sorted after: a task holds a row once.
    return upscale(sort_local(rows, ["velocity"]), 20)


def _cores(spark: SparkSession) -> int:
    """The tables here are single files: scoring deals their rows to the cores."""
    return spark.sparkContext.defaultParallelism


@register("anomalies")
def q_anomalies(spark, sf):
    """X2 + X3 + F5 + W1 (JB4): most anomalous state per aircraft by isolation forest."""
    from flightlake.plans.jobs import detect_anomalies, speed_altitude_points
    return detect_anomalies(speed_altitude_points(V.states(spark, sf)), spread=_cores(spark))


@register("upscaled_inference")
def q_upscaled_inference(spark, sf):
    """Forest fitted on the airborne points, scoring 1.5 times their volume."""
    from flightlake.operators import iforest
    from flightlake.plans.jobs import FOREST_FEATURES, batch_inference, speed_altitude_points
    pts = speed_altitude_points(V.states(spark, sf))
    feats = pts.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in FOREST_FEATURES})
    model = iforest.fit(feats, FOREST_FEATURES, contamination=0.01)
    return batch_inference(pts, model, 1.5, spread=_cores(spark))


@register("risk_report")
def q_risk_report(spark, sf):
    """JB6: forest anomalies joined to master data, top 50 risk table."""
    from flightlake.plans.jobs import risk_report
    return risk_report(V.states(spark, sf), V.aircraft(spark, sf), 50, spread=_cores(spark))


_INGESTED = duckdb_ctes("states") + f"""SELECT {", ".join(
    f"TRY_CAST({c} AS DOUBLE) AS {c}" if c in ("velocity", "geoaltitude") else f"coalesce({c}, '') AS {c}"
    for c in _COLS16)} FROM states WHERE TRY_CAST(velocity AS DOUBLE) IS NOT NULL AND regexp_full_match(time, '[0-9]+')"""


@register("tar_ingest", _INGESTED)
def q_tar_ingest(spark, sf):
    """S3 + N1 + N7: states written by the executors as tar(.csv.gz) archives,
    listed and read back in tasks, accepted and cleaned."""
    from flightlake.operators.ingest import accept_members, clean_states
    from flightlake.sources.archives import write_state_archives
    from flightlake.sources.tarstates import read_archive_members
    archives = write_state_archives(V.states(spark, sf).drop("event_id"),
                                    num_archives=spark.sparkContext.defaultParallelism)
    return clean_states(accept_members(read_archive_members(stored(archives, "archives")), "lenient"))


# further queries register themselves
from flightlake.plans import roundtrips  # noqa: E402, F401
