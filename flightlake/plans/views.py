"""Flight-state shaped views over the driver's test tables.

The test tables are a generic star schema; these views map them onto the
inputs the operators expect (text state vectors, aircraft master data,
telemetry samples, a metric log, benchmark history). One SQL text serves
both engines: Spark runs it through ``spark.sql`` with the scanned
DataFrame bound to ``{table}``; the DuckDB oracle inlines it as a CTE.
Every view is a projection of a whole table, so its size grows with the
table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# ``states`` — 16 text columns of a state vector, plus event_id as tie-breaker;
# some times do not parse.
STATES_SQL = """
SELECT event_id, CASE WHEN event_id % 89 = 5 THEN 'bad' ELSE CAST(1704067200 + event_id * 10 AS STRING) END AS time,
 lower(hex(user_id + 10485760)) AS icao24,
 CAST(CAST(((user_id % 12) * 1000 - 6000 + (event_id % 9) * 3) * 10 + (event_id % 2) * 6 + 1 AS DOUBLE) / CAST(1000 AS DOUBLE) AS STRING) AS lat,
 CAST(CAST(((user_id % 12) * 2500 - 15000 + (event_id % 5) * 7) * 10 + (event_id % 2) * 6 + 1 AS DOUBLE) / CAST(1000 AS DOUBLE) AS STRING) AS lon,
 CASE WHEN event_id % 17 = 0 THEN '' WHEN event_id % 101 = 0 THEN 'bad' ELSE CAST(value AS STRING) END AS velocity,
 CAST((event_id * 7) % 360 AS STRING) AS heading,
 CAST((event_id % 61) - 30 AS STRING) AS vertrate,
 CASE WHEN event_id % 10 = 0 THEN '' ELSE concat('CS', CAST(user_id AS STRING)) END AS callsign,
 CASE WHEN event_type = 'signup' THEN 'True' ELSE 'False' END AS onground,
 'False' AS alert, 'False' AS spi, CAST(1000 + event_id % 7000 AS STRING) AS squawk,
 CASE WHEN event_id % 13 = 0 THEN '' ELSE CAST((event_id * 37) % 12500 AS STRING) END AS baroaltitude,
 CAST((event_id * 37) % 12500 + 50 AS STRING) AS geoaltitude,
 CAST(1704067200 + event_id * 10 AS STRING) AS lastposupdate, CAST(1704067201 + event_id * 10 AS STRING) AS lastcontact
FROM {events}
"""

# ``aircraft`` — upper-case keys with a trailing blank, NULL and blank
# attributes; other spellings of some keys without any attributes, before or
# behind the known row in file order (_pos); a row without a key.
AIRCRAFT_SQL = """
SELECT p_partkey * 2 + 1 AS _pos, concat(upper(hex(p_partkey * 2 + 10485760)), ' ') AS icao24,
 CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE p_brand END AS manufacturerName,
 CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_name END AS model, p_type AS typecode,
 CASE WHEN p_partkey % 3 = 0 THEN '  ' ELSE p_brand END AS operator FROM {part}
UNION ALL SELECT CASE WHEN p_partkey % 22 = 0 THEN p_partkey * 2 ELSE p_partkey * 2 + 1000000000 END AS _pos,
 lower(hex(p_partkey * 2 + 10485760)) AS icao24, CAST(NULL AS STRING), CAST(NULL AS STRING), CAST(NULL AS STRING), CAST(NULL AS STRING)
 FROM {part} WHERE p_partkey % 11 = 0
UNION ALL SELECT 0 AS _pos, CAST(NULL AS STRING), p_brand, p_name, p_type, p_brand FROM {part} WHERE p_partkey % 50 = 1
"""

# ``telemetry`` — sampler output; bytes_recv is a cumulative counter with gaps.
TELEMETRY_SQL = """
SELECT event_id AS sample_id, ts AS timestamp, event_type AS stage,
 CAST((event_id * 13) % 100 AS DOUBLE) AS cpu_percent, CAST((event_id * 11) % 100 AS DOUBLE) AS ram_percent,
 CAST((event_id * 7) % 160 AS DOUBLE) / CAST(10 AS DOUBLE) AS ram_gb, CAST(0 AS DOUBLE) AS net_sent_mb, value AS net_recv_mb,
 CASE WHEN event_id % 53 < 2 THEN NULL ELSE (event_id * event_id) * 4096 END AS bytes_recv,
 CASE WHEN event_id % 29 < 3 THEN NULL ELSE CAST(event_id AS DOUBLE) / CAST(4 AS DOUBLE) END AS disk_mb FROM {events}
"""

# ``metric_log`` — pipeline metric records.
METRIC_LOG_SQL = """
SELECT event_id AS seq, ts AS timestamp, 'Processing' AS stage,
 CASE event_type WHEN 'purchase' THEN 'Duration' WHEN 'view' THEN 'RowCount' ELSE 'Status' END AS metric,
 value, 'u' AS unit, props AS remarks FROM {events}
"""

# ``bench_history`` — ingest benchmark runs, several per files_count.
BENCH_HISTORY_SQL = """
SELECT o_orderkey AS seq, CAST(1 + (o_orderkey % 8) * 5 AS INT) AS files_count, o_totalprice AS duration_sec,
 CAST(o_orderkey % 100 AS DOUBLE) AS avg_cpu, CAST(o_custkey % 100 AS DOUBLE) AS avg_ram, CAST(o_orderkey % 977 AS DOUBLE) AS net_mb, CAST(o_custkey % 499 AS DOUBLE) AS disk_mb FROM {orders}
"""

# ``experiment_runs`` — scaling runs: rows, time (some unknown or zero), CPU and disk.
EXPERIMENT_RUNS_SQL = """
SELECT o_orderkey AS run_id, CAST(o_orderkey % 1000 * 1000 AS DOUBLE) AS n_rows,
 CASE WHEN o_orderkey % 31 = 0 THEN NULL WHEN o_orderkey % 37 = 0 THEN CAST(0 AS DOUBLE) ELSE o_totalprice END AS duration_sec,
 CAST(o_custkey % 800 AS DOUBLE) AS cpu_percent, CASE WHEN o_orderkey % 41 = 0 THEN NULL ELSE CAST(o_custkey % 499 AS DOUBLE) END AS disk_mb
FROM {orders}
"""

_SC = "time, icao24, lat, lon, velocity, heading, vertrate, callsign, onground, alert, spi, squawk, baroaltitude, geoaltitude, lastposupdate, lastcontact"

# ``lines`` — raw state lines: well-formed, short (9, 10 fields), long (17),
# header, blank, non-numeric time, padded with blanks.
LINES_SQL = f"""
SELECT event_id, CASE event_id % 11
 WHEN 0 THEN concat_ws(',', time, icao24, lat, lon, velocity, heading, vertrate, callsign, onground)
 WHEN 1 THEN concat_ws(',', time, icao24, lat, lon, velocity, heading, vertrate, callsign, onground, alert)
 WHEN 2 THEN concat_ws(',', {_SC}, 'x')
 WHEN 3 THEN 'time,icao24,lat,lon,velocity,heading,vertrate,callsign,onground,alert,spi,squawk,baroaltitude,geoaltitude,lastposupdate,lastcontact'
 WHEN 4 THEN '   '
 WHEN 5 THEN concat_ws(',', concat('T', time), icao24, lat, lon, velocity, heading, vertrate, callsign, onground, alert, spi, squawk, baroaltitude, geoaltitude, lastposupdate, lastcontact)
 WHEN 6 THEN concat('  ', concat_ws(',', {_SC}), ' ')
 ELSE concat_ws(',', {_SC}) END AS line
FROM {{states}}
"""

# ``records`` — state records with alternative field names and gaps.
RECORDS_SQL = """
SELECT event_id, time, icao24, CASE WHEN event_id % 3 = 0 THEN NULL ELSE lat END AS lat, lat AS latitude,
 lon AS longitude, CASE WHEN event_id % 4 = 0 THEN NULL ELSE velocity END AS speed, heading AS track,
 vertrate AS vertical_rate, CASE WHEN event_id % 5 = 0 THEN NULL ELSE geoaltitude END AS geo_altitude,
 baroaltitude AS altitude, callsign, onground = 'True' AS onground, squawk
FROM {states}
"""

# ``archive_keys`` — object-store style archive keys, some hidden, some of
# other kinds, years spread over two decades.
ARCHIVE_KEYS_SQL = """
SELECT concat(CASE WHEN o_orderkey % 7 = 0 THEN 'states/.' ELSE 'states/' END,
 CAST(year(o_orderdate) + 20 + CAST(o_orderkey % 3 AS INTEGER) * 6 AS STRING), '-',
 lpad(CAST(month(o_orderdate) AS STRING), 2, '0'), '-', lpad(CAST(day(o_orderdate) AS STRING), 2, '0'), '/',
 lpad(CAST(o_orderkey % 24 AS STRING), 2, '0'), '/states_', CAST(o_orderkey AS STRING),
 CASE WHEN o_orderkey % 5 = 0 THEN '.csv.gz' ELSE '.csv.tar' END) AS path
FROM {orders}
"""

# ``aircraft_raw`` — master data with repeated ids (raw and case/blank variants).
AIRCRAFT_RAW_SQL = """
SELECT p_partkey AS _pos, concat(CASE WHEN p_partkey % 4 = 0 THEN upper(hex(p_partkey % 499 * 2 + 10485760))
 ELSE lower(hex(p_partkey % 499 * 2 + 10485760)) END, CASE WHEN p_partkey % 2 = 0 THEN ' ' ELSE '' END) AS icao24,
 p_brand AS manufacturerName, p_name AS model, p_type AS typecode,
 CASE WHEN p_size > 25 THEN 'Large' ELSE 'Small' END AS categoryDescription, p_brand AS operator
FROM {part}
"""

VIEWS: dict[str, tuple[str, str]] = {
    "lines": (LINES_SQL, "states"),
    "records": (RECORDS_SQL, "states"),
    "archive_keys": (ARCHIVE_KEYS_SQL, "orders"),
    "aircraft_raw": (AIRCRAFT_RAW_SQL, "part"),
    "states": (STATES_SQL, "events"),
    "aircraft": (AIRCRAFT_SQL, "part"),
    "telemetry": (TELEMETRY_SQL, "events"),
    "metric_log": (METRIC_LOG_SQL, "events"),
    "experiment_runs": (EXPERIMENT_RUNS_SQL, "orders"),
    "bench_history": (BENCH_HISTORY_SQL, "orders"),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The named view as a Spark DataFrame over ``sf_dir`` (views may stack)."""
    sql, base = VIEWS[name]
    src = view(spark, sf_dir, base) if base in VIEWS else table(spark, sf_dir, base)
    return spark.sql(sql, **{base: src})


def states(spark, sf_dir):
    return view(spark, sf_dir, "states")


def aircraft(spark, sf_dir):
    return view(spark, sf_dir, "aircraft")


def telemetry(spark, sf_dir):
    return view(spark, sf_dir, "telemetry")


def metric_log(spark, sf_dir):
    return view(spark, sf_dir, "metric_log")


def bench_history(spark, sf_dir):
    return view(spark, sf_dir, "bench_history")


def duckdb_ctes(*names: str) -> str:
    """``WITH`` clause defining the named views (and the views they stack on)
    for DuckDB, where the driver tables are pre-registered."""
    order: list[str] = []

    def add(n: str) -> None:
        base = VIEWS[n][1]
        if base in VIEWS:
            add(base)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    parts = []
    for n in order:
        sql, base = VIEWS[n]
        parts.append(f"{n} AS ({sql.replace('{' + base + '}', base).strip()})")
    return "WITH " + ",\n".join(parts) + "\n"
