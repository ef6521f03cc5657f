"""Explicit schemas of every input the engine reads (no inference)."""

from pyspark.sql import types as T

# Column order of a state-vector line.
STATE_COLUMNS = [
    "time", "icao24", "lat", "lon", "velocity", "heading", "vertrate",
    "callsign", "onground", "alert", "spi", "squawk", "baroaltitude",
    "geoaltitude", "lastposupdate", "lastcontact",
]

# Master-data columns kept from the aircraft database.
AIRCRAFT_COLUMNS = ["icao24", "manufacturerName", "model", "typecode", "categoryDescription", "operator"]

TELEMETRY_SCHEMA = T.StructType([
    T.StructField("timestamp", T.TimestampType(), True),
    T.StructField("stage", T.StringType(), True),
    T.StructField("cpu_percent", T.DoubleType(), True),
    T.StructField("ram_percent", T.DoubleType(), True),
    T.StructField("ram_gb", T.DoubleType(), True),
    T.StructField("net_sent_mb", T.DoubleType(), True),
    T.StructField("net_recv_mb", T.DoubleType(), True),
])

METRIC_LOG_SCHEMA = T.StructType([
    T.StructField("timestamp", T.DoubleType(), True),
    T.StructField("iso_date", T.StringType(), True),
    T.StructField("stage", T.StringType(), True),
    T.StructField("metric", T.StringType(), True),
    T.StructField("value", T.DoubleType(), True),
    T.StructField("unit", T.StringType(), True),
    T.StructField("remarks", T.StringType(), True),
])

BENCH_SCHEMA = T.StructType([
    T.StructField("files_count", T.IntegerType(), True),
    T.StructField("duration_sec", T.DoubleType(), True),
    T.StructField("avg_cpu", T.DoubleType(), True),
    T.StructField("avg_ram", T.DoubleType(), True),
    T.StructField("net_mb", T.DoubleType(), True),
    T.StructField("disk_mb", T.DoubleType(), True),
])
