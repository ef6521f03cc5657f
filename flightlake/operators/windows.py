"""Window and ordered operators, telemetry reports.

No operator here runs a window over raw rows without a partition key:
ordered passes over a whole series (previous sample, first sample) are split
into ranges of equal row counts that run in parallel, and only per-range or
per-stage aggregates — tables far smaller than the input — are ordered globally.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flightlake.functions import safe_ratio, seconds_between
from flightlake.operators.aggregates import attach_scalars, first_per_key
from flightlake.session import stored

MIB = 1024.0 * 1024.0


def extreme_per_key(df: DataFrame, key: str = "icao24", score: str = "anomaly_score",
                    ties: Sequence[str] | None = None) -> DataFrame:
    """Per key the row with the lowest score (ties broken by ``ties``); a
    missing score is no extreme."""
    ties = list(ties) if ties is not None else [c for c in df.columns if c not in (key, score)]
    return first_per_key(df, key, [score, *ties])


def last_per_key(df: DataFrame, key: str | Sequence[str], seq: str) -> DataFrame:
    """Per key the row with the highest ``seq`` (the last one kept)."""
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys]
    picked = F.max_by(F.struct(*[F.col(c) for c in rest]), F.col(seq)).alias("_row")
    return df.groupBy(*keys).agg(picked).select(*keys, "_row.*").select(*df.columns)


def bench_summary(hist: DataFrame, seq: str = "seq") -> DataFrame:
    """W3 + P14: last run per files_count and seconds per file, by files_count."""
    last = last_per_key(hist, "files_count", seq)
    return (last.withColumn("sec_per_file", safe_ratio("duration_sec", "files_count"))
            .drop(seq).orderBy("files_count"))


def stage_summary(tele: DataFrame, ndigits: int = 6) -> DataFrame:
    """Per stage duration (max-min timestamp, s), download sum, mean CPU, peak RAM."""
    return (tele.groupBy("stage").agg(
        seconds_between(F.min("timestamp"), F.max("timestamp")).alias("duration_s"),
        F.round(F.sum("net_recv_mb"), ndigits).alias("net_recv_mb_sum"),
        F.round(F.avg("cpu_percent"), ndigits).alias("cpu_avg"),
        F.max("ram_gb").alias("ram_gb_max"))
        .orderBy(F.desc("duration_s"), "stage"))


def stage_intervals(tele: DataFrame, ts: str = "timestamp", stage: str = "stage") -> DataFrame:
    """First appearance of each stage; it ends where the next stage starts,
    the last one at the last sample. Adds duration and midpoint.

    The ordered pass runs over one row per stage (a small aggregate).
    """
    starts = tele.groupBy(stage).agg(F.min(ts).alias("start"))
    last = tele.agg(F.max(ts).alias("_last"))
    w = Window.orderBy("start", stage)
    iv = attach_scalars(starts, last).withColumn("end", F.coalesce(F.lead("start").over(w), F.col("_last")))
    diff_us = F.timestamp_diff("MICROSECOND", F.col("start"), F.col("end"))
    half_us = F.floor(diff_us / F.lit(2))
    return iv.select(stage, "start", "end", seconds_between("start", "end").alias("duration_s"),
                     F.timestamp_add("MICROSECOND", half_us, F.col("start")).alias("midpoint"))


def run_kpis(log: DataFrame, seq: str = "seq", ts: str = "timestamp") -> DataFrame:
    """A9 + W6: last Duration, last RowCount (0 if none), throughput rows/s.
    Last is by time where the log has one, then by ``seq``."""
    order = F.struct(*[F.col(c) for c in (ts, seq) if c in log.columns])

    def last_of(metric: str) -> Column:
        return F.max_by(F.col("value"), F.when(F.col("metric") == metric, order))
    k = log.agg(last_of("Duration").alias("duration"), last_of("RowCount").alias("row_count"))
    k = k.withColumn("row_count", F.coalesce("row_count", F.lit(0.0)))
    return k.withColumn("throughput", safe_ratio("row_count", "duration"))


def last_known_before(df: DataFrame, order: Sequence[str], cols: Sequence[str], partition_by: Sequence[str] = (),
                      ranges: int | None = None) -> DataFrame:
    """``df`` with ``_prev_<col>``: the last known value of each column before a
    row, by ``order`` inside ``partition_by`` (null if there is none).

    A segmented scan at any rate of samples. Rows are dealt to ranges of
    (partition, order) by quantiles of the data, so that no hour and no series is
    too much for a task. A task walks its sorted range batch by batch; a row
    before all known ones of its range takes what the earlier ranges carry: one
    row a range and series, scanned in order. One shuffle, one written table.
    """
    ranges = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts, cols, names = list(partition_by), list(cols), df.columns
    previous = [T.StructField(f"_prev_{c}", df.schema[c].dataType) for c in cols]
    schema = T.StructType([*df.schema.fields, *previous, T.StructField("_r", T.IntegerType())])

    def look_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here = TaskContext.get().partitionId()
        series, carry = None, {}
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            keys = list(zip(*(batch.column(p).to_pylist() for p in parts))) if parts else [()] * n
            starts = np.array([k != before for k, before in zip(keys, [series, *keys])])
            first = np.maximum.accumulate(np.where(starts, np.arange(n), -1))  # -1: the series goes on from before
            out = []
            for c in cols:
                column = batch.column(c)
                known = np.maximum.accumulate(np.where(np.asarray(column.is_valid()), np.arange(n), -1))
                before = np.concatenate([[-1], known[:-1]])
                inside = before >= np.maximum(first, 0)
                # Index 0 of the pool is what the series brings along, then come the batch's values.
                pool = pa.concat_arrays([pa.array([carry.get(c)], column.type), column])
                at = np.where(inside, before + 1, 0)
                out.append(pool.take(pa.array(at, mask=~inside & (first >= 0))))
                last = int(known[-1])
                if last >= max(int(first[-1]), 0):
                    carry[c] = column[last].as_py()
                elif first[-1] >= 0:
                    carry[c] = None
            series = keys[-1]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *out, pa.array(np.full(n, here, np.int32))],
                                             names=schema.names)

    sorted_ranges = df.repartitionByRange(ranges, *parts, *order).sortWithinPartitions(*parts, *order)
    scanned = stored(sorted_ranges.mapInArrow(look_back, schema), "ranges")
    at = F.struct(*order)
    carried = scanned.groupBy(*parts, "_r").agg(
        *[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), at)).alias(f"_carry_{c}") for c in cols])
    earlier = Window.partitionBy(*parts).orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    carried = carried.select(*[F.col(p).alias(f"_p_{p}") for p in parts], F.col("_r").alias("_q"),
                             *[F.last(f"_carry_{c}", ignorenulls=True).over(earlier).alias(f"_carry_{c}") for c in cols])
    same = F.col("_r") == F.col("_q")
    for p in parts:
        same = same & F.col(p).eqNullSafe(F.col(f"_p_{p}"))
    return scanned.join(carried, same, "left").select(
        *names, *[F.coalesce(f"_prev_{c}", f"_carry_{c}").alias(f"_prev_{c}") for c in cols])


def counter_delta(df: DataFrame, ts: str, cols: Sequence[str], seq: str | None = None,
                  partition_by: Sequence[str] = (), ranges: int | None = None, scale: float = MIB) -> DataFrame:
    """Cumulative counters -> per-interval deltas, divided by ``scale``.

    The base of a sample is the last known one before it (``last_known_before``),
    so that the deltas add up over gaps; the first known sample of a series has
    delta 0, an unknown one has none.
    """
    scanned = last_known_before(df, [ts, *([seq] if seq else [])], cols, partition_by, ranges)
    out = {f"{c}_delta_mb": (F.col(c) - F.coalesce(f"_prev_{c}", c)).cast(T.DoubleType()) / F.lit(scale) for c in cols}
    return scanned.withColumns(out).drop(*[f"_prev_{c}" for c in cols])


def counter_since_start(df: DataFrame, ts: str, cols: Sequence[str], seq: str | None = None,
                        partition_by: Sequence[str] = (), scale: float = MIB) -> DataFrame:
    """Counter minus its first known value of the series, divided by ``scale``.

    The first value is an aggregate (min_by): joined back per partition key,
    or a scalar subquery for a single series; no window.
    """
    parts = list(partition_by)
    order = F.struct(F.col(ts), *([F.col(seq)] if seq else []))
    firsts = df.groupBy(*parts).agg(*[F.min_by(F.col(c), F.when(F.col(c).isNotNull(), order)).alias(f"_first_{c}")
                                      for c in cols])
    joined = df.join(firsts, parts, "left") if parts else attach_scalars(df, firsts)
    out = {f"{c}_since_start_mb": (F.col(c) - F.col(f"_first_{c}")).cast(T.DoubleType()) / F.lit(scale)
           for c in cols}
    return joined.withColumns(out).drop(*[f"_first_{c}" for c in cols])


def run_stats(samples: DataFrame, ts: str = "timestamp", counter: str = "bytes_recv", seq: str | None = None,
              ndigits: int = 6, disk: str | None = None) -> DataFrame:
    """A10: duration, mean CPU, mean RAM, counter MB from the first known to the
    last known sample; with ``disk``, a cumulative MB column, its last known value."""
    order = F.struct(F.col(ts), *([F.col(seq)] if seq else []))
    known = F.when(F.col(counter).isNotNull(), order)
    last_disk = [F.max_by(F.col(disk), F.when(F.col(disk).isNotNull(), order)).alias("total_disk_mb")] if disk else []
    return samples.agg(
        seconds_between(F.min(ts), F.max(ts)).alias("duration_s"),
        F.round(F.avg("cpu_percent"), ndigits).alias("avg_cpu"),
        F.round(F.avg("ram_percent"), ndigits).alias("avg_ram"),
        ((F.max_by(F.col(counter), known) - F.min_by(F.col(counter), known)).cast(T.DoubleType())
         / F.lit(MIB)).alias("total_net_mb"), *last_disk,
        F.count(F.lit(1)).alias("samples"))


def experiment_summary(runs: DataFrame, ndigits: int = 6) -> DataFrame:
    """Scalars over experiment runs (n_rows, duration_sec, cpu_percent, disk_mb):
    most disk MB, peak throughput (rows/s, P14), mean CPU factor (busy cores,
    cpu_percent / 100)."""
    return runs.agg(F.max("disk_mb").alias("max_disk_mb"),
                    F.max(safe_ratio("n_rows", "duration_sec")).alias("peak_throughput"),
                    F.round(F.avg(F.col("cpu_percent") / F.lit(100.0)), ndigits).alias("avg_cpu_factor"))
