"""Sampling, capping, local sort and upscaling.

Samples are decided per row by a seeded hash of key columns, so a row's
membership does not depend on partitioning or task order (Spark's own
``sample`` depends on both). Upscaling multiplies rows with a generator in
one scan instead of an N-fold union, which re-reads the input N times.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Default seed of the reference's sampling calls.
DEFAULT_SEED = 42
_RES = 1_000_000  # hash resolution for fractions


def _u(cols: Sequence[str], seed: int, salt: int = 0) -> Column:
    """Deterministic pseudo-uniform integer in [0, 10^6) per row."""
    return F.pmod(F.xxhash64(F.lit(seed), F.lit(salt), *[F.col(c) for c in cols]), F.lit(_RES))


def _keys(df: DataFrame, key_cols: Sequence[str] | None) -> list[str]:
    return list(key_cols) if key_cols else df.columns


def sample_hash(df: DataFrame, fraction: float, seed: int = DEFAULT_SEED,
                key_cols: Sequence[str] | None = None) -> DataFrame:
    """Bernoulli sample of ``fraction``; identical under any repartitioning."""
    if not 0.0 <= fraction <= 1.0:
        raise ValueError("fraction must be within [0, 1]")
    return df.filter(_u(_keys(df, key_cols), seed) < F.lit(int(round(fraction * _RES))))


def _smallest(df: DataFrame, n: int) -> DataFrame:
    """In each task the ``n`` rows with the smallest ``_hash`` (long): a bottom-k
    sketch that holds at most twice ``n`` rows and a batch."""
    schema = df.schema

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, limit = [], 0, None
        for batch in batches:
            if limit is not None:
                batch = batch.filter(pc.less_equal(batch.column("_hash"), limit))
            held.append(batch)
            size += batch.num_rows
            if size >= 2 * n + 10_000:
                held, limit = [cut(held)], None
                size = held[0].num_rows
                limit = pc.max(held[0].column("_hash"))
        if size:
            yield cut(held) if size > n else pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    def cut(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        order = np.argsort(table.column("_hash").to_numpy(), kind="stable")[:n]
        return table.take(pa.array(np.sort(order))).combine_chunks().to_batches()[0]

    return df.mapInArrow(keep, schema)


def sample_n(df: DataFrame, n: int, seed: int = DEFAULT_SEED, key_cols: Sequence[str] | None = None) -> DataFrame:
    """Exactly min(n, rows) rows — the n smallest seeded hashes (ties by the key columns).

    One pass and no job while the plan is built: every task keeps a bottom-k
    sketch, its n smallest rows; sketches merge into sketches of the same size,
    as a tree: all tasks' into about the square root of the shuffle partitions,
    those into one. No task holds more than some n rows at a time, and each sends
    n at most.
    """
    if n <= 0:
        return df.limit(0)
    keys = _keys(df, key_cols)
    width = math.isqrt(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))) + 1
    hashed = df.withColumn("_hash", F.xxhash64(F.lit(seed), *[F.col(c) for c in keys]))
    merged = _smallest(_smallest(hashed, n).repartition(width), n)
    return merged.orderBy("_hash", *keys).limit(n).drop("_hash")


def cap(df: DataFrame, n: int, seed: int = DEFAULT_SEED) -> DataFrame:
    """L4: at most ``n`` rows for a client: those with the smallest seeded hashes."""
    return sample_n(df, n, seed)


def sort_local(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Sort inside each partition, no shuffle."""
    return df.sortWithinPartitions(*cols)


def upscale(df: DataFrame, factor: float, seed: int = DEFAULT_SEED,
            key_cols: Sequence[str] | None = None, copy_col: str | None = None) -> DataFrame:
    """U1 + U2: ``factor`` times the rows.

    Integer part: that many copies of every row; fractional part (> 0.001):
    one more copy of a hash sample of that fraction; factor <= 1: a sample.
    ``copy_col`` keeps the copy number as a column.
    """
    if factor < 0:
        raise ValueError("factor must be >= 0")
    if factor <= 1.0:
        out = sample_hash(df, factor, seed, key_cols).withColumn("_copy", F.lit(0))
    else:
        whole = int(factor)
        rest = factor - whole
        extra = (F.when(_u(_keys(df, key_cols), seed) < F.lit(int(round(rest * _RES))), F.lit(1))
                 .otherwise(F.lit(0))) if rest > 0.001 else F.lit(0)
        n = F.lit(whole) + extra
        out = df.select("*", F.posexplode(F.array_repeat(F.lit(0), n)).alias("_copy", "_unused")).drop("_unused")
    return out.withColumnRenamed("_copy", copy_col) if copy_col else out.drop("_copy")
