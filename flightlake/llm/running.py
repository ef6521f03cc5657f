"""Running numbers and running xors inside keys that may be of any size.

Rows are range-partitioned by (key, order), so that a large key is spread over
many partitions; every task numbers its sorted rows in one pass, and what the
earlier partitions hold of a partition's first key is added afterwards. That
correction is one row a partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightlake.llm.common import materialise


def running(df: DataFrame, key: list[str], ranges: list[Column], order: list[Column], xors: list[str] = (),
            name: str = "running") -> DataFrame:
    """``df`` with ``nth`` (1, 2, ... inside each key, by ``order``) and, for each
    long column in ``xors``, the xor of its values so far (same name, replaced).

    ``key`` columns are longs or strings without nulls. ``ranges`` are the columns
    that deal the rows out after the key, a coarsening of ``order`` made of short
    values; rows equal in them stay together. The result is a written table."""
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    fields = {f.name: f.dataType.simpleString() for f in df.schema}
    schema = ", ".join(f"`{c}` {t}" for c, t in fields.items()) + ", nth long, __part int, __at long"

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at, last, count, carry = TaskContext.get().partitionId(), 0, None, 0, dict.fromkeys(xors, 0)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            keys = list(zip(*(batch.column(k).to_pylist() for k in key)))
            starts = np.array([k != before for k, before in zip(keys, [last, *keys])])
            first = np.maximum.accumulate(np.where(starts, np.arange(n), -1))  # -1: the key goes on from before
            nth = np.where(first < 0, np.arange(n) + count + 1, np.arange(n) - first + 1)
            columns = {c: batch.column(c) for c in fields}
            for c in xors:
                upto = np.bitwise_xor.accumulate(batch.column(c).to_numpy())
                before = np.concatenate([[np.int64(0)], upto])[np.maximum(first, 0)]
                upto ^= np.where(first < 0, np.int64(carry[c]), before)
                carry[c] = upto[-1]
                columns[c] = pa.array(upto)
            last, count = keys[-1], int(nth[-1])
            yield pa.RecordBatch.from_arrays(
                [*columns.values(), pa.array(nth, pa.int64()), pa.array(np.full(n, part, np.int32)),
                 pa.array(np.arange(at, at + n), pa.int64())], names=[*fields, "nth", "__part", "__at"])
            at += n

    dealt = df.repartitionByRange(parts, *key, *ranges).sortWithinPartitions(*key, *order)
    local = materialise(dealt.mapInArrow(number, schema), name)
    ends = F.struct("__at", *key, "nth", *xors)
    edges = local.groupBy("__part").agg(F.min(F.struct("__at", *key)).alias("head"), F.max(ends).alias("tail")).collect()
    fixes, open_key, sums = [], None, (0, *[0] * len(xors))
    for e in sorted(edges, key=lambda e: e["__part"]):
        head, tail = tuple(e["head"][k] for k in key), tuple(e["tail"][k] for k in key)
        if head == open_key:
            fixes.append((e["__part"], *head, *sums))
        here = (e["tail"]["nth"], *(e["tail"][c] for c in xors))
        if tail == open_key:  # the whole partition goes on with the key
            sums = (sums[0] + here[0], *(a ^ b for a, b in zip(sums[1:], here[1:])))
        else:
            open_key, sums = tail, here
    names = [f"__x{i}" for i in range(len(xors))]
    kinds = ["__part int", *(f"`{k}` {fields[k]}" for k in key), "__n long", *(f"{n} long" for n in names)]
    fix = F.broadcast(spark.createDataFrame(fixes, ", ".join(kinds)))  # a row a partition at most
    whole = local.join(fix, ["__part", *key], "left")
    out = [F.col(c).bitwiseXOR(F.coalesce(names[xors.index(c)], F.lit(0).cast("long"))).alias(c) if c in xors else F.col(c)
           for c in fields]
    return whole.select(*out, (F.col("nth") + F.coalesce("__n", F.lit(0).cast("long"))).alias("nth"))
