"""Splittable quoted CSV (S7): records with line breaks, read by many tasks.

A reader that allows line breaks in quotes takes a file as one task, because a
task that starts in the middle cannot know whether it is inside quotes. Here
every block of a file is read as lines, once, under both assumptions: each line
maps the state before it (between records, or inside quotes) to the state after
it, and the running state and record count are kept for both. Per block that
leaves one pair of outcomes; composing these in block order, one row a block,
tells each block its true state and the number of records before it. Lines that
are whole records (nearly all) go straight on to the parser; only records of
several lines are grouped.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flightlake.session import stored


def open_after(line: str, inside: bool, quote: str, sep: str) -> bool:
    """Whether a line ends inside quotes, starting there or at a record's start.

    A field that starts with the quote runs to the next single quote (a doubled
    one is text); if neither a separator nor the line's end follows it, the field
    goes on to the separator like an unquoted one, whose quotes are text."""
    if quote not in line:
        return inside
    at, n = 0, len(line)
    while True:
        if not inside:
            if at >= n:
                return False
            if line[at] != quote:
                at = line.find(sep, at) + 1
                if not at:
                    return False
                continue
            at += 1
        while True:  # inside quotes
            at = line.find(quote, at)
            if at < 0:
                return True
            if line[at + 1:at + 2] != quote:
                break
            at += 2
        inside = False
        at = line.find(sep, at + 1) + 1
        if not at:
            return False


def _scan_lines(lines: DataFrame, quote: str, sep: str) -> DataFrame:
    """Lines with their state before and after (open_a: the block starts between
    records, open_b: inside quotes) and the number of records started in the
    block up to and with the line (n_a, n_b)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, state, count = None, [False, True], [0, 0]
        for batch in batches:
            out: dict[str, list] = {k: [] for k in ("open_a", "open_b", "next_a", "next_b", "n_a", "n_b")}
            for file, start, line in zip(*(batch.column(c).to_pylist() for c in ("file", "block", "line"))):
                if (file, start) != block:
                    block, state, count = (file, start), [False, True], [0, 0]
                for i, s in enumerate("ab"):
                    before = state[i]
                    if not before and line.rstrip("\r"):  # an empty line between records is none
                        count[i] += 1
                    state[i] = open_after(line, before, quote, sep)
                    out[f"open_{s}"].append(before)
                    out[f"next_{s}"].append(state[i])
                    out[f"n_{s}"].append(count[i])
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(v) for v in out.values())],
                                             names=[*batch.schema.names, *out])

    flags = "open_a boolean, open_b boolean, next_a boolean, next_b boolean, n_a long, n_b long"
    return lines.mapInArrow(scan, f"file string, block long, row long, line string, {flags}")


def _block_starts(scanned: DataFrame) -> DataFrame:
    """(file, block, inside, before): true state at each block's start, and the
    records of the file that start before it."""
    ends = scanned.groupBy("file", "block").agg(F.max(F.struct("row", "next_a", "next_b", "n_a", "n_b")).alias("e"))
    ends = ends.select("file", "block", "e.next_a", "e.next_b", "e.n_a", "e.n_b")

    def compose(table: pa.Table) -> pa.Table:
        inside, before, out = False, 0, []
        for r in sorted(table.to_pylist(), key=lambda r: r["block"]):
            out.append((r["file"], r["block"], inside, before))
            before += r["n_b"] if inside else r["n_a"]
            inside = r["next_b"] if inside else r["next_a"]
        return pa.table(dict(zip(("file", "block", "inside", "before"), map(list, zip(*out)))))

    return ends.groupBy("file").applyInArrow(compose, "file string, block long, inside boolean, before long")


def read_records(spark: SparkSession, path: str | Sequence[str], quote: str = "'", sep: str = ",") -> DataFrame:
    """(file, number, text): the records of quoted CSV files, numbered from 1 in
    each file (the header is record 1). Empty lines between records are none; a
    record that is still open at the end of its file ends there.

    The lines are written once with their states, so that the two looks at them
    see the same blocks, whatever splits a later scan would make."""
    text = spark.read.option("lineSep", "\n").text(path if isinstance(path, str) else list(path))
    meta = "_metadata"
    lines = text.select(F.col(f"{meta}.file_path").alias("file"), F.col(f"{meta}.file_block_start").alias("block"),
                        F.monotonically_increasing_id().alias("row"), F.col("value").alias("line"))
    scanned = stored(_scan_lines(lines, quote, sep), "lines")
    starts = _block_starts(scanned)
    pick = lambda name: F.when(F.col("inside"), F.col(f"{name}_b")).otherwise(F.col(f"{name}_a"))
    placed = (scanned.join(starts, ["file", "block"])
              .select("file", (F.col("before") + pick("n")).alias("number"), "block", "row",
                      F.when((F.col("block") == 0) & F.col("line").startswith("﻿") & (pick("n") <= 1) & ~pick("open"),
                             F.substring("line", 2, 1 << 30)).otherwise(F.col("line")).alias("line"),
                      pick("open").alias("open"), pick("next").alias("next"))
              .filter("open OR rtrim('\r', line) <> ''"))
    whole = placed.filter("NOT open AND NOT next").select("file", "number", "line")
    parts = placed.filter("open OR next").groupBy("file", "number").agg(
        F.sort_array(F.collect_list(F.struct("block", "row", "line"))).alias("lines"))
    joined = parts.select("file", "number", F.array_join(F.col("lines.line"), "\n").alias("line"))
    return whole.union(joined).select("file", "number", F.expr("rtrim('\r', line)").alias("text"))


def parse_records(records: DataFrame, columns: Sequence[str], quote: str = "'", sep: str = ",") -> DataFrame:
    """``records`` with a text column for each of ``columns`` (null where the
    record is too short) and ``_over``, true where it has more fields."""
    schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(columns) + 1)])
    options = {"quote": quote, "escape": quote, "sep": sep, "multiLine": "true", "mode": "PERMISSIVE"}
    parsed = records.withColumn("_p", F.from_csv("text", schema.simpleString()[7:-1].replace(":", " "), options))
    last = F.col(f"_p.c{len(columns)}").isNotNull()
    return parsed.select(*records.columns, *[F.col(f"_p.c{i}").alias(c) for i, c in enumerate(columns)], last.alias("_over"))


def header_of(records: DataFrame, quote: str = "'", sep: str = ",") -> list[str]:
    """Names in the header of the first file (by path)."""
    head = records.filter("number = 1").orderBy("file").select("text").first()
    return next(csv.reader([head.text], quotechar=quote, delimiter=sep)) if head else []
