"""File sources, listings and sinks.

Listings are DataFrames (``binaryFile`` with only path/length/time selected,
so no file content is read); selections over them are ordinary filters and
top-k sorts, so they work the same over a key table.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flightlake.schemas import BENCH_SCHEMA, METRIC_LOG_SCHEMA, TELEMETRY_SCHEMA
from flightlake.session import stored
from flightlake.sources.quoted_csv import header_of, parse_records, read_records
from flightlake.sources.runs import (check_run, checksum, corrupt_parts, part_report, read_run, remove_tree,  # noqa: F401
                                     run_manifest, verify_run, write_run)

# Archive keys must carry a year 2010..2029 as "/<year>-".
ARCHIVE_YEAR_PATTERN = "/20[12][0-9]-"


# ------------------------------------------------------------------ listings

def list_files(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """Recursive listing as a DataFrame (path, length, modificationTime)."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.load(root).select("path", "length", "modificationTime")


def select_archives(files: DataFrame, n: int | None = None, suffix: str = ".tar",
                    prefixes: Sequence[str] | None = None, allow_hidden: bool = False,
                    year_pattern: str | None = ARCHIVE_YEAR_PATTERN, path_col: str = "path") -> DataFrame:
    """S1 + S2: keys ending in ``suffix``, not hidden, with a plausible year;
    ordered by prefix rank then key; the first ``n``.

    With ``prefixes`` a key must start with one of them and the earlier prefix
    ranks first.
    """
    p = F.col(path_col)
    out = files.filter(p.endswith(suffix))
    if not allow_hidden:
        out = out.filter(~p.contains("/."))
    if year_pattern:
        out = out.filter(p.rlike(year_pattern))
    rank = F.lit(0)
    if prefixes:
        rank = F.lit(None).cast(T.IntegerType())
        for i, pre in reversed(list(enumerate(prefixes))):
            rank = F.when(p.startswith(pre), F.lit(i)).otherwise(rank)
        out = out.withColumn("prefix_rank", rank).filter(F.col("prefix_rank").isNotNull())
    else:
        out = out.withColumn("prefix_rank", rank)
    out = out.orderBy("prefix_rank", path_col)
    return out.limit(n) if n else out


def first_archives(spark: SparkSession, root: str, n: int, suffix: str = ".tar", prefixes: Sequence[str] | None = None,
                   allow_hidden: bool = False, year_pattern: str | None = ARCHIVE_YEAR_PATTERN) -> tuple[DataFrame, int]:
    """S1 + S2 without a full listing: (``select_archives`` of the files below
    ``root``, number of folders listed).

    Folders are expanded in key order, the next one only when its keys are
    needed, and the walk stops at the n-th match; what it holds are the entries
    of the open folders and ``n`` keys. ``prefixes`` are relative to ``root``;
    each is walked in turn, starting at its deepest whole folder, and a folder
    that cannot hold a match (hidden) is not opened."""
    path_class = spark._jvm.org.apache.hadoop.fs.Path
    top = path_class(root)
    fs = top.getFileSystem(spark._jsc.hadoopConfiguration())
    base = fs.makeQualified(top).toString().rstrip("/") + "/"
    listed = 0

    def keys(folder: str, start: str) -> Iterator[tuple[str, int]]:
        """(key, length) below a folder in key order, of those that start with ``start``."""
        nonlocal listed
        target = path_class(base + folder)
        if not fs.exists(target):
            return
        listed += 1
        entries = []
        for status in fs.listStatus(target):
            name = folder + status.getPath().getName() + ("/" if status.isDirectory() else "")
            entries.append((name, status.isDirectory(), status.getLen()))
        for name, is_folder, length in sorted(entries):
            if not (name.startswith(start) or start.startswith(name)):
                continue
            if is_folder:
                if allow_hidden or "/." not in "/" + name:
                    yield from keys(name, start)
            elif name.startswith(start):
                yield name, length

    found: list[tuple[str, int, int]] = []
    seen: set[str] = set()
    for rank, prefix in enumerate(prefixes or [""]):
        for key, length in keys(prefix[:prefix.rfind("/") + 1], prefix):
            if len(found) == n:
                break
            hidden = not allow_hidden and "/." in "/" + key
            if key.endswith(suffix) and not hidden and key not in seen and (
                    year_pattern is None or re.search(year_pattern, "/" + key)):
                seen.add(key)
                found.append((base + key, length, rank))
    rows = spark.createDataFrame(found, "path string, length long, prefix_rank int")
    return rows.orderBy("prefix_rank", "path"), listed


def latest_run(files: DataFrame, path_col: str = "path") -> DataFrame:
    """The run directory (``run_<epoch>``) with the highest epoch; one row."""
    d = files.select(F.regexp_extract(F.col(path_col), r"^(.*/run_([0-9]+))(/|$)", 1).alias("run_dir"),
                     F.regexp_extract(F.col(path_col), r"/run_([0-9]+)(/|$)", 1).alias("epoch"))
    d = d.filter(F.col("epoch") != "").withColumn("epoch", F.col("epoch").cast(T.LongType()))
    return d.agg(F.max_by("run_dir", "epoch").alias("run_dir"), F.max("epoch").alias("epoch"))


def resolve_master(files: DataFrame, path_col: str = "path") -> DataFrame:
    """The newest dated master file (``...-YYYY-MM.csv``); one row."""
    v = files.select(F.col(path_col).alias("path"),
                     F.regexp_extract(F.col(path_col), r"([0-9]{4}-[0-9]{2})\.csv$", 1).alias("version"))
    v = v.filter(F.col("version") != "")
    return v.agg(F.max_by("path", F.struct("version", "path")).alias("path"), F.max("version").alias("version"))


def line_counts(spark: SparkSession, paths: Sequence[str] | str) -> DataFrame:
    """Number of text lines per file (gzip is decompressed by the reader)."""
    df = spark.read.text(paths if isinstance(paths, str) else list(paths))
    return df.groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count(F.lit(1)).alias("n_lines"))


# ------------------------------------------------------------------ readers

def split_aircraft_csv(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) rows of master-data CSV files, from one scan.

    All text, quote ``'``; line breaks in quotes are part of a value, and a file
    is still read by many tasks (``quoted_csv``). Rows that are too short are
    padded with NULL; ``_pos`` numbers the rows of all files in the order of the
    files. Rows with too many fields are rejected: (file, number, text, reason),
    ``number`` being the record's in its file."""
    records = read_records(spark, path)
    rows = parse_records(records, header_of(records)).filter("number > 1")
    sizes = records.groupBy("file").agg((F.max("number") - 1).alias("_n"))
    earlier = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # one row a file
    firsts = sizes.select("file", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_first"))
    placed = rows.join(firsts, "file").withColumn("_pos", F.col("_first") + F.col("number") - 2)
    accepted = placed.filter(~F.col("_over")).drop("file", "number", "text", "_over", "_first")
    rejected = rows.filter("_over").select("file", "number", "text", F.lit("too many fields").alias("reason"))
    return accepted, rejected


def read_aircraft_csv(spark: SparkSession, path: str) -> DataFrame:
    """The accepted rows of ``split_aircraft_csv``."""
    return split_aircraft_csv(spark, path)[0]


def read_telemetry(spark: SparkSession, path: str) -> DataFrame:
    """S10 + P11: sampler CSV with ISO timestamps."""
    return spark.read.schema(TELEMETRY_SCHEMA).option("header", True).csv(path)


def _record_order() -> Column:
    """Order of the records of text files: file, block in it, row of the block.
    (Row ids alone follow the splits, which are packed by size.)"""
    return F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                    F.monotonically_increasing_id().alias("row"))


def read_bench_history(spark: SparkSession, path: str) -> DataFrame:
    """Benchmark-history CSV; ``seq`` keeps the order of files and records."""
    df = spark.read.schema(BENCH_SCHEMA).option("header", True).csv(path)
    return df.withColumn("seq", _record_order())


def split_metric_log(spark: SparkSession, path: str, array: bool = True) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) records of a metric log, one JSON array (writer
    format) or JSON lines; ``seq`` keeps the order of files and records. Rejected:
    (seq, text, reason) of lines that are no JSON record of the log's types; an
    array that breaks off is one rejected text."""
    schema = T.StructType([*METRIC_LOG_SCHEMA.fields, T.StructField("_text", T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_text"}
    if array:  # a file is one task and one text: parsed once, as Spark asks of queries on what is broken
        df = stored(spark.read.schema(schema).options(multiLine=True, **options).json(path)
                    .withColumn("seq", _record_order()), "metric-log")
    else:
        lines = spark.read.text(path).filter("trim(value) <> ''").select("value", _record_order().alias("seq"))
        df = lines.select(F.from_json("value", schema, options).alias("r"), "seq").select("r.*", "seq")
    accepted = df.filter("_text IS NULL").drop("_text")
    return accepted, df.filter("_text IS NOT NULL").select("seq", F.col("_text").alias("text"), F.lit("no record").alias("reason"))


def read_metric_log(spark: SparkSession, path: str, array: bool = True) -> DataFrame:
    """The accepted records of ``split_metric_log``."""
    return split_metric_log(spark, path, array)[0]


# ------------------------------------------------------------------ sinks

def write_once(df: DataFrame, path: str) -> None:
    """Write unless the target exists."""
    df.write.mode("ignore").parquet(path)


def run_noop(df: DataFrame) -> None:
    """Execute the plan, discard the rows."""
    df.write.format("noop").mode("overwrite").save()
