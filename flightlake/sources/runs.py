"""Parquet runs whose content can be checked.

A run is written together with a manifest: an order-free checksum of its rows
(their number, the sum and the xor of two hashes a row), observed while the rows
are written, so it costs no second pass. Recomputed on reading, it tells of
damaged values, lost parts and doubled parts, however the parts are laid out.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Folder of a run's manifest; readers of the run pass over names with "_".
MANIFEST = "_manifest"


@dataclass(frozen=True)
class Checksum:
    """Number of rows, and sum and xor of their hashes."""
    rows: int
    hash_sum: Decimal
    hash_xor: int


def _hashable(column: Column, kind: T.DataType) -> Column:
    """A column that a hash takes: maps (which have no order) as sorted entries."""
    if isinstance(kind, T.MapType):
        return F.array_sort(F.map_entries(column))
    return F.to_json(F.struct(column)) if "map<" in kind.simpleString() else column


def checksum_columns(df: DataFrame) -> list[Column]:
    """Aggregates rows, hash_sum and hash_xor over all columns (by name, so that
    their order does not matter; a null hashes apart from every value)."""
    parts: list[Column] = []
    for f in sorted(df.schema.fields, key=lambda f: f.name):
        c = F.col(f"`{f.name}`")
        parts += [c.isNull(), _hashable(c, f.dataType)]
    one, two = (F.xxhash64(F.lit(seed), *parts) for seed in (1, 2))
    return [F.count(F.lit(1)).alias("rows"),
            F.coalesce(F.sum(one.cast(T.DecimalType(20, 0))), F.lit(0)).cast(T.DecimalType(38, 0)).alias("hash_sum"),
            F.coalesce(F.bit_xor(two), F.lit(0).cast("long")).alias("hash_xor")]


def checksum(df: DataFrame) -> Checksum:
    """Checksum of a DataFrame: one pass that decodes every column."""
    return Checksum(*df.agg(*checksum_columns(df)).first())


def read_run(spark: SparkSession, path: str | Sequence[str], merge_schema: bool = False,
             skip_corrupt: bool = False) -> DataFrame:
    """S8 + U3: Parquet run directory (or several). A broken part file fails the
    read; with ``skip_corrupt`` what cannot be read is left out (``part_report``
    names it), and the schema is that of all parts with a footer."""
    r = spark.read.option("mergeSchema", merge_schema or skip_corrupt).option("ignoreCorruptFiles", skip_corrupt)
    return r.parquet(*([path] if isinstance(path, str) else list(path)))


def write_run(df: DataFrame, root: str, run_id: int) -> str:
    """Write a new ``run_<id>`` directory (overwrite) and, when all its parts
    are there, its manifest; returns its path. A run without one is unfinished."""
    path = f"{root.rstrip('/')}/run_{int(run_id)}"
    seen = Observation()
    df.observe(seen, *checksum_columns(df)).write.mode("overwrite").parquet(path)
    row = [(seen.get["rows"], str(seen.get["hash_sum"]), seen.get["hash_xor"])]
    (df.sparkSession.createDataFrame(row, "rows long, hash_sum string, hash_xor long")
     .coalesce(1).write.mode("overwrite").json(f"{path}/{MANIFEST}"))
    return path


def run_manifest(spark: SparkSession, path: str) -> Checksum | None:
    """What the manifest of a run says (None: it has none)."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{MANIFEST}")
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return None
    row = spark.read.schema("rows long, hash_sum string, hash_xor long").json(f"{path.rstrip('/')}/{MANIFEST}").first()
    return Checksum(row.rows, Decimal(row.hash_sum), row.hash_xor) if row else None


def check_run(spark: SparkSession, path: str) -> tuple[Checksum | None, Checksum]:
    """(what was written, what is read now) of a run. Every column is decoded, so
    a part that cannot be read fails the check."""
    return run_manifest(spark, path), checksum(read_run(spark, path))


def verify_run(spark: SparkSession, path: str, cols: Sequence[str] = ("time", "icao24", "lat", "lon"),
               k: int = 5) -> tuple[int, DataFrame]:
    """Re-read a run: row count and a k-row preview of some columns. Raises
    if a part cannot be read or the rows are not those of the manifest (a run
    without one is read in full, but there is nothing to hold it against)."""
    written, read = check_run(spark, path)
    if written is not None and written != read:
        raise RuntimeError(f"{path} holds other rows than were written: {read.rows} of {written.rows}, "
                           f"checksum {'equal' if written.hash_sum == read.hash_sum else 'different'}")
    df = read_run(spark, path)
    return read.rows, df.select(*[c for c in cols if c in df.columns]).limit(k)


def part_report(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, expected, decoded, fault) for each part file of a run:
    the rows its footer promises against those that really decode. ``fault`` is
    'footer' where the file has no readable footer (expected is null), 'rows'
    where fewer rows decode, null for a sound part, also an empty one. Footers are
    read in tasks by offset; the rows in one scan that goes on after a break."""
    from flightlake.sources.files import list_files
    from flightlake.sources.tarstates import _filesystem

    def footers(batches: Iterator) -> Iterator:
        import pyarrow.parquet as pq
        for pdf in batches:
            rows = []
            for p in pdf["path"]:
                fs, inner = _filesystem(p)
                try:
                    with fs.open_input_file(inner) as f:
                        rows.append(pq.ParquetFile(f).metadata.num_rows)
                except (OSError, ValueError):  # pyarrow's word for no footer or a damaged one
                    rows.append(None)
            yield pdf.assign(expected=rows).astype({"expected": "Int64"})

    listed = list_files(spark, path, "*.parquet").select("path", "length")
    promised = listed.mapInPandas(footers, "path string, length long, expected long")
    df = read_run(spark, path, skip_corrupt=True)
    decode = checksum_columns(df)[2]  # has every column read, not only counted
    found = (df.select("*", F.col("_metadata.file_path").alias("_file")).groupBy("_file")
             .agg(F.count(F.lit(1)).alias("decoded"), decode.alias("_hash")))
    # Listings give plain paths, readers encoded ones: compare the names.
    name = lambda c: F.element_at(F.split(F.col(c), "/"), -1)
    joined = promised.join(found.select(name("_file").alias("_name"), "decoded", "_hash"), name("path") == F.col("_name"), "left")
    decoded = F.when(F.col("_hash").isNotNull(), F.col("decoded")).otherwise(F.lit(0).cast("long"))
    fault = F.when(F.col("expected").isNull(), "footer").when(F.col("decoded") != F.col("expected"), "rows")
    return joined.withColumn("decoded", decoded).select("path", "length", "expected", "decoded", fault.alias("fault"))


def corrupt_parts(spark: SparkSession, path: str) -> DataFrame:
    """The parts of a run that cannot be read in full (see ``part_report``)."""
    return part_report(spark, path).filter(F.col("fault").isNotNull())


def remove_tree(spark: SparkSession, path: str) -> None:
    """Delete a folder of ours (any file system that Spark knows)."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
