"""``tarstates``: a Python Data Source over tar archives of state files.

An archive's members are listed from its headers alone (member data is skipped
by seeking) and read by offset, so one large archive is read by many tasks and
memory stays bounded by one block of text. Members:

* ``*.csv.gz``   gunzipped, one row per line;
* plain csv      (name contains ``.csv`` or ``states``), one row per line;
* ``*.avro``     Avro containers (``fastavro`` when installed, else the
  built-in decoder), one row per record, its fields as a map of texts.

Columns: archive, member, line (text members), record (Avro members), fault,
position (number of the line or record in its member, from 1).
Bytes are decoded as UTF-8 with undecodable bytes dropped. One rule for broken
input, whatever the size or the path: a broken member ends with the last whole
line or record before the break, the other members are read, headers that
break off end the archive's list; each break gives one row with only ``fault``
set, so that a caller can count what is missing. Only format errors are such
breaks; an archive that is missing or cannot be read fails the task.

Line parsing (arity, header, padding) and alias names are left to
``accept_members``, so they run as JVM expressions. Paths may be anything
``pyarrow.fs`` opens (local, HDFS, object stores).

Usage::

    spark.dataSource.register(TarStatesDataSource)
    spark.read.format("tarstates").load("a.tar,b.tar")
    read_archive_members(paths_df)          # many archives: listed in tasks
"""

from __future__ import annotations

import gzip
import io
import struct
import tarfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import LongType, MapType, StringType, StructField, StructType

from flightlake.sources.avro_records import read_records

SCHEMA = StructType([StructField("archive", StringType()), StructField("member", StringType()),
                     StructField("line", StringType()),
                     StructField("record", MapType(StringType(), StringType())),
                     StructField("fault", StringType()), StructField("position", LongType())])
_ARROW = pa.schema([("archive", pa.string()), ("member", pa.string()), ("line", pa.string()),
                    ("record", pa.map_(pa.string(), pa.string())), ("fault", pa.string()), ("position", pa.int64())])
BATCH_ROWS = 10_000
BLOCK = 1 << 20
#: What broken tar, gzip, deflate and Avro data raise. (BadGzipFile is an
#: OSError; all other OSErrors are failed reads and are not caught.)
FORMAT_ERRORS = (tarfile.TarError, gzip.BadGzipFile, zlib.error, EOFError, ValueError, KeyError, IndexError,
                 struct.error, OverflowError)

Member = tuple[str, int, int]  # name, offset of its data, size


class ArchivePartition(InputPartition):
    """Some members of an archive, or all of them (listed by the task)."""

    def __init__(self, path: str, members: list[Member] | None = None):
        super().__init__(path)
        self.path = path
        self.members = members


def _filesystem(path: str):
    from pyarrow import fs
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[len("file:"):].lstrip("/")
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def open_archive(path: str):
    """A seekable file object for a local path or any URI that pyarrow knows."""
    filesystem, inner = _filesystem(path)
    return filesystem.open_input_file(inner)


def archive_size(path: str) -> int:
    """Size in bytes from file-system metadata (no data read)."""
    filesystem, inner = _filesystem(path)
    size = filesystem.get_file_info(inner).size
    if size is None:
        raise FileNotFoundError(path)
    return size


def member_kind(name: str) -> str | None:
    low = name.lower()
    if low.endswith(".avro"):
        return "avro"
    if low.endswith(".csv.gz") or low.endswith(".gz"):
        return "gz"
    if ".csv" in low or "states" in low:
        return "csv"
    return None


def list_members(path: str) -> tuple[list[Member], str | None]:
    """Readable members from the headers, and the fault that ended the list."""
    found: list[Member] = []
    with open_archive(path) as raw:
        try:
            with tarfile.open(fileobj=raw, mode="r:") as tar:
                for m in tar:
                    if m.isfile() and member_kind(m.name):
                        found.append((m.name, m.offset_data, m.size))
                end = tar.offset
            # After the first member, tarfile takes a broken header for the end.
            raw.seek(end)
            header = raw.read(tarfile.BLOCKSIZE)
            if header and header != tarfile.NUL * tarfile.BLOCKSIZE:
                raise tarfile.ReadError(f"broken header at byte {end}")
        except FORMAT_ERRORS as e:
            return found, repr(e)
    return found, None


class _Slice(io.RawIOBase):
    """Read-only view of ``size`` bytes of ``f`` from ``offset`` on."""

    def __init__(self, f, offset: int, size: int):
        f.seek(offset)
        self.f, self.left = f, size

    def readable(self):
        return True

    def readinto(self, b):
        data = self.f.read(min(len(b), self.left))
        b[:len(data)] = data
        self.left -= len(data)
        return len(data)


def _line_blocks(stream) -> Iterator[list[str]]:
    """Lines of a byte stream, many at a time. The bytes after the last line
    end are a line only if the stream ends well."""
    rest = b""
    while block := stream.read1(BLOCK):
        whole, end, tail = block.rpartition(b"\n")
        if not end:
            rest += block
            continue
        lines = (rest + whole).decode("utf-8", errors="ignore").split("\n")
        rest = tail
        yield [x.rstrip("\r") for x in lines]
    if rest:
        yield [rest.decode("utf-8", errors="ignore").rstrip("\r")]


def _avro_records(f) -> Iterator[dict]:
    try:
        import fastavro  # optional, faster
        return iter(fastavro.reader(f))
    except ImportError:
        return read_records(f)


def _rows(archive: str, member: str | None, lines=None, records=None, fault: str | None = None,
          before: int = 0) -> pa.RecordBatch:
    n = len(lines) if lines is not None else len(records) if records is not None else 1
    position = [None] * n if fault else range(before + 1, before + n + 1)
    columns = [[archive] * n, [member] * n, lines or [None] * n, records or [None] * n, [fault] * n, position]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _ARROW.types)], schema=_ARROW)


def read_member(raw, archive: str, member: Member) -> Iterator[pa.RecordBatch]:
    """The rows of one member; a break in it is its last row."""
    name, offset, size = member
    f = io.BufferedReader(_Slice(raw, offset, size))
    kind = member_kind(name)
    seen = 0
    try:
        if kind == "avro":
            batch: list[list[tuple[str, str]]] = []
            for rec in _avro_records(f):
                batch.append([(k, str(v)) for k, v in rec.items() if v is not None])
                if len(batch) == BATCH_ROWS:
                    yield _rows(archive, name, records=batch, before=seen)
                    seen += len(batch)
                    batch = []
            if batch:
                yield _rows(archive, name, records=batch, before=seen)
            return
        counted = _Counted(f) if kind == "csv" else gzip.GzipFile(fileobj=f)
        for lines in _line_blocks(counted):
            for i in range(0, len(lines), BATCH_ROWS):
                yield _rows(archive, name, lines=lines[i:i + BATCH_ROWS], before=seen + i)
            seen += len(lines)
        if kind == "csv" and counted.seen < size:
            raise EOFError(f"{counted.seen} bytes of {size}")
    except FORMAT_ERRORS as e:
        yield _rows(archive, name, fault=repr(e))


class _Counted:
    """``read1`` that counts, to tell a cut-off plain member from a whole one."""

    def __init__(self, f):
        self.f, self.seen = f, 0

    def read1(self, n: int) -> bytes:
        data = self.f.read1(n)
        self.seen += len(data)
        return data


def read_members(archive: str, members: list[Member]) -> Iterator[pa.RecordBatch]:
    with open_archive(archive) as raw:
        for member in members:
            yield from read_member(raw, archive, member)


def read_archive(archive: str) -> Iterator[pa.RecordBatch]:
    members, fault = list_members(archive)
    yield from read_members(archive, members)
    if fault:
        yield _rows(archive, None, fault=fault)


def plan_partitions(paths: list[str], target_bytes: int) -> list[ArchivePartition]:
    """Members of a large archive grouped up to ``target_bytes`` per partition.

    Archives up to ``target_bytes`` are one partition each and listed by their
    task; for larger ones the headers are read here. For very many large
    archives use ``read_archive_members``, which lists in tasks.
    """
    parts: list[ArchivePartition] = []
    for p in paths:
        members, fault = list_members(p) if archive_size(p) > target_bytes else ([], None)
        if not members or fault:
            parts.append(ArchivePartition(p))
            continue
        group: list[Member] = []
        size = 0
        for m in members:
            if group and size + m[2] > target_bytes:
                parts.append(ArchivePartition(p, group))
                group, size = [], 0
            group.append(m)
            size += m[2]
        parts.append(ArchivePartition(p, group))
    return parts


class TarStatesReader(DataSourceReader):
    def __init__(self, paths: list[str], split_members: bool, target_bytes: int):
        self.paths = paths
        self.split_members = split_members
        self.target_bytes = target_bytes

    def partitions(self):
        if not self.split_members:
            return [ArchivePartition(p) for p in self.paths]
        return plan_partitions(self.paths, self.target_bytes)

    def read(self, partition):
        if partition.members is None:
            yield from read_archive(partition.path)
        else:
            yield from read_members(partition.path, partition.members)


class TarStatesDataSource(DataSource):
    """Options: ``path`` (comma-separated archive paths) or ``paths``;
    ``splitMembers`` (default true): split archives into member groups of
    about ``partitionBytes`` (default 128 MiB) of member data."""

    @classmethod
    def name(cls):
        return "tarstates"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        raw = self.options.get("path") or self.options.get("paths") or ""
        paths = [p.strip() for p in raw.split(",") if p.strip()]
        if not paths:
            raise ValueError("tarstates needs at least one archive path")
        split = str(self.options.get("splitMembers", "true")).lower() != "false"
        target = int(self.options.get("partitionBytes", 128 * 1024 * 1024))
        return TarStatesReader(paths, split, target)


def register(spark) -> None:
    spark.dataSource.register(TarStatesDataSource)


# ------------------------------------------------------------------ distributed listing and reading

MEMBER_SCHEMA = "archive string, member string, offset long, size long, fault string"


def list_archive_members(archives: DataFrame, path_col: str = "path") -> DataFrame:
    """(archive, member, offset, size, fault) of every readable member, listed
    in tasks; a list that breaks off has one row with only ``fault`` set."""

    def listing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                members, fault = list_members(path)
                rows = [(path, n, o, z, None) for n, o, z in members]
                rows += [(path, None, None, None, fault)] if fault else []
                columns = list(zip(*rows)) or [()] * 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int64(), pa.int64(),
                                                              pa.string()))],
                    names=["archive", "member", "offset", "size", "fault"])

    return archives.select(path_col).mapInArrow(listing, MEMBER_SCHEMA)


def read_archive_members(archives: DataFrame, target_bytes: int = 128 * 1024 * 1024,
                         path_col: str = "path") -> DataFrame:
    """Rows of many archives with listing and reading in tasks; no path list
    passes through the driver.

    Members are dealt to ceil(all member bytes / ``target_bytes``) partitions,
    at least one for each eight members, so a few huge archives, many small
    ones and broken ones all spread.
    """
    members = list_archive_members(archives, path_col)
    total = members.agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("n")).first()
    n_parts = max(1, -(-int(total["b"] or 0) // target_bytes), -(-int(total["n"]) // 8))
    spread = members.repartition(n_parts, "archive", "member", "offset")

    def reading(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                if r["fault"]:
                    yield _rows(r["archive"], None, fault=r["fault"])
                else:
                    yield from read_members(r["archive"], [(r["member"], r["offset"], r["size"])])

    return spread.mapInArrow(reading, SCHEMA)
