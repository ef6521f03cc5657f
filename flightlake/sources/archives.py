"""Archive sink: state vectors -> tar archives of gzipped CSV (inverse of ``tarstates``).

Each Spark task writes the archives for its own partition straight into a
shared folder, one after the other: an archive is closed when it holds
``max_bytes`` of text, so a task keeps one compressed member in memory whatever
the size of its partition. The result is a DataFrame of the archives' paths.
"""

from __future__ import annotations

import io
import tarfile
import uuid
import zlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightlake.schemas import STATE_COLUMNS
from flightlake.session import ensure_checkpoint_dir
from flightlake.sources.tarstates import _filesystem


def _write_bytes(path: str, data: bytes) -> None:
    filesystem, inner = _filesystem(path)
    filesystem.create_dir(inner.rpartition("/")[0], recursive=True)
    with filesystem.open_output_stream(inner) as out:
        out.write(data)


def _archive(name: str, payload: bytes) -> bytes:
    buf = io.BytesIO()
    with tarfile.open(fileobj=buf, mode="w") as tar:
        info = tarfile.TarInfo(name=name)
        info.size = len(payload)
        tar.addfile(info, io.BytesIO(payload))
    return buf.getvalue()


def write_state_archives(df: DataFrame, root: str | None = None, header: bool = True,
                         num_archives: int | None = None, max_bytes: int = 64 << 20) -> DataFrame:
    """Write ``states_<part>_<n>.csv.tar`` archives (a single ``.csv.gz`` member
    each, a missing value as empty text) and return their paths.

    ``num_archives`` deals the rows to that many tasks first; an empty partition
    writes nothing. The archives are written when the result is evaluated and
    again (with the same names) whenever it is evaluated anew. A root without a
    scheme is a local folder and refused unless the master is local.
    """
    spark = df.sparkSession
    if root and "://" not in root and not root.startswith("file:") and not spark.sparkContext.master.startswith("local"):
        raise ValueError("give the archives' root with a scheme: a plain path is another folder on each executor")
    if num_archives:
        df = df.repartition(num_archives)
    base = (root or f"{ensure_checkpoint_dir(spark).rstrip('/')}/archives-{uuid.uuid4().hex}").rstrip("/")
    cols = [c for c in STATE_COLUMNS if c in df.columns]
    text = df.select(F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols]).alias("line"))
    first = (",".join(cols) + "\n").encode() if header else b""

    def write(batches):
        import pandas as pd
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        number, size, packer, parts = 0, 0, None, []

        def close() -> str:
            payload = b"".join(parts) + packer.flush()
            path = f"{base}/states_{part:05d}_{number:03d}.csv.tar"
            _write_bytes(path, _archive(f"states_{part:05d}_{number:03d}.csv.gz", payload))
            return path

        for pdf in batches:
            if not len(pdf):
                continue
            if packer is None:
                packer, parts, size = zlib.compressobj(6, zlib.DEFLATED, 31), [], 0
                parts.append(packer.compress(first))
            data = ("\n".join(pdf["line"]) + "\n").encode("utf-8")
            parts.append(packer.compress(data))
            size += len(data)
            if size >= max_bytes:
                yield pd.DataFrame({"path": [close()]})
                packer, number = None, number + 1
        if packer is not None:
            yield pd.DataFrame({"path": [close()]})

    return text.mapInPandas(write, "path string")
