"""Session construction and cluster-shared folders."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import threading
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every session of ours wants; the cluster manager supplies the rest.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  driver_memory: str = "8g", extra: dict | None = None) -> SparkSession:
    """A local session for tests and the bench script (UI off, loopback host)."""
    b = (SparkSession.builder.master(f"local[{cores}]")
         .appName("flightlake")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", driver_memory)
         .config("spark.driver.host", "127.0.0.1")
         .config("spark.driver.bindAddress", "127.0.0.1"))
    for k, v in {**DEFAULT_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the folder must be configured (a shared file system path);
    only a local master gets a private temporary folder when none is set.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    path = tempfile.mkdtemp(prefix="flightlake-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    atexit.register(shutil.rmtree, path, ignore_errors=True)  # a private folder of a local run
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


#: Folders handed out by ``scratch_path`` in this process, with the thread that asked.
_WRITTEN: dict[str, int] = {}


def stored(df: DataFrame, name: str = "stored") -> DataFrame:
    """``df`` written once as a table under the shared checkpoint folder and
    read back: its lineage ends there and every executor sees the files."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stored_tables() -> list[str]:
    """Folders of intermediate tables that this thread has written and not dropped, in their order."""
    return [path for path, thread in _WRITTEN.items() if thread == threading.get_ident()]


def drop_stored(spark: SparkSession, tables: Iterable[str]) -> None:
    """Remove intermediate tables; what reads them must have been written elsewhere."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for path in list(tables):
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(conf).delete(target, True)
        _WRITTEN.pop(path, None)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_CLEANING, _CLEANING_LOCK = {"open": 0, "before": None}, threading.Lock()


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Inside, the shuffle files of a query go when it ends. Else they lie on the
    executors' disks until the driver happens to collect its garbage, those of all
    steps of a long job together. For queries that run once, such as those that
    write an intermediate table; what is to be returned is made outside."""
    with _CLEANING_LOCK:
        if not _CLEANING["open"]:
            _CLEANING["before"] = spark.conf.get(_CLEANUP, None)
            spark.conf.set(_CLEANUP, "true")
        _CLEANING["open"] += 1
    try:
        yield
    finally:
        with _CLEANING_LOCK:
            _CLEANING["open"] -= 1
            if not _CLEANING["open"]:
                if _CLEANING["before"] is None:
                    spark.conf.unset(_CLEANUP)
                else:
                    spark.conf.set(_CLEANUP, _CLEANING["before"])


def drop_stored_at_exit(spark: SparkSession) -> None:
    """Remove this process's intermediate tables when it ends with the session open."""
    if not getattr(drop_stored_at_exit, "registered", False):
        drop_stored_at_exit.registered = True
        atexit.register(lambda: spark.sparkContext._jsc is not None and drop_stored(spark, list(_WRITTEN)))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared checkpoint folder."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _WRITTEN[path] = threading.get_ident()
    drop_stored_at_exit(spark)
    return path
