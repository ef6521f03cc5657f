"""State-file ingest as a Structured Streaming job (JB1, continuous form).

New state files (``.csv`` or ``.csv.gz``; the text source decompresses gzip)
landing in a folder are parsed with the same ``accept_rows`` / ``clean_states``
expressions as the batch ingest and appended to a Parquet run directory. The
stream is stateless, so it needs no watermark; progress (which files are
done) lives in a checkpoint under the shared ``spark.checkpoint.dir``, so a
restarted job resumes without re-reading or duplicating files.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from flightlake.operators.ingest import accept_rows, clean_states
from flightlake.session import ensure_checkpoint_dir


def state_line_stream(spark: SparkSession, source_dir: str, max_files_per_trigger: int | None = None,
                      glob: str = "*.csv*") -> DataFrame:
    """Streaming DataFrame of (source file, line) for files arriving in ``source_dir``."""
    r = spark.readStream.format("text").option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(source_dir).select(F.col("_metadata.file_path").alias("archive"), F.col("value").alias("line"))


def ingest_stream(spark: SparkSession, source_dir: str, out_dir: str, mode: str = "lenient",
                  checkpoint: str | None = None, available_now: bool = True,
                  max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the stream: lines -> accepted rows -> typed clean -> Parquet (append).

    ``available_now`` processes what is there and stops (batch-like runs);
    otherwise the query keeps watching the folder.
    """
    ckpt = checkpoint or f"{ensure_checkpoint_dir(spark).rstrip('/')}/ingest-{uuid.uuid4().hex}"
    lines = state_line_stream(spark, source_dir, max_files_per_trigger)
    states = clean_states(accept_rows(lines, mode=mode, line_col="line", keep=["archive"]))
    w = states.writeStream.format("parquet").option("checkpointLocation", ckpt).outputMode("append")
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start(out_dir)
