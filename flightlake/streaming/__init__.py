"""Structured Streaming forms of the batch jobs."""

from flightlake.streaming.ingest import ingest_stream, state_line_stream  # noqa: F401
