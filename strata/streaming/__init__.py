"""Incremental Bronze ingestion with Structured Streaming."""

from strata.streaming.bronze_stream import start_bronze_stream  # noqa: F401
