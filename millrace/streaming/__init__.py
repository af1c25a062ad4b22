"""Incremental ingest with Structured Streaming."""

from millrace.streaming.inbox import stream_bronze, stream_csv, stream_outcomes, stream_silver

__all__ = ["stream_bronze", "stream_csv", "stream_outcomes", "stream_silver"]
