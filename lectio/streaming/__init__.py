"""Incremental landing of feed files with Structured Streaming."""

from lectio.streaming.ingest import ingest_feed_stream

__all__ = ["ingest_feed_stream"]
