"""Incremental feed ingestion with Structured Streaming."""

from staylake.streaming.feeds import ingest_feed, ingest_slices, latest_history

__all__ = ["ingest_feed", "ingest_slices", "latest_history"]
