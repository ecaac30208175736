"""Incremental (Structured Streaming) form of the daily feed ingest."""

from ratelake.streaming.feed_stream import ingest_new_feed_files

__all__ = ["ingest_new_feed_files"]
