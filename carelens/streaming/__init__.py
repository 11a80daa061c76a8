"""Incremental ingest (S6) with Structured Streaming."""

from carelens.streaming.incremental import gold_incremental, ingest_incremental

__all__ = ["gold_incremental", "ingest_incremental"]
