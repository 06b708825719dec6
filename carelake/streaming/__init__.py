"""Structured Streaming ingest."""

from carelake.streaming.ingest import run_available, start_ingest

__all__ = ["run_available", "start_ingest"]
