"""Incremental ingestion of the landing zone with Structured Streaming."""

from ledgerlake.streaming.landing import transcript_measures_stream

__all__ = ["transcript_measures_stream"]
