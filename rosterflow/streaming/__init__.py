"""Streaming ingest."""

from rosterflow.streaming.landing import land_checked, land_stream, read_checked, stream_extracts

__all__ = ["land_checked", "land_stream", "read_checked", "stream_extracts"]
