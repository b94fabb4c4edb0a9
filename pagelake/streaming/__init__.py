"""Structured Streaming landing of response files (an addition to the batch ingest)."""

from pagelake.streaming.landing import ingest_landed, page_file_stream, start_landing, stream_locations

__all__ = ["ingest_landed", "page_file_stream", "start_landing", "stream_locations"]
