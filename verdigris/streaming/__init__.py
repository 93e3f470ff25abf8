"""Structured Streaming forms of ingest (P2) and scoring (P1)."""

from verdigris.streaming.streams import (  # noqa: F401
    ingest_once,
    ingest_stream,
    read_scored,
    score_stream,
    score_to_tables,
    stream_throughput,
)
