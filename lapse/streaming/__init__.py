"""Structured Streaming forms of the ledger operators (incremental ledger files)."""

from lapse.streaming.ledger import dedup_stream, read_ledger_stream, start_sink, volume_stream

__all__ = ["read_ledger_stream", "dedup_stream", "volume_stream", "start_sink"]
