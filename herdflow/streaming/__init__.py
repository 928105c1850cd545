"""Structured Streaming operators."""

from herdflow.streaming.streams import (daily_counts_stream, dedup_stream, event_time,
                                        ingest_stream, read_latest, run_available,
                                        upsert_stream, versioned_batch_writer)

__all__ = [
    "daily_counts_stream", "dedup_stream", "event_time", "ingest_stream", "read_latest",
    "run_available", "upsert_stream", "versioned_batch_writer",
]
