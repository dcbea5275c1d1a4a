"""Incremental counterparts of batch operators, as Structured Streaming queries."""

from locuspark.streaming.jobs import (
    read_ingested,
    read_ledger,
    read_replication,
    stream_ingest,
    stream_ledger,
    stream_replication,
)

__all__ = [
    "read_ingested",
    "read_ledger",
    "read_replication",
    "stream_ingest",
    "stream_ledger",
    "stream_replication",
]
