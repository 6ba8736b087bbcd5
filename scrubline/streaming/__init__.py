"""Structured Streaming ingestion and keyed sinks."""

from .ingest import (decode_stream, dedupe_stream, latest_by_key, read_sink, run_ingest,
                     run_upsert, stream_sink, to_sink_types, write_batch)
from .ledger import BatchLedger, ledger_against_sink, read_ledger
from .seen import SeenKeys, dedupe_lossless

__all__ = ["BatchLedger", "SeenKeys", "decode_stream", "dedupe_lossless", "dedupe_stream", "latest_by_key",
           "ledger_against_sink", "read_ledger",
           "read_sink", "run_ingest", "run_upsert", "stream_sink", "to_sink_types",
           "write_batch"]
