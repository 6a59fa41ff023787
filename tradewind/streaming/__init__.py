"""Checkpointed file streams and incremental batch runs."""

from .incremental import Source, run_incremental
from .ingest import evolve_schema, ingest_stream, read_ingested, stream_to_table
from .tables import create_stream_table, stream_json_to_table, write_batch

__all__ = [
    "Source",
    "create_stream_table",
    "evolve_schema",
    "ingest_stream",
    "read_ingested",
    "run_incremental",
    "stream_json_to_table",
    "stream_to_table",
    "write_batch",
]
