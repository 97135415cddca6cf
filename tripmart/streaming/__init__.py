"""Structured Streaming: incremental ingest of newly landed month files."""

from tripmart.streaming.ingest import landing_schema, start_ingest  # noqa: F401
