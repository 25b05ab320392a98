"""Structured Streaming intake jobs (survey S1, S2)."""

from ledgerline.streaming.intake import accepted, files_per_batch, first_rows, rejected, stream_first_by_key, stream_records  # noqa: F401
