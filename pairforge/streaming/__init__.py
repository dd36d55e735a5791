"""Structured Streaming versions of the row-local operators."""

from .landing import read_landing, stream_losses, stream_pairs, stream_run_records

__all__ = ["read_landing", "stream_losses", "stream_pairs", "stream_run_records"]
