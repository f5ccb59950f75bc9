"""Structured Streaming form of the incremental load."""

from tidemark.streaming.arrivals import upsert_arrivals

__all__ = ["upsert_arrivals"]
