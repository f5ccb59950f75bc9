"""Scans, named sources and the change logs derived from the test tables."""

from tidemark.sources.parquet import probe_path, probe_table, read_delivery, read_generations, read_parquet, widen
from tidemark.sources.registry import Sources

__all__ = ["Sources", "probe_path", "probe_table", "read_delivery", "read_generations", "read_parquet", "widen"]
