"""Scans, sinks and schemas."""

from ratecraft.sources.tables import load_tables, table
from ratecraft.sources.readers import read_csv, read_json, read_table, read_parquet, profile, preview
from ratecraft.sources.writers import write_scores, read_scores, ModelStore

__all__ = [
    "load_tables", "table", "read_csv", "read_json", "read_table", "read_parquet",
    "profile", "preview", "write_scores", "read_scores", "ModelStore",
]
