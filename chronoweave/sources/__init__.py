"""Readers and writers: CSV tag files, Parquet tag tables, JDBC, the dataset store."""

from chronoweave.sources.registry import read_source

__all__ = ["read_source"]
