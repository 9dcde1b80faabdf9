"""Schemas, readers and Parquet tables."""
