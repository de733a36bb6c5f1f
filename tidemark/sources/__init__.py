"""Readers and writers: file landing, variant flattening, parquet tables."""
