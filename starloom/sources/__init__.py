"""Readers: JSON, CSV, parquet, code listings, and staged JSON loads."""
