"""Scans and sinks (Parquet, CSV, JSON) and the adapters for the driver tables."""
