"""Sinks: partitioned parquet / CSV / JSON payloads and the run catalogue."""
