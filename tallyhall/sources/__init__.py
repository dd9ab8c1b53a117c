"""Readers: parquet / CSV / JSON / JDBC, snapshot selection, fixture adapter."""

from .readers import (read_table, latest_snapshot, read_export_csv,  # noqa: F401
                      read_site_list_json, jdbc_reader)
