"""Sinks: parquet and CSV folders, catalog tables, the job audit log."""
