"""Queries over the driver's tables, one or more per operator, each with its SQL twin."""

from tidegate.workload.registry import QUERIES, SQL, Tables
from tidegate.workload import curated, files, history, nested, rows, streams  # noqa: F401  (registers)

__all__ = ["QUERIES", "SQL", "Tables"]
