"""Config-driven ingestion, data quality and history loads as plain Spark DataFrames."""

from tidegate.spec import DatasetSpec, HistorySpec, RuleSpec, SpecError

__all__ = ["DatasetSpec", "HistorySpec", "RuleSpec", "SpecError"]
