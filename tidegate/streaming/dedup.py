"""Duplicates across files, dropped while they stream in."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


SALT = "__salt"


def drop_stream_duplicates(
    df: DataFrame,
    keys: Sequence[str] | None = None,
    event_time: str | None = None,
    within: str = "1 day",
    salts: int = 0,
) -> DataFrame:
    """First occurrence of each row (or key).

    Without an event time the state keeps every key for ever; with one it forgets
    keys that are older than ``within``.

    A stream has no map-side aggregate, so all copies of a key reach one task.
    With ``salts`` they are first dropped per key and salt (the input split,
    folded), which leaves at most that many for the task of the key.
    """
    columns = list(keys) if keys else df.columns
    if event_time is not None:
        df = df.withWatermark(event_time, within)

    def drop(rows: DataFrame, by: list[str]) -> DataFrame:
        return rows.dropDuplicates(by) if event_time is None else rows.dropDuplicatesWithinWatermark(by)

    if salts:
        df = drop(df.withColumn(SALT, F.spark_partition_id() % salts), [*columns, SALT]).drop(SALT)
    return drop(df, columns)
