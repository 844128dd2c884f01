"""Aggregates of the curated layer."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F


def last_value_pivot(
    df: DataFrame, key: str, category: str, order: str, value: str, outputs: Mapping[object, str]
) -> DataFrame:
    """Per key, the value with the highest ``order`` in each category, one column per category.

    All categories are taken in one hash aggregate whose buffers have a fixed
    size, so a key with very many rows is reduced map-side.
    """
    def last(member) -> Column:
        inside = F.col(category) == F.lit(member)
        return F.max_by(F.when(inside, F.col(value)), F.when(inside, F.col(order)))

    return df.groupBy(key).agg(*[last(member).alias(name) for member, name in outputs.items()])


def distinct_values(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns).distinct()
