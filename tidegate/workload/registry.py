from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


class Tables:
    """The parquet tables of one folder, by attribute."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(os.path.join(self.folder, f"{name}.parquet"))


def query(name: str, sql: str | None = None):
    """Register ``function(tables)`` under a name, with the SQL that gives the same rows."""
    def add(function: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, folder: function(Tables(spark, folder))
        if sql is not None:
            SQL[name] = sql
        return function

    return add
