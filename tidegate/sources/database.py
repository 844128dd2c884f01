"""Database scans and appends through Spark's JDBC data source.

Connection details always come from the caller.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class ReadRange:
    """How to cut a table scan into parallel ranges of one numeric or date column."""

    column: str
    lower: str | int
    upper: str | int
    partitions: int

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": str(self.lower),
            "upperBound": str(self.upper),
            "numPartitions": str(self.partitions),
        }


@dataclass(frozen=True)
class Database:
    url: str
    properties: Mapping[str, str] = field(default_factory=dict, repr=False)

    def options(self, **more: str) -> dict[str, str]:
        return {"url": self.url, **self.properties, **more}

    def scan_options(self, table: str, ranges: ReadRange | None = None) -> dict[str, str]:
        return self.options(dbtable=table, **(ranges.options() if ranges else {}))

    def write_options(self, table: str, mode: str, connections: int) -> dict[str, str]:
        """``overwrite`` empties the table and keeps its definition."""
        more = {"truncate": "true"} if mode == "overwrite" else {}
        return self.options(dbtable=table, numPartitions=str(connections), batchsize="10000", **more)

    def table(self, spark: SparkSession, name: str, ranges: ReadRange | None = None) -> DataFrame:
        """A whole table; filters, columns and aggregates that Spark can push down run in the database."""
        return spark.read.format("jdbc").options(**self.scan_options(name, ranges)).load()

    def query(self, spark: SparkSession, sql: str) -> DataFrame:
        """The result of a query that the database evaluates."""
        return spark.read.format("jdbc").options(**self.options(query=sql)).load()

    def write(self, df: DataFrame, table: str, mode: str = "append", connections: int = 16) -> None:
        """Write through at most ``connections`` parallel connections."""
        df.write.format("jdbc").options(**self.write_options(table, mode, connections)).mode(mode).save()


def read_query(spark: SparkSession, sql: str, **parameters) -> DataFrame:
    """A query over catalog tables and views, with named parameters such as ``:load_date``."""
    return spark.sql(sql, args=parameters)
