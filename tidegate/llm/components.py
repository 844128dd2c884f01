"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _beside_least(edges: DataFrame) -> DataFrame:
    """Every edge (u, v) beside m, the least v of its u: one shuffle for both."""
    return edges.withColumn("m", F.min("v").over(Window.partitionBy("u")))


def _stars(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the node's least neighbour (large star). Edges may come twice, never more of them than before."""
    both = edges.select(F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("e")).select("e.u", "e.v")
    moved = _beside_least(both).where("v > u")
    return moved.select(F.col("v").alias("u"), F.least("u", "m").alias("v")).where("u <> v")


def _small_stars(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours all point to the least of them (small star)."""
    moved = _beside_least(edges).select(F.explode(F.array(F.struct(F.col("v").alias("u"), "m"), F.struct("u", "m"))).alias("e"))
    return moved.select(F.col("e.u").alias("u"), F.col("e.m").alias("v")).where("u <> v").distinct()


def connected_components(edges: DataFrame, store: Callable[[DataFrame, str], DataFrame], name: str) -> DataFrame:
    """(u, v) for every node that is not the least of its component: v is that least node.

    ``edges`` has columns u and v in any direction. The number of steps grows with the logarithm
    of the largest component's size; the edge table is stored after each, and only a count and a
    checksum of it reach the driver.
    """
    current = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v")
    seen, step = None, 0
    while True:
        step += 1
        current = store(_small_stars(_stars(current)), f"{name}-step-{step}")
        check = current.agg(F.count("*").alias("n"), F.expr("bit_xor(xxhash64(u, v))").alias("x")).first()
        if check["n"] == 0 or (check["n"], check["x"]) == seen:
            return current
        seen = (check["n"], check["x"])
