"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from tidegate.llm.files import join_path
from tidegate.session import new_folder


def storage(df: DataFrame, label: str) -> Callable[[DataFrame, str], DataFrame]:
    """A function that writes a frame under a name and reads it back. Cuts the lineage; a lost executor loses nothing of it."""
    spark = df.sparkSession
    folder = new_folder(spark, label)

    def store(frame: DataFrame, name: str) -> DataFrame:
        path = join_path(folder, name)
        frame.write.parquet(path)
        return spark.read.schema(frame.schema).parquet(path)

    return store


def unused(df: DataFrame, *stems: str) -> list[str]:
    """Column names that the frame does not have, for what is joined to it."""
    taken, out = {name.lower() for name in df.columns}, []
    for stem in stems:
        while stem.lower() in taken:
            stem += "_"
        out.append(stem)
    return out
