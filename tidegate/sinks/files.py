"""Folder sinks."""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tidegate.operators.shape import CORRUPT, IMPORT_KEYS, MISFITS, date_parts

LOADED, QUARANTINED = "loaded", "quarantined"
LOAD = "load"
# Which of a document's arrays a row comes from, where they are loaded separately.
CHILD = "child"


def check_load_id(load_id: str) -> str:
    """Load ids become folder names."""
    if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9_.\-]*", load_id):
        raise ValueError(f"load id {load_id!r} is not usable as a folder name")
    return load_id


def write_parquet(df: DataFrame, path: str, mode: str = "append", partition_by: Sequence[str] = ()) -> None:
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)


def write_dated(
    df: DataFrame, path: str, day: Column, keys: Sequence[str] = IMPORT_KEYS, mode: str = "append"
) -> None:
    """Year / month / day / date folders.

    The rebalance lets adaptive execution gather a small day into few files and
    split a day that holds much of the data over many tasks.
    """
    dated = date_parts(df, day, keys)
    write_parquet(dated.hint("rebalance", F.col(keys[-1])), path, mode, keys)


def dated_folder(prefix: str, day: date, keys: Sequence[str] = IMPORT_KEYS) -> str:
    """The folder of one day in a dated layout."""
    layouts = ("%Y", "%m", "%d", "%Y%m%d")
    return f"{prefix.rstrip('/')}/" + "".join(f"{key}={day.strftime(layout)}/" for key, layout in zip(keys, layouts))


def overwrite_partitions(df: DataFrame, path: str, keys: Sequence[str]) -> None:
    """Replace the partitions that occur in ``df`` and leave all others alone."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", single_file: bool = False, **options) -> None:
    """CSV with a header. One file means one writing task, so it is only done on request."""
    (df.coalesce(1) if single_file else df).write.mode(mode).options(header=True, **options).csv(path)


def append_table(df: DataFrame, table: str, load_id: str) -> None:
    """Rows of one load into a catalog table, as its partition ``load``.

    The partition is replaced as a whole, so a load that is run again is in the
    table once. A table that was made without this partition is refused.
    """
    spark, load = df.sparkSession, check_load_id(load_id)
    if not spark.catalog.tableExists(table):
        df.limit(0).withColumn(LOAD, F.lit(load)).write.partitionBy(LOAD).format("parquet").saveAsTable(table)
    known = spark.table(table).columns
    if LOAD not in known:
        raise ValueError(f"table {table} has no column {LOAD!r}, so a repeated load could not be told from a new one")
    rows = df.select(*[name for name in known if name != LOAD])
    spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION ({LOAD} = '{load}') SELECT * FROM {{rows}}", rows=rows)


def load_folder(root: str, load_id: str) -> str:
    return f"{root.rstrip('/')}/load={check_load_id(load_id)}"


def write_load(df: DataFrame, root: str, load_id: str, flag: str) -> str:
    """Write loaded and quarantined rows of one load in a single job; rows of separate arrays in folders of their own.

    The load owns its folder and replaces it as a whole, so running the same load
    again neither doubles rows nor leaves old ones behind.
    """
    folder = load_folder(root, load_id)
    status = F.when(F.col(flag), QUARANTINED).otherwise(LOADED)
    (
        df.withColumn("load_status", status).drop(flag)
        .write.mode("overwrite").option("partitionOverwriteMode", "static")
        .partitionBy("load_status", *([CHILD] if CHILD in df.columns else [])).parquet(folder)
    )
    return folder


def quarantine_folder(root: str, load_id: str) -> str:
    return f"{load_folder(root, load_id)}/load_status={QUARANTINED}"


def read_loads(
    spark: SparkSession,
    root: str,
    status: str = LOADED,
    load_id: str | None = None,
    schema: str | StructType | None = None,
) -> DataFrame:
    """Rows of all loads (or one) with a status; only their folders are read."""
    reader = spark.read
    if schema is not None:
        fields = schema if isinstance(schema, str) else schema.toDDL()
        reader = reader.schema(f"{fields}, load_status string")
    rows = reader.parquet(root if load_id is None else load_folder(root, load_id))
    rows = rows.where(F.col("load_status") == status).drop("load", "load_status")
    return rows.drop(CORRUPT, MISFITS) if status == LOADED else rows


def count_corrupt(spark: SparkSession, folder: str) -> int:
    """Quarantined rows that keep the text of what could not be parsed; only that column is read."""
    return spark.read.schema(f"{CORRUPT} string").parquet(folder).where(F.col(CORRUPT).isNotNull()).count()


def count_misfits(spark: SparkSession, folder: str) -> dict[str, int]:
    """Quarantined rows by the column whose value does not fit; only that list of names is read.

    They are counted in what was written and not while it was, so a task that ran twice counts once.
    """
    names = spark.read.schema(f"{MISFITS} array<string>").parquet(folder).select(F.explode(MISFITS).alias("name"))
    return {row["name"]: row["count"] for row in names.groupBy("name").count().collect()}


def count_load(spark: SparkSession, folder: str) -> dict[str, int]:
    """Rows per status of a written load, from the file footers."""
    rows = spark.read.schema("load_status string").parquet(folder).groupBy("load_status").count().collect()
    found = {row["load_status"]: row["count"] for row in rows}
    return {LOADED: found.get(LOADED, 0), QUARANTINED: found.get(QUARANTINED, 0)}
