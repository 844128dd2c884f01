"""The daily load: a stage slice merged into a versioned table.

Rows are written once and never moved. A load writes the parts its keys live in (current rows, by a
business column) and the versions it closes below its own folder, and then switches the parts
table, a small one that says which load holds each part:

    load=<id>/version=current/part=<value>    load=<id>/version=archive/part=all    _parts/<number>

Readers and the next load take their paths from the latest parts table. A load therefore reads
the parts that its stage names and nothing else: other parts, parts that were replaced and the
archive are not even listed. Readers that began before a switch go on reading what they began
with. ``remove_replaced`` deletes what neither the latest parts table nor the one before names.

A load goes in steps, each written in full before the next: the changes, the parts as they will
be, the parts table, which is made beside the others and renamed. It names every load that was
applied, so a load that is run again goes on at the first step that is not complete, and one that
was applied stays as it is, also where later loads followed. Loads of one table run one after the
other; the rename has to be atomic in the file system, as HDFS has it.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidegate.operators import history as ops
from tidegate.operators.flatten import quoted
from tidegate.operators.shape import CURRENT_FLAG
from tidegate.session import folder_names, path_exists, remove_folder, rename_folder, sized_shuffles
from tidegate.sinks.files import check_load_id
from tidegate.sources.database import Database
from tidegate.sources.files import list_files, literal_path
from tidegate.spec import HistorySpec

PART = "part"
VERSION, CURRENT, ARCHIVE = "version", "current", "archive"
WRITTEN = ("flag_del", "last_updt_dt", "change")
FIRST = "initial"
PARTS_TABLE = "_parts"
# A row for each part with the load that holds it; a row without a part for each load, and whether it closed versions.
PARTS_SCHEMA = "part string, load string, archived boolean"


@dataclass(frozen=True)
class HistoryResult:
    job_id: str
    changes_path: str
    new: int
    updated: int
    expired: int


def part_column(spec: HistorySpec) -> Column:
    """Where a current row is kept."""
    if spec.partition_column is None:
        return F.lit("all")
    # The prefix tells an empty text from no value.
    return F.coalesce(F.concat(F.lit("at-"), quoted((spec.partition_column,)).cast("string")), F.lit("none"))


def parts_number(spark: SparkSession, path: str) -> int | None:
    """The number of the latest parts table; None before the first load."""
    numbers = [int(name) for name in folder_names(spark, f"{path.rstrip('/')}/{PARTS_TABLE}") if name.isdigit()]
    return max(numbers, default=None)


def read_parts(spark: SparkSession, path: str, number: int | None) -> DataFrame:
    if number is None:
        return spark.createDataFrame([], PARTS_SCHEMA)
    return spark.read.schema(PARTS_SCHEMA).parquet(f"{path.rstrip('/')}/{PARTS_TABLE}/{number}")


def _part_folders(spark: SparkSession, path: str, rows: DataFrame) -> list[str]:
    """Folders of parts, as the writer names them. A scan's paths are the driver's in any case."""
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    return [
        f"{path.rstrip('/')}/load={row['load']}/{VERSION}={CURRENT}/{PART}={escape(row['part'])}"
        for row in rows.where(F.col(PART).isNotNull()).select("load", PART).toLocalIterator()
    ]


def _archive_folders(path: str, rows: DataFrame) -> list[str]:
    return [f"{path.rstrip('/')}/load={row['load']}/{VERSION}={ARCHIVE}/{PART}=all" for row in rows.where("archived").select("load").toLocalIterator()]


def _read(spark: SparkSession, folders: Iterable[str], columns: StructType | None = None) -> DataFrame:
    """Rows of folders; without any, a table without rows."""
    folders = list(map(literal_path, folders))
    if folders:  # each is named in full, so folder names are not read as columns
        return spark.read.parquet(*folders)
    return spark.createDataFrame([], _with_strings(columns or StructType(), "flag_del", "last_updt_dt"))


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """All versions, current and expired."""
    parts = read_parts(spark, path, parts_number(spark, path))
    return _read(spark, [*_part_folders(spark, path, parts), *_archive_folders(path, parts)])


def read_current(spark: SparkSession, path: str, only: DataFrame | None = None, columns: StructType | None = None) -> DataFrame:
    """Current versions; of the parts that ``only`` names, where it is given."""
    parts = read_parts(spark, path, parts_number(spark, path))
    if only is not None:
        parts = parts.join(only, PART, "left_semi")
    return _read(spark, _part_folders(spark, path, parts), columns)


def _with_strings(columns: StructType, *names: str) -> StructType:
    return StructType([*columns.fields, *(StructField(name, StringType()) for name in names)])


def write_versions(rows: DataFrame, path: str, spec: HistorySpec, load: str) -> None:
    """Write a load's rows below its folder, in one job: current ones by part, expired ones apart."""
    is_current = F.col("flag_del") == CURRENT_FLAG
    placed = rows.withColumns({
        VERSION: F.when(is_current, CURRENT).otherwise(ARCHIVE), PART: F.when(is_current, part_column(spec)).otherwise("all"),
    })
    with sized_shuffles(placed):
        (
            placed.hint("rebalance", F.col(VERSION), F.col(PART))
            .write.mode("overwrite").option("partitionOverwriteMode", "static")
            .partitionBy(VERSION, PART).parquet(f"{path.rstrip('/')}/load={check_load_id(load)}")
        )


def switch_parts(spark: SparkSession, path: str, touched: DataFrame, load: str, archived: bool) -> None:
    """Let the parts that a load wrote be read from its folder, by one rename."""
    number = parts_number(spark, path)
    before = read_parts(spark, path, number)
    kept = before.join(touched, PART, "left_anti")
    own = touched.select(PART, F.lit(load).alias("load"), F.lit(None).cast("boolean").alias("archived"))
    mark = spark.createDataFrame([(None, load, archived)], PARTS_SCHEMA)
    root = f"{path.rstrip('/')}/{PARTS_TABLE}"
    kept.unionByName(own).unionByName(mark).write.mode("overwrite").parquet(f"{root}/next-{load}")
    number = 0 if number is None else number + 1
    rename_folder(spark, f"{root}/next-{load}", f"{root}/{number}")
    remove_folder(spark, f"{root}/{number - 2}")


def create_history(rows: DataFrame, path: str, spec: HistorySpec) -> None:
    """Write a first history from rows that have their version columns."""
    spark = rows.sparkSession
    if parts_number(spark, path) is not None:
        raise ValueError(f"there is a history at {path} already")
    write_versions(rows, path, spec, FIRST)
    written = spark.read.schema(f"{VERSION} string, {PART} string").parquet(f"{path.rstrip('/')}/load={FIRST}").distinct()
    archived = not written.where(F.col(VERSION) == ARCHIVE).isEmpty()
    switch_parts(spark, path, written.where(F.col(VERSION) == CURRENT).select(PART), FIRST, archived)


def write_changes(
    spark: SparkSession, stage: DataFrame, path: str, spec: HistorySpec, run_date: str, folder: str
) -> None:
    """Compute a run's changes and write them, one folder per kind.

    The day's totals are written before they are joined: their size is then known
    from their files, and Spark broadcasts them only below its own threshold. A key
    lives in the part it names, so the totals' parts are all that is compared.
    """
    totals_path = f"{folder}/totals"
    with sized_shuffles(stage):
        stage.write.mode("overwrite").parquet(totals_path)
    totals = spark.read.schema(stage.schema).parquet(totals_path)
    current = read_current(spark, path, totals.select(part_column(spec).alias(PART)).distinct(), stage.schema)
    changes = ops.history_changes(totals, current, spec.keys, spec.value, run_date, spec.key_style)
    with sized_shuffles(changes):
        (
            changes.write.mode("overwrite").option("partitionOverwriteMode", "static")
            .partitionBy("change").parquet(f"{folder}/changes")
        )


def touched_parts(changes: DataFrame, spec: HistorySpec) -> DataFrame:
    return changes.select(part_column(spec).alias(PART)).distinct()


def write_parts(spark: SparkSession, path: str, spec: HistorySpec, changes: DataFrame, job_id: str) -> None:
    """Write the touched parts as they will be, expired versions out and new ones in, and the expired ones apart."""
    columns = StructType([field for field in changes.schema.fields if field.name not in WRITTEN])
    current = read_current(spark, path, touched_parts(changes, spec), columns)
    expired = changes.where(F.col("change") == "expired")
    # An expired row carries the keys of the version it closes, so they are compared one by one in any key style.
    keys = expired.select(*[quoted((key,)) for key in spec.keys])
    kept = current.alias("h").join(keys.alias("e"), ops.same_key(spec.keys, "h", "e"), "left_anti")
    write_versions(kept.unionByName(ops.conform(changes, current.schema)), path, spec, job_id)


def load_history(
    spark: SparkSession,
    stage: DataFrame,
    path: str,
    spec: HistorySpec,
    run_date: str,
    job_id: str,
    export: str,
) -> HistoryResult:
    """Merge a stage slice into the history at ``path``; stage rows of one key are summed.

    New, updated and expired rows stay under ``export`` for readers downstream.
    Loads of one table run one after the other.
    """
    spec.validate()
    folder = f"{export.rstrip('/')}/load={check_load_id(job_id)}"
    if job_id == FIRST:
        raise ValueError(f"{FIRST!r} is the id of a history's first rows")
    totals = ops.grouped_sum(stage, spec.keys, spec.value, spec.value_type, spec.key_style)
    if not path_exists(spark, f"{folder}/changes/_SUCCESS"):
        write_changes(spark, totals, path, spec, run_date, folder)
    changes = read_changes(spark, totals, folder)
    counts = {row["change"]: row["count"] for row in changes.groupBy("change").count().collect()}
    if counts and not is_applied(spark, path, job_id):
        if not path_exists(spark, f"{path.rstrip('/')}/load={job_id}/_SUCCESS"):
            write_parts(spark, path, spec, changes, job_id)
        switch_parts(spark, path, touched_parts(changes, spec), job_id, "expired" in counts)
    return HistoryResult(
        job_id, f"{folder}/changes", counts.get("new", 0), counts.get("updated", 0), counts.get("expired", 0)
    )


def is_applied(spark: SparkSession, path: str, job_id: str) -> bool:
    """Whether the parts table knows a load, whatever followed it."""
    parts = read_parts(spark, path, parts_number(spark, path))
    return not parts.where(F.col(PART).isNull() & (F.col("load") == job_id)).isEmpty()


def remove_replaced(spark: SparkSession, path: str) -> int:
    """Delete part folders that neither the latest parts table nor the one before names; gives their number.

    Run it while no load of the table is running.
    """
    number = parts_number(spark, path)
    if number is None:
        return 0
    named = read_parts(spark, path, number).unionByName(read_parts(spark, path, number - 1 if number else None))
    pattern = rf"(/load=[^/]+/{VERSION}={CURRENT}/{PART}=[^/]+)/"
    there = list_files(spark, path).select(F.regexp_extract("path", pattern, 1).alias("place")).where("place <> ''").distinct()
    escape = {folder[len(path.rstrip("/")):] for folder in _part_folders(spark, path, named)}
    gone = [row["place"] for row in there.toLocalIterator() if row["place"] not in escape]
    for place in gone:
        remove_folder(spark, f"{path.rstrip('/')}{place}")
    return len(gone)


def read_changes(spark: SparkSession, totals: DataFrame, folder: str) -> DataFrame:
    return spark.read.schema(_with_strings(totals.schema, *WRITTEN)).parquet(f"{folder}/changes")


def publish_changes(changes: DataFrame, database: Database, table: str, work_table: str) -> None:
    """Bring a run's changes to a history table in a database.

    New versions are appended. Expired ones replace the rows of a work table, from
    which one joined UPDATE in the database closes them all, instead of one per row.
    """
    added = changes.where(F.col("change").isin("new", "updated")).drop("change")
    database.write(changes.where(F.col("change") == "expired").drop("change"), work_table, "overwrite")
    database.write(added, table, "append")
