"""Incremental reads: which dated folders are newer than the last one processed."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidegate.functions import import_date, parent_folder
from tidegate.operators.shape import IMPORT_KEYS
from tidegate.session import folder_names
from tidegate.sources.files import Paths, list_files
from tidegate.sources.routing import key_below


def folders_after(paths: DataFrame, path_column: str, after: str | int, dated: Column | None = None) -> DataFrame:
    """Distinct folders whose import date is later than ``after``, in ascending order.

    The date is looked for in ``dated``, or in the whole path. Paths without a date are left out.
    The duplicate drop runs map-side first, so only folders are shuffled and sorted, not files.
    """
    path = F.col(path_column)
    return (
        paths.where(import_date(path if dated is None else dated).try_cast("int") > F.lit(int(after)))
        .select(parent_folder(path).alias("folder"))
        .distinct()
        .orderBy("folder")
    )


def rows_after(dated: DataFrame, after: str | int, column: str = "import_date") -> DataFrame:
    """Rows of a dated layout that are later than ``after``; older folders are not listed for reading."""
    return dated.where(F.col(column).try_cast("int") > F.lit(int(after)))


def list_folders_after(spark: SparkSession, root: Paths, after: str | int, modified_after: str | None = None) -> DataFrame:
    """Dated folders, in any layout, from the listing of all files below a root.

    Digits of the root itself are no date. ``modified_after`` (a timestamp) leaves older files out
    of the listing's result. For folders of a dated layout see :func:`dated_folders_after`.
    """
    files = list_files(spark, root, modified_after=modified_after)
    return folders_after(files, "path", after, key_below(root, F.col("path")) if isinstance(root, str) else None)


def dated_folders_after(spark: SparkSession, root: str, after: str | int, keys: Sequence[str] = IMPORT_KEYS) -> DataFrame:
    """Day folders of a dated layout (year, month, day, date) that are later than ``after``, in ascending order.

    The layout is gone down level by level: only names are listed, and only in folders that can
    hold a later day. Older years, months and days are not listed, whatever they hold. What the
    driver holds is a name for each later day.
    """
    day = f"{int(after):08d}"

    def later(folder: str, level: int, known: str) -> Iterator[str]:
        for name in sorted(folder_names(spark, folder)):
            key, _, value = name.partition("=")
            if key != keys[level] or not value.isdigit():
                continue
            if level == len(keys) - 1:
                if value > day:
                    yield f"{folder}/{name}"
            elif known + value >= day[:len(known + value)]:
                yield from later(f"{folder}/{name}", level + 1, known + value)

    return spark.createDataFrame([(folder,) for folder in later(root.rstrip("/"), 0, "")], "folder string")
