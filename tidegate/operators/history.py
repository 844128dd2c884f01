"""Versioned ("daily") tables: totals, key matching, and the changes of one run.

A history row is current (``flag_del = 'N'``) or expired (``'Y'``). A key has at
most one current row. Changes come from one join of the day's totals with the
current rows of the same keys.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from tidegate.functions import concat_key
from tidegate.operators.flatten import quoted
from tidegate.operators.shape import CURRENT_FLAG, EXPIRED_FLAG, OPEN_END, mark_current, mark_expired

VERSION_COLUMNS = ("flag_del", "last_updt_dt")


def load_slice(df: DataFrame, load_date: str | Column, column: str = "file_load_dt") -> DataFrame:
    """The rows that one load date brought in."""
    return df.where(F.col(column) == (load_date if isinstance(load_date, Column) else F.lit(load_date)))


def grouped_sum(
    df: DataFrame, keys: Sequence[str], value: str, value_type: str | None = None, key_style: str = "null_safe"
) -> DataFrame:
    """Sum of ``value`` per key, null keys grouped together. Rows are summed map-side before the shuffle.

    With a ``value_type`` values are summed as that type and the sum has it too. In
    the ``concat`` key style keys that join to one text are one key; it is written
    as the first of them in column order.
    """
    amount = quoted((value,))
    total = F.sum(amount) if value_type is None else F.sum(amount.cast(value_type)).cast(value_type)
    if key_style == "concat":
        first = F.min(F.struct(*[quoted((key,)) for key in keys]))
        joined = df.groupBy(concat_key([quoted((key,)) for key in keys]).alias("__text"))
        sums = joined.agg(first.alias("__keys"), total.alias("__total"))
        return sums.select("__keys.*", F.col("__total").alias(value))
    return df.groupBy(*[quoted((key,)) for key in keys]).agg(total.alias(value))


def same_key(keys: Sequence[str], left: str, right: str, style: str = "null_safe") -> Column:
    """Whether rows of two aliased frames have the same key.

    ``null_safe`` compares column by column, null equal to null. ``concat``
    compares the joined texts, in which nulls are left out.
    """
    if style == "concat":
        def text(alias: str) -> Column:
            return concat_key([quoted((alias, key)) for key in keys])

        return text(left) == text(right)
    pairs = (quoted((left, key)).eqNullSafe(quoted((right, key))) for key in keys)
    return reduce(lambda one, other: one & other, pairs)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """The columns of a schema, in its order and types."""
    return df.select(*[quoted((field.name,)).cast(field.dataType).alias(field.name) for field in schema.fields])


def current_rows(history: DataFrame) -> DataFrame:
    return history.where(F.col("flag_del") == CURRENT_FLAG)


def changed(new: Column, old: Column, null_aware: bool = False) -> Column:
    """``YES`` where two values differ, else ``NO``; a null differs from nothing unless ``null_aware``."""
    differs = ~new.eqNullSafe(old) if null_aware else new != old
    return F.when(differs, "YES").otherwise("NO")


def unknown_rows(stage: DataFrame, history: DataFrame, keys: Sequence[str], key_style: str = "null_safe") -> DataFrame:
    """Stage rows whose key the history has in no version.

    Versions of one key meet in a partial aggregate first, so a key with very many
    versions reaches the join as one row.
    """
    known = history.select(*[quoted((key,)) for key in keys]).distinct()
    return stage.alias("s").join(known.alias("h"), same_key(keys, "s", "h", key_style), "left_anti")


def compare_rows(stage: DataFrame, current: DataFrame, keys: Sequence[str], key_style: str = "null_safe") -> DataFrame:
    """Each stage row with the current row of its key, as two structs; ``old`` is null for a new key.

    The current rows are first reduced to the stage's keys. Where the stage is
    small, that is a broadcast of the stage and the history is never shuffled;
    where it is large, both joins use the same partitioning and share the shuffle.
    """
    keys = list(keys)
    touched = current.alias("h").join(
        stage.select(*[quoted((key,)) for key in keys]).alias("s"), same_key(keys, "h", "s", key_style), "left_semi"
    )
    return (
        stage.alias("s")
        .join(touched.withColumn("__known", F.lit(True)).alias("h"), same_key(keys, "s", "h", key_style), "left")
        .select(
            F.struct("s.*").alias("new"),
            F.when(F.col("h.__known"), F.struct(*[quoted(("h", name)) for name in current.columns])).alias("old"),
        )
    )


def _version(row: str, columns: Sequence[str], flag: str, day: Column, change: str) -> Column:
    return F.struct(
        *[quoted((row, name)).alias(name) for name in columns],
        F.lit(flag).alias("flag_del"),
        day.alias("last_updt_dt"),
        F.lit(change).alias("change"),
    )


def history_changes(
    stage: DataFrame,
    history: DataFrame,
    keys: Sequence[str],
    value: str,
    run_date: str | Column,
    key_style: str = "null_safe",
    null_aware: bool = False,
) -> DataFrame:
    """Everything one run does to the history, as rows with a ``change`` column.

    ``new``: a stage row without a current version. ``updated``: a stage row
    whose value differs from the current version. ``expired``: that current
    version, closed. Stage keys are unique (see :func:`grouped_sum`, with the same
    key style). Should several current versions join to one text, each is closed
    once and the new version is added once.
    """
    columns = stage.columns
    current = conform(current_rows(history), stage.schema)
    day = run_date if isinstance(run_date, Column) else F.lit(run_date)
    end = F.lit(OPEN_END)
    differs = changed(quoted(("new", value)), quoted(("old", value)), null_aware) == "YES"
    pairs = compare_rows(stage, current, keys, key_style)
    versions = (
        F.when(F.col("old").isNull(), F.array(_version("new", columns, CURRENT_FLAG, end, "new")))
        .when(differs, F.array(
            _version("new", columns, CURRENT_FLAG, end, "updated"),
            _version("old", columns, EXPIRED_FLAG, day, "expired"),
        ))
    )
    changes = pairs.select(F.inline(versions))
    return changes.distinct() if key_style == "concat" else changes


def new_rows(stage: DataFrame, history: DataFrame, keys: Sequence[str], key_style: str = "null_safe") -> DataFrame:
    return mark_current(unknown_rows(stage, history, keys, key_style))


def _changed_pairs(stage, history, keys, value, key_style, null_aware) -> DataFrame:
    current = conform(current_rows(history), stage.schema)
    pairs = compare_rows(stage, current, keys, key_style)
    return pairs.where(changed(quoted(("new", value)), quoted(("old", value)), null_aware) == "YES")


def updated_rows(stage, history, keys, value, key_style="null_safe", null_aware=False) -> DataFrame:
    """The stage side of the changed pairs, as current rows."""
    return mark_current(_changed_pairs(stage, history, keys, value, key_style, null_aware).select("new.*"))


def expired_rows(stage, history, keys, value, run_date, key_style="null_safe", null_aware=False) -> DataFrame:
    """The history side of the changed pairs, closed on the run date."""
    return mark_expired(_changed_pairs(stage, history, keys, value, key_style, null_aware).select("old.*"), run_date)


def merge_history(
    stage: DataFrame,
    history: DataFrame,
    keys: Sequence[str],
    value: str,
    run_date: str | Column,
    key_style: str = "null_safe",
    null_aware: bool = False,
) -> DataFrame:
    """The whole history after a run: one full join of the stage with the current rows.

    A pair gives one or two rows: the current version as it was, or closed and
    followed by the new one. Expired rows pass by the join.
    """
    columns = stage.columns
    day = run_date if isinstance(run_date, Column) else F.lit(run_date)
    end = F.lit(OPEN_END)
    current = conform(current_rows(history), stage.schema)
    pairs = (
        stage.withColumn("__staged", F.lit(True)).alias("s")
        .join(current.withColumn("__known", F.lit(True)).alias("h"), same_key(keys, "s", "h", key_style), "full")
        .select(
            F.when(F.col("s.__staged"), F.struct(*[quoted(("s", name)) for name in columns])).alias("new"),
            F.when(F.col("h.__known"), F.struct(*[quoted(("h", name)) for name in columns])).alias("old"),
        )
    )
    differs = changed(quoted(("new", value)), quoted(("old", value)), null_aware) == "YES"
    versions = (
        F.when(F.col("old").isNull(), F.array(_version("new", columns, CURRENT_FLAG, end, "new")))
        .when(differs, F.array(
            _version("old", columns, EXPIRED_FLAG, day, "expired"),
            _version("new", columns, CURRENT_FLAG, end, "updated"),
        ))
        .otherwise(F.array(_version("old", columns, CURRENT_FLAG, end, "kept")))
    )
    archive = history.where(F.col("flag_del") != CURRENT_FLAG)
    merged = pairs.select(F.inline(versions))
    return (merged.distinct() if key_style == "concat" else merged).drop("change").unionByName(archive)
