"""Row checks, quarantine split, rule tables and load counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, functions as F

from tidegate.operators.flatten import quoted
from tidegate.spec import RuleSpec, SpecError

FLAG = "null_check_result"


def any_missing(columns: Sequence[str], blank_is_null: bool = False) -> Column:
    """True where any column is null (or blank, on request); never null; false for no columns."""
    def missing(name: str) -> Column:
        column = quoted((name,))
        if not blank_is_null:
            return column.isNull()
        return F.coalesce(F.trim(column.cast("string")) == "", F.lit(True))

    return reduce(lambda left, right: left | right, map(missing, columns), F.lit(False))


def parse_column_list(text: str | None, trim: bool = True) -> tuple[str, ...]:
    """Column names from a comma list; a blank list names none."""
    if text is None or not text.strip():
        return ()
    return tuple(part.strip() if trim else part for part in text.split(","))


def flag_missing(df: DataFrame, columns: Sequence[str], flag: str = FLAG, blank_is_null: bool = False) -> DataFrame:
    return df.withColumn(flag, any_missing(columns, blank_is_null))


def flag_missing_by(
    df: DataFrame, columns: Sequence[str], owners: Mapping[str, str], child: str, document: str, flag: str = FLAG
) -> DataFrame:
    """Flag rows with a missing column, where a column that has an owner counts in the owner's rows only
    (and in those of documents without any element). Without owners this is :func:`flag_missing`."""
    groups: dict[str | None, list[str]] = {}
    for name in columns:
        groups.setdefault(owners.get(name), []).append(name)
    missing = F.lit(False)
    for owner, names in groups.items():
        own = any_missing(names)
        missing = missing | (own if owner is None else own & F.col(child).isin(owner, document))
    return df.withColumn(flag, missing)


def split_rows(df: DataFrame, flag: str = FLAG) -> tuple[DataFrame, DataFrame]:
    """Rows to load and rows to quarantine. The flag is never null, so no row is lost."""
    return df.where(~F.col(flag)).drop(flag), df.where(F.col(flag)).drop(flag)


def rule_condition(rule: RuleSpec) -> Column:
    """True where a row breaks the rule."""
    if rule.rule_type.strip().lower() == "not null":
        return any_missing(rule.columns)
    raise SpecError(f"rule {rule.rule_id}: type {rule.rule_type!r} is not supported")


def check_rules(df: DataFrame, rules: Sequence[RuleSpec], output: str = "violated_rules") -> DataFrame:
    """Add the ids of the rules each row breaks, as an array in rule order."""
    for rule in rules:
        unknown = [name for name in rule.columns if name not in df.columns]
        if unknown:
            raise SpecError(f"rule {rule.rule_id} names unknown columns {unknown}")
    if not rules:
        return df.withColumn(output, F.array().cast("array<bigint>"))
    broken = [F.when(rule_condition(rule), F.lit(rule.rule_id).cast("bigint")) for rule in rules]
    return df.withColumn(output, F.array_compact(F.array(*broken)))


def count_violations(df: DataFrame, rules: Sequence[RuleSpec]) -> DataFrame:
    """Rows per rule that break it, rules without a violation included: one pass, one small result."""
    counts = df.agg(*[F.count_if(rule_condition(rule)).alias(f"rule_{n}") for n, rule in enumerate(rules)])
    pairs = F.array(*[
        F.struct(F.lit(rule.rule_id).cast("bigint").alias("rule_id"), F.col(f"rule_{n}").alias("violations"))
        for n, rule in enumerate(rules)
    ])
    return counts.select(F.inline(pairs))


def _counters(flag: str) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("total_record_count"),
        F.count_if(~F.col(flag)).alias("load_record_count"),
        F.count_if(F.col(flag)).alias("error_record_count"),
    ]


def load_metrics(df: DataFrame, flag: str = FLAG) -> DataFrame:
    """Total, loaded and rejected rows in one pass."""
    return df.agg(*_counters(flag))


def observe_load(df: DataFrame, name: str, flag: str = FLAG) -> tuple[DataFrame, Observation]:
    """The same counts taken while another action runs over the rows."""
    observation = Observation(name)
    return df.observe(observation, *_counters(flag)), observation
