"""Data-quality rule documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidegate.operators.flatten import flatten
from tidegate.sources.files import Paths, read_json_multiline
from tidegate.spec import RuleSpec

RULE_DOCUMENT = (
    "dq_id long, rules array<struct<rule_id: long, name: string, description: string, "
    "rule_type: string, columns: array<string>>>"
)


def read_rules(spark: SparkSession, path: Paths, job_id: str | None = None) -> DataFrame:
    """A rule document as one row per rule and column."""
    rules = flatten(read_json_multiline(spark, path, RULE_DOCUMENT))
    return rules if job_id is None else rules.withColumn("job_id", F.lit(job_id))


def rules_from_frame(rules: DataFrame) -> list[RuleSpec]:
    """Rule values from a rule table.

    Rules become expressions of the plan, so they are needed on the driver. Rules
    of different documents stay apart, also where they have the same rule id.
    """
    grouped: dict[tuple[int, int], RuleSpec] = {}
    order = ("dq_id", "rules_rule_id", "rules_columns")
    for row in sorted(rules.collect(), key=lambda row: [(row[name] is not None, row[name] or 0) for name in order[:2]] + [row[order[2]] or ""]):
        known = grouped.get((row.dq_id, row.rules_rule_id))
        columns = (known.columns if known else ()) + ((row.rules_columns,) if row.rules_columns else ())
        grouped[row.dq_id, row.rules_rule_id] = RuleSpec(
            row.rules_rule_id, columns, row.rules_rule_type, row.rules_name, row.rules_description
        )
    return list(grouped.values())
