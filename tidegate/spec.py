"""Declarations: what a dataset, a rule document and a history table look like.

A spec is a value. It is checked as a whole before any file is read, so a wrong
column name is reported on the driver and not by a failing cluster job.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Mapping
from dataclasses import dataclass, field, replace

FORMATS = ("json", "json_multiline", "json_records", "delimited")
LINEAGE = ("job_id", "file_name", "file_load_dt")
CASTABLE = ("double", "date", "integer", "long", "string", "boolean", "timestamp")


class SpecError(ValueError):
    """A spec that cannot give a valid plan."""


def _repeated(names) -> list[str]:
    return sorted(name for name, count in Counter(names).items() if count > 1)


@dataclass(frozen=True)
class DatasetSpec:
    """One source dataset and the flat staging table it becomes."""

    name: str
    columns: tuple[str, ...]
    renames: Mapping[str, str] = field(default_factory=dict)
    required: tuple[str, ...] = ()
    casts: Mapping[str, str] = field(default_factory=dict)
    tenant_column: str | None = "_links_self_href"
    tenant_pattern: str = "[^/]+"
    tenant_target: str = "company_id"
    tenant_scope: str = "row"
    format: str = "json"
    input_schema: str | None = None
    table: str | None = None
    missing_value: str | None = ""
    #: Sibling arrays of a document: their product, or "separate" rows for the elements of each.
    arrays: str = "product"

    @property
    def targets(self) -> tuple[str, ...]:
        """Names after renaming, in output order; the tenant id comes last when the source has it."""
        return tuple(self.renames.get(name, name) for name in self.columns)

    @property
    def source_columns(self) -> tuple[str, ...]:
        return tuple(name for name in self.columns if name not in LINEAGE)

    @property
    def wanted(self) -> frozenset[str]:
        """Flat source names that reach the output."""
        return frozenset(self.columns) | ({self.tenant_column} if self.tenant_column else set())

    def problems(self) -> list[str]:
        found = []
        if not self.columns:
            found.append("no columns are declared")
        if self.format not in FORMATS:
            found.append(f"format {self.format!r} is not one of {FORMATS}")
        if self.format == "json_records" and self.input_schema is None:
            found.append("format 'json_records' needs an input schema")
        if self.tenant_scope not in ("row", "file"):
            found.append(f"tenant_scope {self.tenant_scope!r} is neither 'row' nor 'file'")
        if self.arrays not in ("product", "separate"):
            found.append(f"arrays {self.arrays!r} is neither 'product' nor 'separate'")
        for name in _repeated(self.columns):
            found.append(f"column {name!r} is declared more than once")
        for name in _repeated(self.targets):
            found.append(f"more than one column becomes {name!r}")
        outputs = set(self.targets) | ({self.tenant_target} if self.tenant_column else set())
        for name in self.required:
            if name not in outputs:
                found.append(f"required column {name!r} is not in the output")
        for name, kind in self.casts.items():
            if name not in self.columns:
                found.append(f"cast names column {name!r}, which is not declared")
            if kind not in CASTABLE:
                found.append(f"cast of {name!r} to {kind!r} is not supported")
        try:
            re.compile(self.tenant_pattern)
        except re.error as error:
            found.append(f"tenant pattern {self.tenant_pattern!r}: {error}")
        return found

    def validate(self) -> DatasetSpec:
        found = self.problems()
        if found:
            raise SpecError(f"dataset {self.name!r}: " + "; ".join(found))
        return self

    def repaired(self) -> DatasetSpec:
        """The same dataset without required columns and casts that name nothing."""
        outputs = set(self.targets) | ({self.tenant_target} if self.tenant_column else set())
        return replace(
            self,
            required=tuple(name for name in self.required if name in outputs),
            casts={name: kind for name, kind in self.casts.items() if name in self.columns},
        )

    @classmethod
    def from_mapping(cls, name: str, conf: Mapping, *, declared_only: bool = False, **overrides) -> DatasetSpec:
        """Build a spec from a parsed YAML document.

        ``declared_only=True`` leaves out the cast map and the alternative tenant
        column name, giving the columns as they are in the file.
        """
        checks = (conf.get("dataquality") or {}).get("null_check_columns") or ""
        values = {
            "columns": tuple(column.strip() for column in conf["raw_json_flatten_columns"]),
            "renames": dict(conf.get("raw_json_2_database") or {}),
            "required": tuple(part.strip() for part in checks.split(",") if part.strip()),
            "tenant_column": conf.get("company_id_column"),
            "tenant_pattern": conf.get("company_id_regex") or "[^/]+",
            "table": conf.get("table_bronze_layer"),
        }
        if not declared_only:
            values["casts"] = dict(conf.get("raw_2_db_cast") or {})
            values["tenant_target"] = conf.get("company_id_column_db") or "company_id"
        return cls(name=name, **{**values, **overrides})


@dataclass(frozen=True)
class RuleSpec:
    """One data-quality rule over a list of columns."""

    rule_id: int
    columns: tuple[str, ...]
    rule_type: str = "not null"
    name: str = ""
    description: str = ""


@dataclass(frozen=True)
class HistorySpec:
    """A versioned table: key columns, the compared value, and how it is laid out.

    ``value_type`` is what values are summed and compared as. A sum of doubles
    depends on row order in its last digits, which would count as a change; a
    decimal type makes it exact.
    """

    keys: tuple[str, ...]
    value: str
    value_type: str | None = None
    key_style: str = "null_safe"
    partition_column: str | None = None
    stage_query: str | None = None
    stage_table: str | None = None
    history_table: str | None = None

    def problems(self) -> list[str]:
        found = []
        if not self.keys:
            found.append("no key columns are declared")
        for name in _repeated(self.keys):
            found.append(f"key column {name!r} is declared more than once")
        if self.value in self.keys:
            found.append(f"value column {self.value!r} is also a key")
        if self.key_style not in ("null_safe", "concat"):
            found.append(f"key_style {self.key_style!r} is neither 'null_safe' nor 'concat'")
        if self.partition_column is not None and self.partition_column not in self.keys:
            found.append(f"partition column {self.partition_column!r} is not a key")
        if self.partition_column is not None and self.key_style == "concat":
            found.append("joined-text keys can match over partitions; use no partition column with key_style 'concat'")
        return found

    def validate(self) -> HistorySpec:
        found = self.problems()
        if found:
            raise SpecError("history: " + "; ".join(found))
        return self

    @classmethod
    def from_mapping(cls, conf: Mapping, value: str = "bal_amt", **overrides) -> HistorySpec:
        values = {
            "keys": tuple(conf["concat_columns_stage_table"]),
            "value": value,
            "stage_query": conf.get("sql_config"),
            "stage_table": conf.get("stage_table"),
            "history_table": conf.get("daily_table"),
        }
        return cls(**{**values, **overrides})


def load_yaml(path: str) -> dict:
    """Parse one small YAML document on the driver."""
    try:
        import yaml
    except ImportError as error:  # pragma: no cover - depends on the installation
        raise RuntimeError("PyYAML is needed to read a spec from a YAML file") from error
    with open(path, encoding="utf-8") as handle:
        return yaml.safe_load(handle)
