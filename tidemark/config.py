"""Pipeline configuration: rules, tables, and where things live."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any

RULE_KINDS = ("not_null", "non_negative", "allowed_values", "valid_timestamp")

#: Required settings and the environment variables that override them (fixed names).
SETTINGS = {
    "environment": "CDC_ENVIRONMENT",
    "bronze_bucket": "CDC_BRONZE_BUCKET",
    "silver_warehouse": "CDC_SILVER_WAREHOUSE",
    "reject_prefix": "CDC_REJECT_PREFIX",
    "glue_database": "CDC_GLUE_DATABASE",
    "audit_table": "CDC_AUDIT_TABLE",
    "sns_topic_arn": "CDC_SNS_TOPIC_ARN",
}


@dataclass(frozen=True)
class DQRule:
    """One declarative check of one column."""

    column: str
    kind: str
    values: tuple[Any, ...] | None = None

    def __post_init__(self) -> None:
        if self.kind not in RULE_KINDS:
            raise ValueError(f"unknown rule kind {self.kind!r} on {self.column!r}; one of {', '.join(RULE_KINDS)}")
        object.__setattr__(self, "values", None if self.values is None else tuple(self.values))
        if self.kind == "allowed_values" and not self.values:
            raise ValueError(f"rule allowed_values on {self.column!r} needs values")


@dataclass(frozen=True)
class TableConfig:
    """Keys, order and rules of a source table."""

    name: str
    primary_keys: tuple[str, ...]
    order_by: tuple[str, ...]
    silver_table: str
    dq_rules: tuple[DQRule, ...] = ()
    partition_by: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        for name in ("primary_keys", "order_by", "dq_rules", "partition_by"):
            object.__setattr__(self, name, tuple(getattr(self, name) or ()))
        for name in ("primary_keys", "order_by"):
            if not getattr(self, name):
                raise ValueError(f"table {self.name!r} needs {name}")


@dataclass(frozen=True)
class PipelineConfig:
    environment: str
    bronze_bucket: str
    silver_warehouse: str
    reject_prefix: str
    glue_database: str
    audit_table: str
    sns_topic_arn: str
    tables: dict[str, TableConfig] = field(default_factory=dict)

    def table(self, name: str) -> TableConfig:
        if name not in self.tables:
            raise KeyError(f"no table {name!r} is configured; known: {', '.join(sorted(self.tables))}")
        return self.tables[name]


def parse_config(raw: Mapping[str, Any], env: Mapping[str, str] | None = None) -> PipelineConfig:
    """A configuration from plain data; non-empty environment variables win over it."""
    env = os.environ if env is None else env
    settings = {key: env.get(variable) or raw.get(key) for key, variable in SETTINGS.items()}
    absent = [key for key, value in settings.items() if not value]
    if absent:
        raise ValueError(f"configuration lacks {', '.join(absent)}")
    tables = {}
    for name, t in (raw.get("tables") or {}).items():
        rules = tuple(DQRule(r["column"], r["kind"], r.get("values")) for r in t.get("dq_rules") or ())
        tables[name] = TableConfig(name, t.get("primary_keys"), t.get("order_by"), t["silver_table"], rules, t.get("partition_by"))
    return PipelineConfig(**settings, tables=tables)


def load_config(path: str, env: Mapping[str, str] | None = None) -> PipelineConfig:
    import yaml

    with open(path, encoding="utf-8") as f:
        return parse_config(yaml.safe_load(f) or {}, env)
