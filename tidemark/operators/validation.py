"""Rules over rows: valid ones, rejected ones with reasons, quarantine records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.config import DQRule
from tidemark.functions.expressions import reasons
from tidemark.model import DELETE, OP

REASON = "__error_reason"


def annotate(df: DataFrame, rules: Sequence[DQRule], primary_keys: Sequence[str] | None = None) -> DataFrame:
    """``df`` with the reasons of each row's rejection, or null.

    A delete needs only its keys: of the rules only not_null ones apply to it,
    and where ``primary_keys`` is given only those of the keys.
    """
    key_rules = [r for r in rules if r.kind == "not_null" and (primary_keys is None or r.column in primary_keys)]
    is_delete = F.col(OP).eqNullSafe(F.lit(DELETE))
    return df.withColumn(REASON, F.when(is_delete, reasons(key_rules)).otherwise(reasons(list(rules))))


def split_valid_invalid(df: DataFrame, rules: Sequence[DQRule], primary_keys: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Valid rows as they came, and rejected rows with their reasons."""
    marked = annotate(df, rules, primary_keys)
    return marked.where(F.col(REASON).isNull()).drop(REASON), marked.where(F.col(REASON).isNotNull())


def to_quarantine_records(invalid: DataFrame, table: str, batch_id: str) -> DataFrame:
    """original_event (JSON without nulls), error_reason, table_name, processing_time, batch_id."""
    event = [f"`{c}`" for c in invalid.columns if c != REASON]
    return invalid.select(
        F.to_json(F.struct(*event)).alias("original_event"),
        F.col(REASON).alias("error_reason"),
        F.lit(table).alias("table_name"),
        F.current_timestamp().alias("processing_time"),
        F.lit(batch_id).alias("batch_id"),
    )
