"""What became of a batch, counted in one pass over each of its parts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.model import DELETE, INSERT, OP, UPDATE
from tidemark.operators.ordering import guard_stale_updates, latest_per_key
from tidemark.operators.validation import REASON


def op_counts(changes: DataFrame) -> DataFrame:
    """(op, n): rows by operation."""
    return changes.groupBy(F.col(OP).alias("op")).agg(F.count("*").alias("n"))


def batch_accounting(annotated: DataFrame, current: DataFrame, primary_keys: Sequence[str], watermark_col: str) -> DataFrame:
    """One row: source, rejected, duplicates, stale, inserts, updates, deletes.

    The counts of the first five buckets and the three operations add up to the
    source: each row is rejected, superseded, stale or applied.
    """
    valid = annotated.where(F.col(REASON).isNull()).drop(REASON)
    newest = latest_per_key(valid, primary_keys)
    kept = guard_stale_updates(newest, current, primary_keys, watermark_col)
    ops = {"inserts": INSERT, "updates": UPDATE, "deletes": DELETE}
    total = annotated.agg(F.count("*").alias("source"), F.count(REASON).alias("rejected"))
    latest = newest.agg(F.count("*").alias("latest"))
    applied = kept.agg(F.count("*").alias("applied"), *[F.count_if(F.col(OP) == v).alias(k) for k, v in ops.items()])
    # Three single rows folded into one.
    rows = total.unionByName(latest, allowMissingColumns=True).unionByName(applied, allowMissingColumns=True)
    one = rows.agg(*[F.max(c).alias(c) for c in rows.columns])
    return one.select(
        "source",
        "rejected",
        (F.col("source") - F.col("rejected") - F.col("latest")).alias("duplicates"),
        (F.col("latest") - F.col("applied")).alias("stale"),
        *ops,
    )


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose non-null key no parent has."""
    keys = parent.select(F.col(parent_key).alias("__parent"))
    return child.where(F.col(child_key).isNotNull()).join(keys, F.col(child_key) == F.col("__parent"), "left_anti")
