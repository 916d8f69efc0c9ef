"""Keyed apply of changes to current state, as one full outer join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.model import COMMIT_TS, DELETE, INSERT, OP, UPDATE, WATERMARK


def with_watermark(changes: DataFrame) -> DataFrame:
    return changes.withColumn(WATERMARK, F.col(COMMIT_TS))


def payload_columns(df: DataFrame) -> list[str]:
    """What is stored: everything but control columns, and the watermark."""
    return [c for c in df.columns if not c.startswith("__") or c == WATERMARK]


def apply_changes(current: DataFrame, changes: DataFrame, primary_keys: Sequence[str], insert_on_match: str = "ignore") -> DataFrame:
    """The state after ``changes`` (one row a key, with operation and watermark).

    Stored key: D removes it, U replaces all payload columns, I is ignored, or
    taken as U where ``insert_on_match`` is 'upsert'. New key: I and U insert, D
    does nothing. Null keys match nothing. Columns that one side lacks are null.
    """
    if insert_on_match not in ("ignore", "upsert"):
        raise ValueError(f"insert_on_match is 'ignore' or 'upsert', not {insert_on_match!r}")
    stored = payload_columns(changes)
    stored += [c for c in current.columns if c not in stored]
    kinds = {f.name: f.dataType for f in [*changes.schema.fields, *current.schema.fields]}

    def side(df: DataFrame, name: str, *more) -> DataFrame:
        own = [(F.col(f"`{c}`") if c in df.columns else F.lit(None).cast(kinds[c])).alias(c) for c in stored]
        return df.select(F.struct(*own).alias(name), *more, *[F.col(k).alias(f"__{name}{i}") for i, k in enumerate(primary_keys)])

    old, new = side(current, "o"), side(changes, "n", F.col(OP).alias("__change"))
    match = F.lit(True)
    for i in range(len(primary_keys)):
        match = match & (F.col(f"__o{i}") == F.col(f"__n{i}"))
    both = old.join(new, match, "full_outer")
    has_old, has_new, op = F.col("o").isNotNull(), F.col("n").isNotNull(), F.col("__change")
    replaces = F.coalesce(op.isin(*([UPDATE, INSERT] if insert_on_match == "upsert" else [UPDATE])), F.lit(False))
    removed = has_old & has_new & F.coalesce(op == DELETE, F.lit(False))
    unborn = ~has_old & ~F.coalesce(op.isin(INSERT, UPDATE), F.lit(False))
    row = F.when(~has_old | (has_new & replaces), F.col("n")).otherwise(F.col("o"))
    return both.where(~removed & ~unborn).select(row.alias("r")).select("r.*")


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema`` in order; absent ones null, others cast."""
    return df.select(*[(F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])
