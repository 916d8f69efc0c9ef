"""Newest change per key, and the guard against late ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.model import COMMIT_TS, ORDERING

RANK = "__rn"


def newest_first(order_by: Sequence[str] = ORDERING, numeric_txn: bool = False) -> list[Column]:
    """Descending, nulls last. ``numeric_txn`` compares digits in ids such as tx9 and tx10 as numbers."""
    out = []
    for name in order_by:
        if numeric_txn and name == "__txn_id":
            out.append(F.try_to_number(F.regexp_extract(F.col(name), r"(\d+)", 1), F.lit("9" * 38)).desc_nulls_last())
        out.append(F.col(name).desc_nulls_last())
    return out


def add_rank(df: DataFrame, primary_keys: Sequence[str], order_by: Sequence[str] = ORDERING, numeric_txn: bool = False) -> DataFrame:
    """1 for the newest row of each key; full ties by a hash of the row, so order of arrival doesn't matter."""
    if not primary_keys:
        raise ValueError("ranking needs at least one key column")
    tie = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).asc()
    return df.withColumn(RANK, F.row_number().over(Window.partitionBy(*primary_keys).orderBy(*newest_first(order_by, numeric_txn), tie)))


def latest_per_key(df: DataFrame, primary_keys: Sequence[str], order_by: Sequence[str] = ORDERING, numeric_txn: bool = False) -> DataFrame:
    """The newest row of each key; Spark cuts each task's rows to one a key before the shuffle."""
    return add_rank(df, primary_keys, order_by, numeric_txn).where(F.col(RANK) == 1).drop(RANK)


def count_duplicates(df: DataFrame, primary_keys: Sequence[str]) -> int:
    """Rows beyond the first of each key (null keys are one key), in one job."""
    keyed = df.groupBy(*primary_keys).agg(F.count("*").alias("n"))
    return keyed.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("d")).first().d


def guard_stale_updates(incoming: DataFrame, current: DataFrame, primary_keys: Sequence[str], watermark_col: str = COMMIT_TS, tombstones: DataFrame | None = None) -> DataFrame:
    """Incoming rows strictly newer than what is stored under their key, and those of new keys.

    An anti-join against the stored watermarks. A row without a timestamp loses
    against any stored one; null keys match nothing. ``tombstones`` (keys and
    watermark of deleted rows) keeps late changes from bringing them back.
    """
    for name, df in (("incoming", incoming), ("current", current)):
        absent = [c for c in primary_keys if c not in df.columns]
        if absent:
            raise ValueError(f"{name} lacks the key columns {', '.join(absent)}")
    if COMMIT_TS not in incoming.columns or watermark_col not in current.columns:
        raise ValueError(f"the guard compares {COMMIT_TS} of incoming with {watermark_col} of current")
    known = current.select(*primary_keys, F.col(watermark_col).alias("__stored"))
    if tombstones is not None:
        known = known.unionByName(tombstones.select(*primary_keys, F.col(watermark_col).alias("__stored")))
        known = known.groupBy(*primary_keys).agg(F.max("__stored").alias("__stored"))
    known = known.where(F.col("__stored").isNotNull()).select(*[F.col(c).alias(f"__k{i}") for i, c in enumerate(primary_keys)], "__stored")
    match = F.lit(True)
    for i, c in enumerate(primary_keys):
        match = match & (incoming[c] == F.col(f"__k{i}"))
    late = incoming[COMMIT_TS].isNull() | (incoming[COMMIT_TS] <= F.col("__stored"))
    return incoming.join(known, match & late, "left_anti")
