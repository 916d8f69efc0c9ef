"""Change envelopes of either shape to canonical rows: control columns, then payload."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.expressions import normalise_op
from tidemark.model import COMMIT_TS, OP, SEQ, SOURCE_POS, TABLE, TXN_ID

#: Names that flat records use for each control column, the first present wins.
FLAT_NAMES = {
    OP: ("Op", "op", "__op"),
    COMMIT_TS: ("commit_timestamp", "timestamp", "__commit_ts"),
    TXN_ID: ("transaction_id", "transact_id", "__txn_id"),
    SEQ: ("seq", "transaction_record_id", "__seq"),
    SOURCE_POS: ("source_pos", "lsn", "__source_pos"),
}


def _find(df: DataFrame, *names: str) -> str | None:
    sensitive = df.sparkSession.conf.get("spark.sql.caseSensitive", "false") == "true"
    exact = [c for n in names for c in df.columns if c == n]
    loose = [] if sensitive else [c for n in names for c in df.columns if c.lower() == n.lower()]
    return next(iter(exact + loose), None)


def _timestamp(c: Column) -> Column:
    """Timestamps as they are, text parsed; null where it can't be."""
    return F.try_to_timestamp(c.cast("string"))


def parse_nested(df: DataFrame, table: str) -> DataFrame:
    """Rows of a stream's envelopes; control records (and null record types) go."""
    if not {"metadata", "data"} <= set(df.columns):
        raise ValueError(f"nested envelopes have metadata and data; columns here: {', '.join(df.columns)}")
    meta = F.col("metadata")
    txn = meta["transaction-id"].cast("string")
    return df.where(meta["record-type"] == "data").select(
        normalise_op(meta["operation"]).alias(OP),
        F.coalesce(meta["table-name"], F.lit(table)).alias(TABLE),
        _timestamp(meta["commit-timestamp"]).alias(COMMIT_TS),
        txn.alias(TXN_ID),
        meta["transaction-record-id"].try_cast("bigint").alias(SEQ),
        txn.alias(SOURCE_POS),
        "data.*",
    )


def parse_flat(df: DataFrame, table: str, keep_control_source: bool = True) -> DataFrame:
    """Rows whose payload is inline. Absent control columns are typed nulls.

    The raw control columns stay part of the payload unless
    ``keep_control_source`` is false.
    """
    at = {name: _find(df, *names) for name, names in FLAT_NAMES.items()}
    if at[OP] is None:
        raise ValueError(f"flat records have one of {', '.join(FLAT_NAMES[OP])}; columns here: {', '.join(df.columns)}")

    def of(name: str, make, kind: str) -> Column:
        found = at[name]
        return (F.lit(None) if found is None else make(F.col(f"`{found}`"))).cast(kind).alias(name)

    txn = of(TXN_ID, lambda c: c.cast("string"), "string")
    position = txn.alias(SOURCE_POS) if at[SOURCE_POS] is None else of(SOURCE_POS, lambda c: c.cast("string"), "string")
    raw = {at[OP]} if keep_control_source else {c for c in at.values() if c}
    payload = [f"`{c}`" for c in df.columns if c not in raw and not c.startswith("__")]
    return df.select(
        normalise_op(F.col(f"`{at[OP]}`")).alias(OP),
        F.lit(table).alias(TABLE),
        of(COMMIT_TS, _timestamp, "timestamp"),
        txn,
        of(SEQ, lambda c: c.try_cast("bigint"), "bigint"),
        position,
        *payload,
    )


def parse(df: DataFrame, table: str) -> DataFrame:
    """Either shape, told by the schema."""
    nested = {"metadata", "data"} <= set(df.columns)
    return parse_nested(df, table) if nested else parse_flat(df, table)
