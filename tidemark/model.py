"""Names and schemas shared by all operators."""

from __future__ import annotations

from pyspark.sql import types as T

INSERT, UPDATE, DELETE = "I", "U", "D"
OPS = (INSERT, UPDATE, DELETE)

OP, TABLE, COMMIT_TS, TXN_ID, SEQ, SOURCE_POS = "__op", "__table", "__commit_ts", "__txn_id", "__seq", "__source_pos"
CONTROL = (OP, TABLE, COMMIT_TS, TXN_ID, SEQ, SOURCE_POS)
WATERMARK = "__silver_commit_ts"
ORDERING = (COMMIT_TS, TXN_ID, SEQ)

_MONEY = T.DecimalType(12, 2)
_L, _S, _TS, _I = T.LongType(), T.StringType(), T.TimestampType(), T.IntegerType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


#: Declared payloads of the source tables.
PAYLOADS = {
    "customers": _struct(customer_id=_L, name=_S, email=_S, city=_S, created_at=_TS, updated_at=_TS),
    "products": _struct(product_id=_L, name=_S, category=_S, price=_MONEY, created_at=_TS, updated_at=_TS),
    "orders": _struct(order_id=_L, customer_id=_L, order_date=_TS, order_amount=_MONEY, status=_S, updated_at=_TS),
    "order_items": _struct(order_item_id=_L, order_id=_L, product_id=_L, quantity=_I, unit_price=_MONEY, updated_at=_TS),
    "payments": _struct(payment_id=_L, order_id=_L, amount=_MONEY, status=_S, paid_at=_TS, updated_at=_TS),
}


def envelope_schema(payload: T.StructType) -> T.StructType:
    """The nested change envelope around a payload."""
    meta = T.StructType(
        [T.StructField(n, t) for n, t in (("operation", _S), ("record-type", _S), ("schema-name", _S), ("table-name", _S), ("transaction-id", _L), ("commit-timestamp", _S), ("transaction-record-id", _L))]
    )
    return T.StructType([T.StructField("metadata", meta), T.StructField("data", payload), T.StructField("before", payload)])
