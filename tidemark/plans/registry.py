"""Queries of the operators over the supplied tables, each with its SQL.

``events`` is turned into a change feed by SQL that Spark and DuckDB both read,
so either side starts from the same rows. Timestamps leave queries without zone.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import DQRule
from tidemark.functions.expressions import normalise_op
from tidemark.model import COMMIT_TS, OP, WATERMARK
from tidemark.operators import accounting, evolution
from tidemark.operators.apply import apply_changes, payload_columns, with_watermark
from tidemark.operators.envelope import parse_flat, parse_nested
from tidemark.operators.ordering import RANK, add_rank, count_duplicates, guard_stale_updates, latest_per_key
from tidemark.operators.validation import REASON, annotate, split_valid_invalid, to_quarantine_records
from tidemark.plans import gold, serving
from tidemark.store import Store
from tidemark.streaming import bronze

FEED = """
WITH base AS (
  SELECT CASE WHEN event_id % 101 = 0 THEN 'weird' WHEN event_type = 'signup' THEN 'insert' WHEN event_type = 'error' THEN 'delete' ELSE 'update' END AS Op,
    CASE WHEN event_id % 97 = 0 THEN NULL ELSE user_id END AS order_id, user_id % 50 AS customer_id,
    CASE WHEN event_id % 37 = 0 THEN -value ELSE value END AS order_amount,
    CASE WHEN event_id % 53 = 0 THEN 'TELEPORTED' WHEN event_type = 'click' THEN 'SHIPPED' WHEN event_type = 'view' THEN 'DELIVERED'
      WHEN event_type = 'purchase' THEN 'CANCELLED' ELSE 'PLACED' END AS status,
    date_trunc('hour', ts) AS commit_timestamp, lpad(CAST(event_id AS STRING), 12, '0') AS transaction_id, event_id AS seq, event_id % 2 AS batch
  FROM events)
SELECT * FROM base UNION ALL SELECT * FROM base WHERE seq % 10 = 0
"""

ORDERS = """
SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate AS order_date, o_totalprice AS order_amount,
  CASE WHEN o_orderkey % 17 = 0 THEN 'CANCELLED' WHEN o_orderstatus = 'F' THEN 'DELIVERED' WHEN o_orderstatus = 'O' THEN 'SHIPPED' ELSE 'PLACED' END AS status
FROM orders
"""

KEYS = ["order_id"]
RULES = [
    DQRule("order_id", "not_null"),
    DQRule("customer_id", "not_null"),
    DQRule("order_amount", "non_negative"),
    DQRule("status", "allowed_values", ("PLACED", "SHIPPED", "DELIVERED", "CANCELLED")),
]
PAYLOAD = ["order_id", "customer_id", "order_amount", "status"]


def _sql(spark: SparkSession, sf: str, text: str, *tables: str) -> DataFrame:
    """Run SQL that names tables, with no name left behind in the session."""
    return spark.sql(text.replace("FROM events", "FROM {events}").replace("FROM orders", "FROM {orders}"), **{t: spark.read.parquet(f"{sf}/{t}.parquet") for t in tables})


def _read(spark: SparkSession, sf: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{table}.parquet")


def _orders(spark: SparkSession, sf: str) -> DataFrame:
    return _sql(spark, sf, ORDERS, "orders")


def _feed(spark: SparkSession, sf: str, batch: int | None = None) -> DataFrame:
    feed = _sql(spark, sf, FEED, "events")
    return feed if batch is None else feed.where(F.col("batch") == batch)


def _plain(df: DataFrame) -> DataFrame:
    """Timestamps without zone."""
    return df.withColumns({f.name: F.col(f.name).cast("timestamp_ntz") for f in df.schema.fields if f.dataType.typeName() == "timestamp"})


def _parsed(spark: SparkSession, sf: str, batch: int | None = None) -> DataFrame:
    return parse_flat(_feed(spark, sf, batch), "orders", keep_control_source=False).drop("batch")


def _valid(spark: SparkSession, sf: str, batch: int | None = None) -> DataFrame:
    return split_valid_invalid(_parsed(spark, sf, batch), RULES, KEYS)[0]


def _changes(spark: SparkSession, sf: str, batch: int) -> DataFrame:
    return with_watermark(latest_per_key(_valid(spark, sf, batch), KEYS))


def _nothing(changes: DataFrame) -> DataFrame:
    return changes.select(*payload_columns(changes)).limit(0)


def _state(spark: SparkSession, sf: str) -> DataFrame:
    first = _changes(spark, sf, 0)
    return apply_changes(_nothing(first), first, KEYS)


def _guarded(spark: SparkSession, sf: str, current: DataFrame) -> DataFrame:
    return guard_stale_updates(_changes(spark, sf, 1), current, KEYS, WATERMARK)


def _root(spark: SparkSession) -> str:
    """A fresh folder that all executors share; a folder of this machine only where it is the cluster."""
    known = spark.sparkContext._jsc.sc().getCheckpointDir()
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir") or (known.get() if known.isDefined() else None)
    if not shared:
        if not re.fullmatch(r"local(\[[^-]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        shared = tempfile.gettempdir()
    return f"{shared if '://' in shared or shared.startswith('file:') else 'file://' + shared}/tidemark-{uuid.uuid4().hex}"


def _daily(s, d):
    return gold.daily_sales(_orders(s, d))


def _customers(s, d):
    return gold.customer_metrics(_read(s, d, "customer").select(F.col("c_custkey").alias("customer_id")), _orders(s, d))


def _products(s, d):
    items = _read(s, d, "lineitem").select(F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"), F.col("l_quantity").cast("int").alias("quantity"))
    return gold.product_metrics(_read(s, d, "part").select(F.col("p_partkey").alias("product_id")), items)


def _status(s, d):
    return gold.order_status(_orders(s, d))


def _op_normalise(s, d):
    raw = _read(s, d, "events").select("event_id", F.when(F.col("event_id") % 3 == 0, F.concat(F.lit(" "), F.upper("event_type"))).when(F.col("event_id") % 3 == 1, F.element_at(F.array(*map(F.lit, ("load", "I ", "Update", "d", "x"))), (F.col("event_id") % 5 + 1).cast("int"))).alias("raw"))
    return raw.select("event_id", normalise_op(F.col("raw")).alias("op"))


def _nested(s, d):
    e = _read(s, d, "events")
    record = F.struct(
        F.struct(
            F.col("event_type").alias("operation"),
            F.when(F.col("event_id") % 7 == 0, "control").when(F.col("event_id") % 11 != 0, "data").alias("record-type"),
            F.when(F.col("event_id") % 5 != 0, "orders").alias("table-name"),
            F.col("event_id").alias("transaction-id"),
            F.when(F.col("event_id") % 13 == 0, "not a time").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("commit-timestamp"),
            (F.col("event_id") * 2).alias("transaction-record-id"),
        ).alias("metadata"),
        F.struct(F.col("user_id").alias("order_id"), F.col("value").alias("order_amount")).alias("data"),
    )
    schema = "metadata struct<operation: string, `record-type`: string, `table-name`: string, `transaction-id`: bigint, `commit-timestamp`: string, `transaction-record-id`: bigint>, data struct<order_id: bigint, order_amount: double>"
    parsed = e.select(F.from_json(F.to_json(record), schema).alias("e")).select("e.*")
    return _plain(parse_nested(parsed, "unnamed"))


def _quarantine(s, d):
    bad = split_valid_invalid(_parsed(s, d), RULES, KEYS)[1]
    out = to_quarantine_records(bad, "orders", "b1")
    event = F.col("original_event")
    return out.select(F.get_json_object(event, "$.__seq").cast("bigint").alias("seq"), F.get_json_object(event, "$.status").alias("status"), "error_reason", "table_name", "batch_id")


def _two_batches(s, d):
    state = _state(s, d)
    return apply_changes(state, _guarded(s, d, state), KEYS)


def _stored(s, d, writers: int = 1):
    """Both batches through the versioned store, over four buckets."""
    store, first = Store(s, _root(s), writers), _changes(s, d, 0)
    store.ensure("orders", first.select(*payload_columns(first)).schema, KEYS, 4)
    store.apply("orders", first, "b0")
    one = store.manifest("orders")
    store.apply("orders", _guarded(s, d, store.read("orders")), "b1")
    return store, one


def _as_of(s, d):
    store, one = _stored(s, d)
    return _plain(store.read("orders", as_of=one.committed_at))


def _schema_diff(s, d):
    diff = evolution.diff_schema(
        evolution.pairs(_read(s, d, "orders").schema),
        [("o_orderkey", "bigint"), ("o_custkey", "int"), ("o_totalprice", "double"), ("o_orderdate", "timestamp"), ("o_orderpriority", "string"), ("coupon", "string"), ("__op", "string")],
    )
    return s.createDataFrame([(diff.is_breaking, diff.is_additive, diff.is_empty, diff.summary())], "breaking boolean, additive boolean, empty boolean, summary string")


def _bronze(s, d):
    root = _root(s)
    raw = _read(s, d, "events").select(F.to_json(F.struct("event_id", "user_id")).cast("binary").alias("data"), F.col("ts").cast("timestamp").alias("approximateArrivalTimestamp"))
    raw.write.parquet(f"{root}/in")
    query = bronze.start(bronze.file_stream(s, f"{root}/in"), f"{root}/bronze", f"{root}/checkpoint", every=None)
    query.awaitTermination()
    back = s.read.schema("json_str string, arrival_ts timestamp, year string, month string, day string, hour string").parquet(f"{root}/bronze")
    return back.select(F.get_json_object("json_str", "$.event_id").cast("bigint").alias("event_id"), "year", "month", "day", "hour")


def _duplicates(s, d):
    valid = _valid(s, d)
    return s.createDataFrame([(count_duplicates(valid, KEYS),)], "duplicates bigint")


def _compacted(s, d):
    """The store after both batches, written as many small files, then compacted."""
    store, _ = _stored(s, d, writers=3)
    before = store.live_files("orders")
    done = store.compact("orders", min_files=2)
    if done is None or not store.live_files("orders") < before:
        raise ValueError("nothing was compacted")
    return _plain(store.read("orders"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "gold_daily_sales": _daily,
    "gold_order_status": _status,
    "gold_customer_metrics": _customers,
    "gold_product_metrics": _products,
    "serve_recent_days": lambda s, d: serving.recent_days(_daily(s, d)),
    "serve_top_customers": lambda s, d: serving.top_customers(_customers(s, d)),
    "serve_top_products": lambda s, d: serving.top_products(_products(s, d)),
    "serve_status_over_time": lambda s, d: serving.status_over_time(_status(s, d)),
    "op_normalise": _op_normalise,
    "cdc_feed": lambda s, d: _plain(_feed(s, d)),
    "cdc_parse_flat": lambda s, d: _plain(_parsed(s, d)),
    "cdc_parse_nested": _nested,
    "dq_valid": lambda s, d: _plain(_valid(s, d)),
    "dq_invalid_reasons": lambda s, d: split_valid_invalid(_parsed(s, d), RULES, KEYS)[1].select(F.col("__seq").alias("seq"), F.col(REASON).alias("reason")),
    "quarantine_shape": _quarantine,
    "dedup_rank": lambda s, d: add_rank(_valid(s, d).distinct(), KEYS).select("order_id", F.col("__seq").alias("seq"), F.col(RANK).alias("rn")),
    "dedup_latest": lambda s, d: _plain(latest_per_key(_valid(s, d), KEYS)),
    "duplicate_count": _duplicates,
    "op_counts": lambda s, d: accounting.op_counts(_valid(s, d)),
    "stale_guard": lambda s, d: _plain(_guarded(s, d, _state(s, d)).select(*PAYLOAD, F.col(OP).alias("op"), F.col(COMMIT_TS).alias("at"))),
    "apply_batch": lambda s, d: _plain(_state(s, d)),
    "apply_two_batches": lambda s, d: _plain(_two_batches(s, d)),
    "batch_accounting": lambda s, d: accounting.batch_accounting(annotate(_parsed(s, d, 1), RULES, KEYS), _state(s, d), KEYS, WATERMARK),
    "store_two_batches": lambda s, d: _plain(_stored(s, d)[0].read("orders")),
    "snapshot_as_of": _as_of,
    "compaction_equivalence": _compacted,
    "store_snapshots": lambda s, d: _stored(s, d)[0].snapshots("orders").select("snapshot_id", "operation"),
    "orders_without_items": lambda s, d: accounting.orphans(_read(s, d, "orders"), _read(s, d, "lineitem"), "o_orderkey", "l_orderkey").select("o_orderkey", "o_custkey"),
    "orphan_check": lambda s, d: accounting.orphans(_read(s, d, "lineitem"), _read(s, d, "orders"), "l_orderkey", "o_orderkey").select("l_orderkey", "l_partkey", "l_linenumber"),
    "schema_diff": _schema_diff,
    "bronze_stream_roundtrip": _bronze,
}

# The same in DuckDB, from the same feed and orders.

_AVG = "(2 * sum(c) + count(*)) // (2 * count(*)) / 100.0"
_DAILY = f"""
SELECT CAST(order_date AS DATE) AS date, count(*) AS total_orders, count(*) FILTER (status = 'DELIVERED') AS delivered_orders,
  count(*) FILTER (status = 'CANCELLED') AS cancelled_orders, CAST(sum(CAST(order_amount AS DECIMAL(12, 2))) AS DOUBLE) AS total_revenue,
  CAST({_AVG} AS DOUBLE) AS average_order_value
FROM (SELECT *, CAST(round(order_amount * 100) AS BIGINT) AS c FROM ({ORDERS})) GROUP BY 1
"""
_STATUS = f"SELECT CAST(order_date AS DATE) AS date, status, count(*) AS order_count FROM ({ORDERS}) GROUP BY 1, 2"
_CUSTOMERS = f"""
SELECT c_custkey AS customer_id, count(o.order_id) AS total_orders,
  CAST(coalesce(sum(CAST(o.order_amount AS DECIMAL(12, 2))), 0) AS DOUBLE) AS lifetime_value, max(o.order_date) AS last_order_date
FROM customer LEFT JOIN ({ORDERS}) o ON c_custkey = o.customer_id GROUP BY 1
"""
_PRODUCTS = """
SELECT p_partkey AS product_id, CAST(coalesce(sum(CAST(l_quantity AS INT)), 0) AS BIGINT) AS units_sold, count(DISTINCT l_orderkey) AS orders_containing
FROM part LEFT JOIN lineitem ON p_partkey = l_partkey GROUP BY 1
"""
_OPS = "CASE lower(trim({0})) WHEN 'load' THEN 'I' WHEN 'insert' THEN 'I' WHEN 'i' THEN 'I' WHEN 'update' THEN 'U' WHEN 'u' THEN 'U' WHEN 'delete' THEN 'D' WHEN 'd' THEN 'D' END"


def _with(last: str) -> str:
    """CTEs from the feed to the state after both batches, then a SELECT."""
    reason = """nullif(concat_ws('; ', CASE WHEN order_id IS NULL THEN 'order_id IS NULL' END,
      CASE WHEN customer_id IS NULL AND __op IS DISTINCT FROM 'D' THEN 'customer_id IS NULL' END,
      CASE WHEN order_amount < 0 AND __op IS DISTINCT FROM 'D' THEN 'order_amount < 0' END,
      CASE WHEN status NOT IN ('PLACED', 'SHIPPED', 'DELIVERED', 'CANCELLED') AND __op IS DISTINCT FROM 'D'
        THEN 'status NOT IN (''PLACED'', ''SHIPPED'', ''DELIVERED'', ''CANCELLED'')' END,
      CASE WHEN __op IS NULL THEN 'invalid op: <null>' END), '')"""
    best = "row_number() OVER (PARTITION BY {0}order_id ORDER BY __commit_ts DESC NULLS LAST, __txn_id DESC NULLS LAST, __seq DESC NULLS LAST)"

    def applied(cur: str, new: str) -> str:
        take = f"c.order_id IS NULL OR n.__op = 'U'"  # noqa: F541
        cols = ", ".join(f"CASE WHEN {take} THEN n.{x} ELSE c.{x} END AS {x}" for x in [*PAYLOAD, "__silver_commit_ts"])
        return f"""SELECT {cols} FROM {cur} c FULL JOIN {new} n ON c.order_id = n.order_id
    WHERE NOT coalesce(c.order_id IS NOT NULL AND n.__op = 'D', false) AND NOT (c.order_id IS NULL AND n.__op = 'D')"""

    return f"""
WITH feed AS ({FEED}),
parsed AS (SELECT {_OPS.format("Op")} AS __op, 'orders' AS __table, commit_timestamp AS __commit_ts, transaction_id AS __txn_id, seq AS __seq,
  transaction_id AS __source_pos, order_id, customer_id, order_amount, status, batch FROM feed),
marked AS (SELECT *, {reason} AS reason FROM parsed),
valid AS (SELECT * EXCLUDE (reason) FROM marked WHERE reason IS NULL),
latest AS (SELECT *, {best.format("batch, ")} AS rn, __commit_ts AS __silver_commit_ts FROM valid),
b0 AS (SELECT * FROM latest WHERE batch = 0 AND rn = 1),
b1 AS (SELECT * FROM latest WHERE batch = 1 AND rn = 1),
none AS (SELECT order_id, customer_id, order_amount, status, __silver_commit_ts FROM b0 WHERE false),
state0 AS ({applied("none", "b0")}),
kept AS (SELECT b1.* FROM b1 LEFT JOIN state0 USING (order_id) WHERE state0.__silver_commit_ts IS NULL OR b1.__commit_ts > state0.__silver_commit_ts),
state1 AS ({applied("state0", "kept")}),
overall AS (SELECT *, {best.format("")} AS rn FROM valid)
{last}
"""


_CANONICAL = "__op, __table, __commit_ts, __txn_id, __seq, __source_pos, order_id, customer_id, order_amount, status"
_TWO = _with("SELECT * FROM state1")

ORACLE_SQL: dict[str, str] = {
    "gold_daily_sales": _DAILY,
    "gold_order_status": _STATUS,
    "gold_customer_metrics": _CUSTOMERS,
    "gold_product_metrics": _PRODUCTS,
    "serve_recent_days": f"SELECT * FROM ({_DAILY}) ORDER BY date DESC LIMIT 30",
    "serve_top_customers": f"SELECT * FROM ({_CUSTOMERS}) ORDER BY lifetime_value DESC, customer_id LIMIT 20",
    "serve_top_products": f"SELECT * FROM ({_PRODUCTS}) ORDER BY units_sold DESC, product_id LIMIT 20",
    "serve_status_over_time": f"SELECT * FROM ({_STATUS}) ORDER BY date DESC, status",
    "op_normalise": f"""SELECT event_id, {_OPS.format("raw")} AS op FROM (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN ' ' || upper(event_type)
      WHEN event_id % 3 = 1 THEN ['load', 'I ', 'Update', 'd', 'x'][event_id % 5 + 1] END AS raw FROM events)""",
    "cdc_feed": FEED,
    "cdc_parse_flat": _with(f"SELECT {_CANONICAL} FROM parsed"),
    "cdc_parse_nested": f"""SELECT {_OPS.format("event_type")} AS __op, CASE WHEN event_id % 5 <> 0 THEN 'orders' ELSE 'unnamed' END AS __table,
      CASE WHEN event_id % 13 <> 0 THEN date_trunc('second', ts) END AS __commit_ts, CAST(event_id AS STRING) AS __txn_id, event_id * 2 AS __seq,
      CAST(event_id AS STRING) AS __source_pos, user_id AS order_id, value AS order_amount FROM events WHERE event_id % 7 <> 0 AND event_id % 11 <> 0""",
    "dq_valid": _with(f"SELECT {_CANONICAL} FROM valid"),
    "dq_invalid_reasons": _with("SELECT __seq AS seq, reason FROM marked WHERE reason IS NOT NULL"),
    "quarantine_shape": _with("SELECT __seq AS seq, status, reason AS error_reason, 'orders' AS table_name, 'b1' AS batch_id FROM marked WHERE reason IS NOT NULL"),
    "dedup_rank": _with("SELECT order_id, __seq AS seq, row_number() OVER (PARTITION BY order_id ORDER BY __commit_ts DESC, __txn_id DESC, __seq DESC)::INT AS rn FROM (SELECT DISTINCT * FROM valid)"),
    "dedup_latest": _with(f"SELECT {_CANONICAL} FROM overall WHERE rn = 1"),
    "duplicate_count": _with("SELECT CAST(count(*) - count(DISTINCT order_id) AS BIGINT) AS duplicates FROM valid"),
    "op_counts": _with("SELECT __op AS op, count(*) AS n FROM valid GROUP BY 1"),
    "stale_guard": _with("SELECT order_id, customer_id, order_amount, status, __op AS op, __commit_ts AS at FROM kept"),
    "apply_batch": _with("SELECT * FROM state0"),
    "apply_two_batches": _TWO,
    "store_two_batches": _TWO,
    "compaction_equivalence": _TWO,
    "snapshot_as_of": _with("SELECT * FROM state0"),
    "batch_accounting": _with("""SELECT (SELECT count(*) FROM marked WHERE batch = 1) AS source, (SELECT count(reason) FROM marked WHERE batch = 1) AS rejected,
      (SELECT count(*) FROM valid WHERE batch = 1) - (SELECT count(*) FROM b1) AS duplicates, (SELECT count(*) FROM b1) - (SELECT count(*) FROM kept) AS stale,
      (SELECT count(*) FROM kept WHERE __op = 'I') AS inserts, (SELECT count(*) FROM kept WHERE __op = 'U') AS updates, (SELECT count(*) FROM kept WHERE __op = 'D') AS deletes"""),
    "store_snapshots": "SELECT * FROM (VALUES (1::BIGINT, 'create'), (2, 'apply'), (3, 'apply')) t(snapshot_id, operation)",
    "orphan_check": "SELECT l_orderkey, l_partkey, l_linenumber FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey)",
    "orders_without_items": "SELECT o_orderkey, o_custkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)",
    "schema_diff": """SELECT * FROM (VALUES (true, false, false, 'added=coupon; removed=o_orderstatus; incompatible=o_custkey(bigint->int),o_orderdate(timestamp_ntz->timestamp)'))
      t(breaking, additive, empty, summary)""",
    "bronze_stream_roundtrip": "SELECT event_id, strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day, strftime(ts, '%H') AS hour FROM events",
}
