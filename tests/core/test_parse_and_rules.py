import itertools

import pytest
from pyspark.sql import functions as F

from tidemark.config import DQRule, TableConfig, parse_config
from tidemark.model import CONTROL
from tidemark.operators import evolution, ordering
from tidemark.operators.apply import apply_changes, with_watermark
from tidemark.operators.envelope import parse, parse_flat, parse_nested
from tidemark.operators.validation import REASON, split_valid_invalid, to_quarantine_records

RULES = [DQRule("order_id", "not_null"), DQRule("customer_id", "not_null"), DQRule("order_amount", "non_negative"), DQRule("status", "allowed_values", ("PLACED", "SHIPPED", "DELIVERED", "CANCELLED"))]


def test_flat_records(spark):
    rows = [("I", "1", "PLACED", "10", "2026-01-01 00:00:00", "tx1", 1), ("U", "1", "SHIPPED", "10", "2026-01-01 00:01:00", "tx2", 2), ("D", "1", "x", "10", "bad time", None, None)]
    df = spark.createDataFrame(rows, "Op string, order_id string, status string, order_amount string, commit_timestamp string, transaction_id string, seq long")
    got = parse(df, "orders")
    assert tuple(got.columns[:6]) == CONTROL and "commit_timestamp" in got.columns
    out = got.collect()
    assert [r["__op"] for r in out] == ["I", "U", "D"] and out[0]["__txn_id"] == out[0]["__source_pos"] == "tx1" and out[2]["__commit_ts"] is None
    assert parse_flat(df, "orders", keep_control_source=False).columns[6:] == ["order_id", "status", "order_amount"]


def test_spellings_and_missing_controls(spark):
    df = spark.createDataFrame([(o, str(k)) for k, o in enumerate(["load", " INSERT ", "update", "delete", "weird", None])], "op string, id string")
    out = parse(df, "t").collect()
    assert [r["__op"] for r in out] == ["I", "I", "U", "D", None, None]
    assert all(r["__commit_ts"] is None and r["__seq"] is None for r in out)
    with pytest.raises(ValueError, match="Op"):
        parse_flat(df.drop("op"), "t")


def test_nested_records(spark):
    rows = [
        '{"metadata": {"operation": "insert", "record-type": "data", "table-name": "orders", "transaction-id": 10, "commit-timestamp": "2026-01-01T00:00:00Z", "transaction-record-id": 3}, "data": {"order_id": 1, "status": "PLACED"}}',
        '{"metadata": {"operation": "create-table", "record-type": "control", "transaction-id": 11}, "data": {"order_id": null}}',
        '{"metadata": {"operation": "update", "record-type": null}, "data": {"order_id": 2}}',
    ]
    schema = "metadata struct<operation: string, `record-type`: string, `table-name`: string, `transaction-id`: bigint, `commit-timestamp`: string, `transaction-record-id`: bigint>, data struct<order_id: bigint, status: string>"
    df = spark.createDataFrame([(r,) for r in rows], "j string").select(F.from_json("j", schema).alias("e")).select("e.*")
    (row,) = parse(df, "fallback").collect()
    assert row["__txn_id"] == "10" and row["__table"] == "orders" and row["__seq"] == 3 and row["order_id"] == 1
    with pytest.raises(ValueError, match="metadata"):
        parse_nested(df.drop("data"), "t")


@pytest.fixture
def rows(spark):
    data = [(1, 10, 5.0, "PLACED", "I"), (2, 10, 0.0, "SHIPPED", "U"), (None, 10, 5.0, "PLACED", "I"), (4, 10, -5.0, "SHIPPING", "U"), (5, 10, 1.0, "PLACED", "X"), (6, 1, -1.0, "odd", "D"), (7, 1, 1.0, "PLACED", None), (8, None, None, None, "D")]
    return spark.createDataFrame(data, "order_id long, customer_id long, order_amount double, status string, __op string")


def test_valid_and_rejected(rows):
    valid, bad = split_valid_invalid(rows, RULES)
    assert sorted(r.order_id for r in valid.collect()) == [1, 2, 6]
    why = {r.order_id: r[REASON] for r in bad.collect()}
    assert why[4] == "order_amount < 0; status NOT IN ('PLACED', 'SHIPPED', 'DELIVERED', 'CANCELLED')"
    assert why[None] == "order_id IS NULL" and why[5] == "invalid op: X" and why[7] == "invalid op: <null>" and why[8] == "customer_id IS NULL"
    assert 8 in {r.order_id for r in split_valid_invalid(rows, RULES, ["order_id"])[0].collect()}
    q = to_quarantine_records(bad, "orders", "b1")
    assert q.columns == ["original_event", "error_reason", "table_name", "processing_time", "batch_id"]
    assert not any(REASON in r.original_event for r in q.collect())


def test_text_that_is_no_number_or_time(spark):
    df = spark.createDataFrame([(1, "abc", "2026-01-01", "I"), (2, "-1", "nonsense", "I"), (3, None, None, "I")], "id long, amount string, at string, __op string")
    valid, bad = split_valid_invalid(df, [DQRule("amount", "non_negative"), DQRule("at", "valid_timestamp")])
    assert sorted(r.id for r in valid.collect()) == [1, 3]
    assert bad.first()[REASON] == "amount < 0; at is not a valid timestamp"


ORDERED = "order_id long, __op string, __txn_id string, __seq long, status string, __commit_ts timestamp"


def at(n):
    import datetime

    return None if n is None else datetime.datetime(2026, 1, 1, 0, n)


def test_latest_is_the_same_in_any_order(spark):
    data = [(1, "I", "tx1", 1, "PLACED", at(0)), (1, "U", "tx2", 2, "SHIPPED", at(5)), (1, "U", "tx2", 3, "DELIVERED", at(5)), (1, "U", None, 9, "LOST", None), (2, "I", "tx3", 1, "A", at(1)), (2, "I", "tx3", 1, "B", at(1)), (None, "I", "t", 1, "N", at(0))]
    results = set()
    for order in itertools.islice(itertools.permutations(data), 0, 5040, 720):
        got = ordering.latest_per_key(spark.createDataFrame(list(order), ORDERED), ["order_id"]).collect()
        results.add(tuple(sorted((str(r.order_id), r.status) for r in got)))
    assert len(results) == 1 and ("1", "DELIVERED") in next(iter(results))
    df = spark.createDataFrame(data, ORDERED)
    assert ordering.count_duplicates(df, ["order_id"]) == 4 and ordering.count_duplicates(df.limit(0), ["order_id"]) == 0
    with pytest.raises(ValueError):
        ordering.add_rank(df, [])


def test_transaction_numbers(spark):
    df = spark.createDataFrame([(1, "U", "tx9", 1, "old", at(0)), (1, "U", "tx10", 1, "new", at(0))], ORDERED)
    assert ordering.latest_per_key(df, ["order_id"]).first().status == "old"  # as text
    assert ordering.latest_per_key(df, ["order_id"], numeric_txn=True).first().status == "new"


def test_stale_changes_are_dropped(spark):
    inc = spark.createDataFrame([(1, "U", "t", 1, "s", at(1)), (2, "U", "t", 1, "s", at(9)), (3, "I", "t", 1, "s", at(0)), (4, "U", "t", 1, "s", at(5)), (5, "U", "t", 1, "s", None), (6, "U", "t", 1, "s", at(0)), (None, "I", "t", 1, "s", at(0))], ORDERED)
    cur = spark.createDataFrame([(1, at(5)), (2, at(5)), (4, at(5)), (5, at(5)), (6, None)], "order_id long, __silver_commit_ts timestamp")
    kept = ordering.guard_stale_updates(inc, cur, ["order_id"], "__silver_commit_ts")
    assert sorted(str(r.order_id) for r in kept.collect()) == ["2", "3", "6", "None"]
    stones = spark.createDataFrame([(3, at(2))], "order_id long, __silver_commit_ts timestamp")
    assert 3 not in {r.order_id for r in ordering.guard_stale_updates(inc, cur, ["order_id"], "__silver_commit_ts", stones).collect()}
    with pytest.raises(ValueError):
        ordering.guard_stale_updates(inc, cur.drop("order_id"), ["order_id"], "__silver_commit_ts")


@pytest.mark.parametrize(("mode", "matched_insert"), [("ignore", "old"), ("upsert", "new")])
def test_apply_matrix(spark, mode, matched_insert):
    cur = spark.createDataFrame([(k, "old", 1) for k in (1, 2, 3, 9)], "id long, v string, extra int")
    new = [(1, "I"), (2, "U"), (3, "D"), (4, "I"), (5, "U"), (6, "D"), (7, None)]
    changes = with_watermark(spark.createDataFrame([(k, o, "new", at(1)) for k, o in new], "id long, __op string, v string, __commit_ts timestamp"))
    got = {r.id: (r.v, r.extra) for r in apply_changes(cur, changes, ["id"], mode).collect()}
    assert got == {1: (matched_insert, 1 if matched_insert == "old" else None), 2: ("new", None), 4: ("new", None), 5: ("new", None), 9: ("old", 1)}
    with pytest.raises(ValueError):
        apply_changes(cur, changes, ["id"], "other")


@pytest.mark.parametrize(
    ("old", "new", "kind", "text"),
    [
        ([("a", "int")], [("a", "int"), ("__op", "string")], "is_empty", "no change"),
        ([("a", "int")], [("a", "int"), ("b", "string")], "is_additive", "added=b"),
        ([("a", "int"), ("b", "int")], [("a", "int")], "is_breaking", "removed=b"),
        ([("a", "string")], [("a", "int")], "is_breaking", "incompatible=a(string->int)"),
        ([("a", "int"), ("b", "float")], [("a", "BIGINT"), ("b", "double")], "is_widening", "promoted=a(int->bigint),b(float->double)"),
        ([("a", "decimal(10,2)")], [("a", "decimal(12,2)")], "is_widening", "promoted=a(decimal(10,2)->decimal(12,2))"),
        ([("a", "decimal(12,2)")], [("a", "decimal(12,3)")], "is_breaking", "incompatible=a(decimal(12,2)->decimal(12,3))"),
    ],
)
def test_schema_diff(old, new, kind, text):
    diff = evolution.diff_schema(old, new)
    assert getattr(diff, kind) and diff.summary() == text


RAW = {
    "environment": "dev", "bronze_bucket": "b", "silver_warehouse": "w", "reject_prefix": "r", "glue_database": "d", "audit_table": "a", "sns_topic_arn": "t",
    "tables": {"orders": {"primary_keys": ["order_id"], "order_by": ["__commit_ts"], "silver_table": "s.orders", "dq_rules": [{"column": "order_id", "kind": "not_null"}]}},
}


def test_config(tmp_path):
    cfg = parse_config(RAW, {"CDC_ENVIRONMENT": "prod", "CDC_AUDIT_TABLE": ""})
    assert cfg.environment == "prod" and cfg.audit_table == "a" and cfg.table("orders").dq_rules[0].kind == "not_null"
    with pytest.raises(KeyError, match="orders"):
        cfg.table("other")
    with pytest.raises(ValueError, match="glue_database"):
        parse_config({**RAW, "glue_database": ""}, {})
    for bad in (lambda: DQRule("a", "odd"), lambda: DQRule("a", "allowed_values"), lambda: TableConfig("t", [], ["x"], "s"), lambda: TableConfig("t", ["x"], [], "s")):
        with pytest.raises(ValueError):
            bad()
    import yaml

    from tidemark.config import load_config

    (tmp_path / "c.yaml").write_text(yaml.safe_dump(RAW))
    assert load_config(str(tmp_path / "c.yaml"), {}).tables.keys() == {"orders"}
