import datetime
import json
import time

import pytest

from tidemark import alerts, audit
from tidemark.config import DQRule, TableConfig
from tidemark.plans import control
from tidemark.plans.silver import APPLIED, SCHEMA_BREAK, SilverJob
from tidemark.sources import readers
from tidemark.store import Conflict, Store
from tidemark.streaming import bronze

FLAT = "Op string, order_id long, status string, order_amount double, commit_timestamp string, transaction_id string, seq long"


def ev(op, key, status, minute, amount=1.0, seq=1):
    return (op, key, status, amount, f"2026-01-01 00:{minute:02d}:00", f"tx{minute:03d}", seq)


@pytest.fixture
def job(spark, tmp_path):
    rules = [DQRule("order_id", "not_null"), DQRule("status", "allowed_values", ["PLACED", "SHIPPED", "DELIVERED"]), DQRule("order_amount", "non_negative")]
    table = TableConfig("orders", ["order_id"], ["__commit_ts", "__txn_id", "__seq"], "silver_orders", rules)
    sent = []
    j = SilverJob(Store(spark, f"file://{tmp_path}/store"), table, f"file://{tmp_path}/reject", f"file://{tmp_path}/audit", topic="t", send=lambda *a: sent.append(a), buckets=4)
    j.sent = sent
    return j


def state(job, **at):
    return {r.order_id: r.status for r in job.store.read("silver_orders", **at).collect()}


def audits(job):
    return {r.batch_id: r for r in audit.latest(job.store.spark, job.audit_path).collect()}


def test_batches_ledger_and_accounting(spark, job):
    first = [ev("I", 101, "PLACED", 0), ev("U", 101, "DELIVERED", 5), ev("U", 101, "SHIPPED", 3), ev("I", 102, "PLACED", 0), ev("I", 103, "PLACED", 1), ev("I", 103, "PLACED", 1), ev("I", 104, "TELEPORTED", 1), ev("I", None, "PLACED", 1), ev("I", 105, "PLACED", 1, -4.0)]
    assert job.run(spark.createDataFrame(first, FLAT), "b1") == APPLIED
    assert state(job) == {101: "DELIVERED", 102: "PLACED", 103: "PLACED"}
    second = [ev("D", 102, None, 9, None), ev("U", 101, "PLACED", 4), ev("U", 104, "SHIPPED", 9), ev("weird", 1, "PLACED", 9)]
    assert job.run(spark.createDataFrame(second, FLAT), "b2") == APPLIED
    after = state(job)
    assert after == {101: "DELIVERED", 103: "PLACED", 104: "SHIPPED"}
    seen = job.store.versions("silver_orders")
    assert job.run(spark.createDataFrame(second, FLAT), "b2") == APPLIED  # again: nothing happens
    assert job.store.versions("silver_orders") == seen and state(job) == after
    got = audits(job)
    a, b = got["b1"], got["b2"]
    assert (a.source_records, a.reject_count, a.duplicate_count, a.insert_count, a.update_count, a.status) == (9, 3, 3, 2, 1, "SUCCESS")
    assert (b.source_records, b.reject_count, b.update_count, b.delete_count, b.status) == (4, 1, 1, 1, "SUCCESS")
    rejects = spark.read.json(f"{job.reject_path}/orders")
    assert rejects.count() == 4 and set(rejects.columns) == {"original_event", "error_reason", "table_name", "processing_time", "batch_id"}
    first_version = next(m for m in map(lambda v: job.store.manifest("silver_orders", v), seen) if "b1" in m.ledger)
    assert state(job, as_of=first_version.committed_at)[102] == "PLACED" and state(job, version=first_version.version)[102] == "PLACED"
    job.rebuild(spark.createDataFrame(first + second, FLAT), "all")
    assert state(job) == after


def test_schema_gate(spark, job):
    job.run(spark.createDataFrame([ev("I", 1, "PLACED", 0)], FLAT), "b1")
    more = spark.createDataFrame([(*ev("I", 2, "PLACED", 1), "x")], FLAT + ", coupon string")
    assert job.run(more, "b2") == APPLIED
    assert {(r.order_id, r.coupon) for r in job.store.read("silver_orders").collect()} == {(1, None), (2, "x")}
    less = more.drop("status", "coupon")
    assert job.run(less, "b3") == SCHEMA_BREAK and audits(job)["b3"].status == "FAILED"
    assert job.sent[-1][1] == alerts.SCHEMA_BREAK and "removed=status" in job.sent[-1][2]
    with pytest.raises(ValueError):
        job.run(more.drop("Op"), "b4")
    assert audits(job)["b4"].status == "FAILED" and job.sent[-1][1] == alerts.STEP_FAILURE


def test_widening(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/s")
    store.replace("t", spark.createDataFrame([(1, 2)], "id long, n int"), ["id"])
    store.widen_columns("t", [("n", "int", "bigint")])
    assert dict(store.read("t").dtypes)["n"] == "bigint" and store.read("t").first().n == 2


def test_a_crash_before_publication_leaves_no_trace(spark, job, monkeypatch):
    job.run(spark.createDataFrame([ev("I", 1, "PLACED", 0)], FLAT), "b1")
    before = state(job)
    monkeypatch.setattr(job.store, "_publish", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        job.run(spark.createDataFrame([ev("I", 2, "PLACED", 1)], FLAT), "b2")
    monkeypatch.undo()
    assert state(job) == before and not job.store.applied("silver_orders", "b2")
    assert job.run(spark.createDataFrame([ev("I", 2, "PLACED", 1)], FLAT), "b2") == APPLIED and set(state(job)) == {1, 2}
    orphans = job.store.remove_orphans("silver_orders", time.time() + 60)
    assert orphans and set(state(job)) == {1, 2}


def test_two_writers_conflict(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/s")
    store.replace("t", spark.range(3).toDF("id"), ["id"])
    m = store.manifest("t")
    store.replace("t", spark.range(4).toDF("id"), ["id"])
    with pytest.raises(Conflict):
        store._publish("t", m.__class__(**{**m.__dict__, "version": 2}))
    with pytest.raises(ValueError):
        store.read("t", as_of=0.0)
    with pytest.raises(ValueError):
        store.read("absent")


def test_only_touched_buckets_are_rewritten(spark, tmp_path):
    from tidemark.operators.apply import with_watermark

    store = Store(spark, f"file://{tmp_path}/s")
    state = spark.range(100).selectExpr("id", "'old' AS v", "timestamp'2026-01-01' AS __silver_commit_ts")
    store.replace("t", state, ["id"], 8)
    before = store.manifest("t").files
    change = with_watermark(spark.createDataFrame([(7, "U", "new", datetime.datetime(2026, 1, 2))], "id long, __op string, v string, __commit_ts timestamp"))
    after = store.apply("t", change, "b").files
    assert sum(before[b] != after[b] for b in before) == 1
    assert {r.v for r in store.read("t").where("id = 7").collect()} == {"new"} and store.read("t").count() == 100


def test_maintenance(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/s")
    for k in range(7):
        store.replace("t", spark.range(200).toDF("id").repartition(6), ["id"])
    warned = []
    done = control.maintain(store, ["t", "absent"], retention_days=0, keep=2, warn=warned.append, at=time.time() + 60)
    assert done["t"]["compacted"] and len(done["t"]["expired"]) == 6 and len(done["t"]["orphans"]) == 6
    assert len(warned) == 1 and store.read("t").count() == 200
    assert [r.operation for r in store.snapshots("t").orderBy("snapshot_id").collect()] == ["replace", "compact"]


def test_stream_restarts_without_copies(spark, tmp_path):
    root = f"file://{tmp_path}"
    record = json.dumps({"metadata": {"operation": "insert", "record-type": "data", "table-name": "orders"}, "data": {"order_id": 5, "coupon": "c"}})
    raw = spark.createDataFrame([(bytearray(record.encode()), datetime.datetime(2026, 1, 2, 3, 4))], bronze.RAW)
    for n in (1, 2, 2):
        if n == 2:
            raw = raw.limit(1)
        raw.write.mode("append").parquet(f"{root}/in") if n == 1 or not (tmp_path / "done").exists() else None
        (tmp_path / "done").touch() if n == 2 else None
        bronze.start(bronze.file_stream(spark, f"{root}/in", max_files=1), f"{root}/bronze", f"{root}/cp", every=None).awaitTermination()
        assert spark.read.parquet(f"{root}/bronze").count() == n
    rows = readers.read_bronze(spark, f"{root}/bronze", "orders", "year = '2026' AND hour = '03'")
    assert rows.count() == 2 and rows.first().data.order_id == 5
    assert readers.payload_keys(spark.read.parquet(f"{root}/bronze")) == ["coupon", "order_id"]
    assert readers.has_data(spark, f"{root}/in", most=1) == {"has_data": True, "object_count": 1}
    assert readers.has_data(spark, f"{root}/nowhere") == {"has_data": False, "object_count": 0}


def test_full_load_and_json(spark, tmp_path):
    root = f"file://{tmp_path}"
    spark.createDataFrame([(1, "a")], "id long, v string").write.option("compression", "gzip").parquet(f"{root}/full")
    assert readers.read_full_load(spark, f"{root}/full", "t").first().Op == "load"
    spark.createDataFrame([(1, "I")], "id long, Op string").write.json(f"{root}/j/deep/er")
    assert readers.read_json_prefix(spark, f"{root}/j", glob="*.json").count() == 1


def test_batch_control():
    told, ran, slept = [], [], []
    run = lambda silver, tables=("a", "b"), has=lambda t: True: control.run_batch(tables, has, silver, lambda: ran.append("gold"), lambda *a: told.append(a), sleep=slept.append)
    assert run(lambda t: 0, has=lambda t: False).status == "NO_DATA" and not told and not ran
    assert run(lambda t: 0).status == "SUCCESS" and ran == ["gold"]
    out = run(lambda t: 2 if t == "b" else 0)
    assert out.status == "FAILED" and ran == ["gold"] and "b: returned 2" in told[0][1]
    tries = []

    def flaky(t):
        tries.append(t)
        if len(tries) < 3:
            raise ConnectionError("busy")
        return 0

    assert run(flaky, tables=("a",)).status == "SUCCESS" and slept == [30.0, 60.0]
    assert run(lambda t: 1 / 0, tables=("a",)).status == "FAILED" and len(slept) == 2  # not transient: no retry


def test_timeout_cancels(spark):
    with pytest.raises(TimeoutError):
        control.with_timeout(spark, 0.5, "slow", lambda: time.sleep(1.5))
    assert control.with_timeout(spark, 30, "quick", lambda: spark.range(3).count()) == 3


def test_audit_and_alerts(spark, tmp_path):
    r = audit.AuditRecord("b", "orders").counted(insert_count=8200, update_count=42100, reject_count=100)
    assert r.status == "RUNNING" and r.item()["batch_table"] == "b#orders" and "end_time" not in r.item()
    assert r.succeeded().status == "SUCCESS" and len(r.failed("x" * 5000).error_message) == 2000
    path = f"file://{tmp_path}/audit"
    for x in (r, r.succeeded(), audit.AuditRecord("b", "orders").skipped()):
        audit.write(spark, path, x)
    (got,) = audit.latest(spark, path).collect()
    assert got.status == "SUCCESS" and got.update_count == 42100
    text = alerts.failure_message("p", "dev", "silver", 52481, 51800, 261, "boom", 3)
    assert text.startswith("CDC Pipeline Failure\n\nPipeline: p\n") and "Records received: 52,481" in text and "Retry attempts: 3" in text and text.endswith("Action:\nManual investigation required\n")
    assert alerts.publish(lambda *a: 1 / 0, "", "s", "m") is None
    assert len(alerts.publish(lambda topic, subject, message: subject, "t", "s" * 300, "m")) == 100
