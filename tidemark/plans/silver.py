"""The core job: a batch of change records into current state.

parse, schema gate, validate, quarantine, newest per key, stale guard, apply,
ledger and audit. The annotated batch is read and parsed once and kept while the
job runs; rejected rows overwrite the batch's own folder, so a retry leaves no
second copy; state and ledger are published by one manifest.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import alerts
from tidemark.audit import AuditRecord
from tidemark.audit import write as write_audit
from tidemark.config import TableConfig
from tidemark.model import DELETE, INSERT, OP, UPDATE, WATERMARK
from tidemark.operators import evolution
from tidemark.operators.apply import payload_columns, with_watermark
from tidemark.operators.envelope import parse
from tidemark.operators.ordering import guard_stale_updates, latest_per_key
from tidemark.operators.validation import REASON, annotate, to_quarantine_records
from tidemark.store import Store

APPLIED, SCHEMA_BREAK = 0, 2


@dataclass
class SilverJob:
    store: Store
    table: TableConfig
    reject_path: str
    audit_path: str
    environment: str = "dev"
    topic: str = ""
    send: object = None
    buckets: int = 16
    insert_on_match: str = "ignore"

    def _alert(self, subject: str, record: AuditRecord, error: str) -> None:
        text = alerts.failure_message("cdc-silver", self.environment, f"silver:{self.table.name}", record.source_records, record.processed_records, record.reject_count, error)
        alerts.publish(self.send, self.topic, subject, text)

    def _audit(self, record: AuditRecord) -> None:
        write_audit(self.store.spark, self.audit_path, record)

    def run(self, raw: DataFrame, batch_id: str) -> int:
        """0: applied, now or before; 2: the schema broke; errors are audited, told and raised."""
        record = AuditRecord(batch_id, self.table.name)
        try:
            return self._run(raw, batch_id, record)
        except Exception as e:
            self._audit(record.failed(f"{type(e).__name__}: {e}"))
            self._alert(alerts.STEP_FAILURE, record, str(e))
            raise

    def _run(self, raw: DataFrame, batch_id: str, record: AuditRecord) -> int:
        t, store = self.table, self.store
        name = t.silver_table
        if store.exists(name) and store.applied(name, batch_id):
            self._audit(record.skipped())
            return APPLIED
        # Columns that rules name but this batch lacks are null, so the rules apply.
        parsed = parse(raw, t.name)
        absent = [r.column for r in t.dq_rules if r.column not in parsed.columns]
        parsed = parsed.select("*", *[F.lit(None).cast("string").alias(c) for c in dict.fromkeys(absent)])
        marked = annotate(parsed, t.dq_rules, t.primary_keys).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            declared = with_watermark(parsed.drop(*absent))
            schema = declared.select(*payload_columns(declared)).schema
            if not store.exists(name):
                store.ensure(name, schema, t.primary_keys, self.buckets)
            diff = evolution.diff_schema(evolution.pairs(store.manifest(name).struct), evolution.pairs(schema))
            if diff.is_breaking:
                self._audit(record.failed(f"schema break: {diff.summary()}"))
                self._alert(alerts.SCHEMA_BREAK, record, diff.summary())
                return SCHEMA_BREAK
            if added := diff.of(evolution.ADDED):
                store.add_columns(name, [(c.column, c.new) for c in added])
            if widened := diff.of(evolution.PROMOTED):
                store.widen_columns(name, [(c.column, c.old, c.new) for c in widened])
            rejected = marked.where(F.col(REASON).isNotNull())
            to_quarantine_records(rejected, t.name, batch_id).write.mode("overwrite").json(f"{self.reject_path}/{t.name}/batch_id={batch_id}")
            valid = marked.where(F.col(REASON).isNull()).drop(REASON, *absent)
            newest = latest_per_key(valid, t.primary_keys, t.order_by)
            current = store.read(name).select(*t.primary_keys, WATERMARK)
            kept = with_watermark(guard_stale_updates(newest, current, t.primary_keys, WATERMARK)).persist(StorageLevel.MEMORY_AND_DISK)
            try:
                total = marked.agg(F.count("*").alias("n"), F.count(REASON).alias("bad")).first()
                keys = valid.select(*t.primary_keys).distinct().count()
                ops = kept.agg(*[F.count_if(F.col(OP) == o).alias(o) for o in (INSERT, UPDATE, DELETE)]).first()
                counts = {
                    "source_records": total.n,
                    "reject_count": total.bad,
                    "duplicate_count": total.n - total.bad - keys,
                    "insert_count": ops[INSERT],
                    "update_count": ops[UPDATE],
                    "delete_count": ops[DELETE],
                    "processed_records": ops[INSERT] + ops[UPDATE] + ops[DELETE],
                }
                record = record.counted(**counts)
                store.apply(name, kept, batch_id, counts, self.insert_on_match)
            finally:
                kept.unpersist()
        finally:
            marked.unpersist()
        self._audit(record.succeeded())
        return APPLIED

    def rebuild(self, raw: DataFrame, batch_id: str) -> None:
        """State from all history at once, replacing what is stored in one commit."""
        t = self.table
        marked = annotate(parse(raw, t.name), t.dq_rules, t.primary_keys)
        newest = with_watermark(latest_per_key(marked.where(F.col(REASON).isNull()).drop(REASON), t.primary_keys, t.order_by))
        state = newest.where(F.col(OP) != DELETE).select(*payload_columns(newest))
        self.store.replace(t.silver_table, state, t.primary_keys, self.buckets)
