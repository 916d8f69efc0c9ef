"""Audit records: an append-only log, one row for each state of a batch."""

from __future__ import annotations

from dataclasses import asdict, dataclass, field, replace
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SCHEMA = (
    "batch_id string, table_name string, start_time string, end_time string, source_records bigint, processed_records bigint, insert_count bigint,"
    " update_count bigint, delete_count bigint, duplicate_count bigint, reject_count bigint, status string, error_message string, batch_table string"
)
#: An error's text is kept up to so many characters.
MESSAGE_CHARS = 2000


def now() -> str:
    return datetime.now(timezone.utc).isoformat()


@dataclass(frozen=True)
class AuditRecord:
    batch_id: str
    table_name: str
    start_time: str = field(default_factory=now)
    end_time: str | None = None
    source_records: int = 0
    processed_records: int = 0
    insert_count: int = 0
    update_count: int = 0
    delete_count: int = 0
    duplicate_count: int = 0
    reject_count: int = 0
    status: str = "RUNNING"
    error_message: str | None = None

    def counted(self, **counts: int) -> AuditRecord:
        return replace(self, **counts)

    def succeeded(self) -> AuditRecord:
        return replace(self, status="SUCCESS", end_time=now())

    def skipped(self) -> AuditRecord:
        return replace(self, status="SKIPPED", end_time=now())

    def failed(self, message: str) -> AuditRecord:
        return replace(self, status="FAILED", end_time=now(), error_message=message[:MESSAGE_CHARS])

    def item(self) -> dict:
        """Fields that are set, and the key batch#table."""
        return {k: v for k, v in asdict(self).items() if v is not None} | {"batch_table": f"{self.batch_id}#{self.table_name}"}


def write(spark: SparkSession, path: str, record: AuditRecord) -> None:
    spark.createDataFrame([record.item()], SCHEMA).coalesce(1).write.mode("append").parquet(path)


def latest(spark: SparkSession, path: str) -> DataFrame:
    """The newest state of each batch and table; a skipped rerun doesn't hide the run that counted."""
    rows = spark.read.schema(SCHEMA).parquet(path)
    order = Window.partitionBy("batch_table").orderBy((F.col("status") == "SKIPPED").asc(), F.coalesce("end_time", "start_time").desc())
    return rows.withColumn("__rn", F.row_number().over(order)).where("__rn = 1").drop("__rn")
