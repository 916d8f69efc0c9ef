"""Streaming ingest: change records to append-only Parquet, by hour of arrival."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

RAW = "data binary, approximateArrivalTimestamp timestamp"
PARTITIONS = {"year": "yyyy", "month": "MM", "day": "dd", "hour": "HH"}


def file_stream(spark: SparkSession, path: str, fmt: str = "parquet", schema: str = RAW, max_files: int | None = None) -> DataFrame:
    """Raw records from files that appear below a path, oldest first."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def decoded(raw: DataFrame) -> DataFrame:
    """json_str, arrival_ts and the columns of the arrival hour, as zero-padded text."""
    rows = raw.select(F.col("data").cast("string").alias("json_str"), F.col("approximateArrivalTimestamp").alias("arrival_ts"))
    return rows.select("*", *[F.date_format("arrival_ts", f).alias(n) for n, f in PARTITIONS.items()])


def start(raw: DataFrame, path: str, checkpoint: str, every: str | None = "60 seconds") -> StreamingQuery:
    """Append to Bronze, exactly once for each checkpoint; ``every`` None takes what is there and stops.

    A fresh checkpoint replays the source from its start.
    """
    writer = decoded(raw).writeStream.format("parquet").outputMode("append").partitionBy(*PARTITIONS).option("path", path).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)
    return writer.start()
