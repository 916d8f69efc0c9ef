"""Inputs of change records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.model import PAYLOADS, envelope_schema


def read_json_prefix(spark: SparkSession, path: str, schema: T.StructType | None = None, glob: str | None = None) -> DataFrame:
    """JSON records anywhere below a path; inferred only where no schema is given."""
    reader = spark.read.option("recursiveFileLookup", "true")
    if schema is not None:
        reader = reader.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.json(path)


def read_full_load(spark: SparkSession, path: str, table: str) -> DataFrame:
    """A full-load export (Parquet); rows without an operation column are inserts."""
    df = spark.read.parquet(path)
    return df if {"Op", "op", "__op"} & set(df.columns) else df.withColumn("Op", F.lit("load"))


def read_bronze(spark: SparkSession, path: str, table: str, where: str | None = None, payload: T.StructType | None = None) -> DataFrame:
    """Envelopes of one table from Bronze, parsed by declared schema; partitions picked by ``where``."""
    raw = spark.read.schema("json_str string, arrival_ts timestamp, year string, month string, day string, hour string").parquet(path)
    if where:
        raw = raw.where(where)
    schema = envelope_schema(payload if payload is not None else PAYLOADS[table])
    rows = raw.select(F.from_json("json_str", schema).alias("e")).select("e.*")
    return rows.where(F.coalesce(F.col("metadata")["table-name"], F.lit(table)) == table)


def payload_keys(bronze: DataFrame) -> list[str]:
    """Keys that the payloads in Bronze have, declared or not: what schema drift shows up in."""
    keys = bronze.select(F.explode(F.json_object_keys(F.get_json_object("json_str", "$.data"))).alias("k"))
    return sorted(r.k for r in keys.distinct().collect())


def has_data(spark: SparkSession, path: str, most: int = 10) -> dict:
    """Whether objects lie below a path, and how many, counting up to ``most``."""
    jvm = spark.sparkContext._jvm
    top = jvm.org.apache.hadoop.fs.Path(path)
    fs = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    n = 0
    if fs.exists(top):
        files = fs.listFiles(top, True)
        while files.hasNext() and n < most:
            status = files.next()
            n += status.getLen() > 0 and not status.getPath().getName().startswith(("_", "."))
    return {"has_data": n > 0, "object_count": int(n)}
