"""Session settings that the operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: UTC so that a timestamp's date does not depend on where it runs; adaptive
#: execution for partition sizes, broadcasts by measured size and skewed joins.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",
    "spark.scheduler.mode": "FAIR",
}


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in {**SETTINGS, **conf}.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()
