"""Queries over the aggregates. Ties are broken by key, so limits are deterministic."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def recent_days(daily: DataFrame, n: int = 30) -> DataFrame:
    return daily.orderBy(F.col("date").desc()).limit(n)


def top_customers(metrics: DataFrame, n: int = 20) -> DataFrame:
    return metrics.orderBy(F.col("lifetime_value").desc(), "customer_id").limit(n)


def top_products(metrics: DataFrame, n: int = 20) -> DataFrame:
    return metrics.orderBy(F.col("units_sold").desc(), "product_id").limit(n)


def status_over_time(status: DataFrame) -> DataFrame:
    return status.orderBy(F.col("date").desc(), F.col("status").asc())
