"""Aggregates over current state. Sums are of decimals, so order doesn't matter."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _amount(name: str):
    return F.col(name).cast("decimal(12,2)")


def daily_sales(orders: DataFrame) -> DataFrame:
    """Per day: orders, delivered, cancelled, revenue, and average value to the cent."""
    return orders.groupBy(F.col("order_date").cast("date").alias("date")).agg(
        F.count("*").alias("total_orders"),
        F.count_if(F.col("status") == "DELIVERED").alias("delivered_orders"),
        F.count_if(F.col("status") == "CANCELLED").alias("cancelled_orders"),
        F.sum(_amount("order_amount")).cast("double").alias("total_revenue"),
        F.round(F.avg(_amount("order_amount")), 2).cast("double").alias("average_order_value"),
    )


def order_status(orders: DataFrame) -> DataFrame:
    """Per day and status: orders."""
    return orders.groupBy(F.col("order_date").cast("date").alias("date"), "status").agg(F.count("*").alias("order_count"))


def customer_metrics(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Per customer, those without orders too: orders, lifetime value, last order.

    Orders are summed by customer before the join, which the key of customers
    being unique makes exact: one row a customer crosses the join, not one an order.
    """
    per = orders.groupBy(F.col("customer_id").alias("__c")).agg(F.count("order_id").alias("n"), F.sum(_amount("order_amount")).alias("v"), F.max("order_date").alias("last_order_date"))
    joined = customers.select("customer_id").distinct().join(per, F.col("customer_id").eqNullSafe(F.col("__c")) & F.col("customer_id").isNotNull(), "left")
    return joined.select("customer_id", F.coalesce("n", F.lit(0)).alias("total_orders"), F.coalesce("v", F.lit(0)).cast("double").alias("lifetime_value"), "last_order_date")


def product_metrics(products: DataFrame, items: DataFrame) -> DataFrame:
    """Per product, those never ordered too: units sold, and orders that contain it."""
    per = items.groupBy(F.col("product_id").alias("__p")).agg(F.sum("quantity").alias("u"), F.countDistinct("order_id").alias("n"))
    joined = products.select("product_id").distinct().join(per, F.col("product_id") == F.col("__p"), "left")
    return joined.select("product_id", F.coalesce("u", F.lit(0)).cast("bigint").alias("units_sold"), F.coalesce("n", F.lit(0)).alias("orders_containing"))
