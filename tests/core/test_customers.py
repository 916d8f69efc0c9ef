"""Customer metrics over whole tables, and customers without orders."""

import datetime

import duckdb
import pytest

from tidemark.plans import gold, registry

ALL = """SELECT c_custkey, count(o_orderkey), CAST(coalesce(sum(CAST(o_totalprice AS DECIMAL(12, 2))), 0) AS DOUBLE) AS v, max(o_orderdate)
FROM '{0}/customer.parquet' LEFT JOIN '{0}/orders.parquet' ON c_custkey = o_custkey GROUP BY 1"""


@pytest.mark.parametrize(("name", "last"), [("gold_customer_metrics", ""), ("serve_top_customers", " ORDER BY v DESC, c_custkey LIMIT 20")])
def test_all_orders_count(spark, sf, name, last):
    got = registry.QUERIES[name](spark, sf).select("customer_id", "total_orders", "lifetime_value", "last_order_date").collect()
    assert sorted(map(tuple, got)) == sorted(duckdb.sql(ALL.format(sf) + last).fetchall())


def test_customers_without_orders(spark):
    day = datetime.datetime(1992, 1, 2)
    customers = spark.createDataFrame([(1,), (2,)], "customer_id long")
    orders = spark.createDataFrame([(7, 1, day, 2.5), (8, 3, day, 1.0)], "order_id long, customer_id long, order_date timestamp_ntz, order_amount double")
    got = sorted(map(tuple, gold.customer_metrics(customers, orders).collect()))
    assert got == [(1, 1, 2.5, day), (2, 0, 0.0, None)]
