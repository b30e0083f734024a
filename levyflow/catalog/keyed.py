"""Tables that are stored by key and merged into."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from levyflow.catalog.inputs import table
from levyflow.plans.keyed import KeyedTable, merge_keyed, store_keyed
from levyflow.sources.scratch import scratch_path

_ORDER = ["o_custkey", "o_orderdate", "o_orderkey", "o_orderpriority"]
_PRICE = ["l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice", "l_quantity"]
# Both sides of the join have as many buckets.
_BUCKETS = 16


def _as_day(df: DataFrame, name: str) -> DataFrame:
    return df.withColumn(name, F.date_format(name, "yyyyMMdd").cast("int"))


def _latest_orders(spark: SparkSession, sf_dir: str) -> KeyedTable:
    """The newest order of each customer, after three deliveries, of which the last repeats the first."""
    orders, root = table(spark, sf_dir, "orders").select(*_ORDER), scratch_path(spark, "latest")
    odd = F.col("o_orderkey") % 2 == 1
    store_keyed(orders.where(odd), root, ["o_custkey"], ["o_orderdate", "o_orderkey"], _BUCKETS)
    merge_keyed(orders.where(~odd), root)
    return merge_keyed(orders.where(odd), root)


def keyed_merge_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_day(_latest_orders(spark, sf_dir).rows(spark), "o_orderdate")


def keyed_merge_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last price of a part from a supplier; rows of a day differ, and the lowest remains."""
    lines, root = table(spark, sf_dir, "lineitem").select(*_PRICE), scratch_path(spark, "prices")
    late = F.col("l_shipdate") >= F.lit("1998-01-01").cast("timestamp")
    store_keyed(lines.where(late), root, ["l_partkey", "l_suppkey"], ["l_shipdate"], _BUCKETS)
    return _as_day(merge_keyed(lines.where(~late), root).rows(spark), "l_shipdate")


def keyed_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers by segment and the priority of their newest order: two stored tables meet bucket by bucket."""
    customers = store_keyed(
        table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"), scratch_path(spark, "customers"),
        ["c_custkey"], buckets=_BUCKETS,
    )
    left, right = customers.rows(spark), _latest_orders(spark, sf_dir).rows(spark)
    # The hint keeps a small side from being sent to all tasks of a large one.
    both = left.join(right.hint("merge"), left["c_custkey"] == right["o_custkey"], "left")
    return both.groupBy("c_mktsegment", "o_orderpriority").agg(F.count("*").alias("num_customers"))


QUERIES = {
    "keyed_merge_latest": keyed_merge_latest,
    "keyed_merge_dedup": keyed_merge_dedup,
    "keyed_join": keyed_join,
}

_LATEST = """
    SELECT o_custkey, o_orderdate, o_orderkey, o_orderpriority FROM (
        SELECT *, row_number() OVER (
            PARTITION BY o_custkey
            ORDER BY o_orderdate DESC NULLS LAST, o_orderkey DESC NULLS LAST, o_orderpriority NULLS FIRST
        ) AS rn FROM orders
    ) AS ranked WHERE rn = 1
"""

ORACLES = {
    "keyed_merge_latest": f"""
        SELECT * REPLACE (CAST(strftime(o_orderdate, '%Y%m%d') AS INT) AS o_orderdate) FROM ({_LATEST}) AS latest
    """,
    "keyed_merge_dedup": """
        SELECT l_partkey, l_suppkey, CAST(strftime(l_shipdate, '%Y%m%d') AS INT) AS l_shipdate, l_extendedprice, l_quantity FROM (
            SELECT *, row_number() OVER (
                PARTITION BY l_partkey, l_suppkey
                ORDER BY l_shipdate DESC NULLS LAST, l_extendedprice NULLS FIRST, l_quantity NULLS FIRST
            ) AS rn FROM lineitem
        ) AS ranked WHERE rn = 1
    """,
    "keyed_join": f"""
        SELECT c_mktsegment, o_orderpriority, count(*) AS num_customers
        FROM customer LEFT JOIN ({_LATEST}) AS latest ON c_custkey = o_custkey
        GROUP BY c_mktsegment, o_orderpriority
    """,
}
