"""Grouped summaries, net amounts, top-k and run comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from levyflow.catalog.inputs import table
from levyflow.functions.numbers import net_amount
from levyflow.operators.metrics import compare_to_base, regression_metrics, stack_runs
from levyflow.operators.ranking import top_k
from levyflow.operators.summaries import summarize


def summary_by_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        F.year("l_shipdate").cast("int").alias("period"),
        "l_extendedprice", "l_quantity",
        (F.col("l_extendedprice") * F.col("l_tax")).alias("tax"),
        (F.col("l_extendedprice") * F.col("l_discount")).alias("discount"),
    )
    amounts = {"l_extendedprice": "price", "l_quantity": "quantity", "tax": "tax", "discount": "discount"}
    return summarize(lines, ["period"], amounts, "num_bills")


def summary_fine_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts far below a hundredth: nothing may be rounded before it is added."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_returnflag", (F.col("l_tax") / 1000).alias("rate"), (F.col("l_tax") / 1e6).alias("fine"))
    return summarize(lines, ["l_returnflag"], {"rate": "rate", "fine": "fine"}, places=8)


def summary_mixed_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts near 1e15 that cancel next to amounts near 1e-6, which doubles added in turn would lose."""
    large, small = F.col("l_orderkey") * float(2**40), F.col("l_quantity") / 2**20
    lines = table(spark, sf_dir, "lineitem").select(
        "l_returnflag", F.explode(F.array(large, small, -large)).alias("amount"))
    return summarize(lines, ["l_returnflag"], {"amount": "amount"}, places=9)


def summary_average_once_rounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An average just below a half of the last place: it must not be rounded on the way."""
    lines = table(spark, sf_dir, "lineitem")
    first = lines.agg(F.min("l_orderkey")).first()[0]
    amount = F.when(F.col("l_orderkey") == first, 1.0049).otherwise(1.005)
    return summarize(lines.select(F.lit(1).alias("k"), amount.alias("amount")), ["k"], {"amount": "amount"})


def _net_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    tax = price * F.col("l_tax").cast("decimal(4,2)")
    discount = price * F.col("l_discount").cast("decimal(4,2)")
    quantity = F.col("l_quantity").cast("decimal(12,2)")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_discount",
        F.year("l_shipdate").cast("int").alias("period"),
        net_amount([price, tax], [discount, quantity]).cast("double").alias("net"),
    )


def net_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _net_lines(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "period", "net"
    )


def topk_net(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filter, computed column, order and limit in SQL over a temporary view."""
    _net_lines(spark, sf_dir).createOrReplaceTempView("net_lines")
    return spark.sql("""
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, period, net
        FROM net_lines
        WHERE period = 2000 AND l_discount = 0.0
        ORDER BY net DESC NULLS LAST, l_orderkey, l_linenumber, l_partkey, l_suppkey
        LIMIT 20
    """)


def topk_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same operator through the DataFrame API."""
    orders = table(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "F")
    return top_k(orders.select("o_orderkey", "o_custkey", "o_totalprice"), 20, "o_totalprice",
                 ties=["o_orderkey"])


def run_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event type as a run: rows, elapsed seconds, and speed-up against the click run."""
    events = table(spark, sf_dir, "events")
    seconds = F.col("ts").cast("timestamp").cast("double")
    runs = events.groupBy(F.col("event_type").alias("env")).agg(
        F.count(F.lit(1)).alias("num_events"),
        F.round(F.max(seconds) - F.min(seconds), 3).alias("elapsed"),
    )
    return compare_to_base(runs, "click").withColumn("speedup", F.round("speedup", 9))


def stacked_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metric tables of two environments (line status F and O) stacked by column name."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_linestatus", "l_extendedprice", (F.col("l_quantity") * 2000).alias("prediction")
    )

    def metrics(status: str) -> DataFrame:
        scored = lines.where(F.col("l_linestatus") == status)
        table_ = regression_metrics(scored, {"by_quantity": "prediction"}, "l_extendedprice")
        return table_.select("model", *[F.round(c, 6).alias(c) for c in ("rmse", "mae", "r2")])

    reordered = metrics("O").select("r2", "mae", "rmse", "model")
    return stack_runs({"local": metrics("F"), "cluster": reordered})


QUERIES = {
    "summary_by_period": summary_by_period,
    "summary_fine_amounts": summary_fine_amounts,
    "summary_mixed_scale": summary_mixed_scale,
    "summary_average_once_rounded": summary_average_once_rounded,
    "net_amount": net_amounts,
    "topk_net": topk_net,
    "topk_orders": topk_orders,
    "run_comparison": run_comparison,
    "stacked_metrics": stacked_metrics,
}

_NET = """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_discount,
           CAST(year(l_shipdate) AS INT) AS period,
           CAST(round(CAST(l_extendedprice AS DECIMAL(12, 2))
               + CAST(l_extendedprice AS DECIMAL(12, 2)) * CAST(l_tax AS DECIMAL(4, 2))
               - CAST(l_extendedprice AS DECIMAL(12, 2)) * CAST(l_discount AS DECIMAL(4, 2))
               - CAST(l_quantity AS DECIMAL(12, 2)), 2) AS DOUBLE) AS net
    FROM lineitem
"""


def _total(expression: str, suffix: str) -> str:
    return f"round(sum({expression}), 2) AS total_{suffix}, round(avg({expression}), 2) AS avg_{suffix}"


ORACLES = {
    "summary_by_period": f"""
        SELECT CAST(year(l_shipdate) AS INT) AS period,
               {_total("l_extendedprice", "price")}, {_total("l_quantity", "quantity")},
               {_total("l_extendedprice * l_tax", "tax")},
               {_total("l_extendedprice * l_discount", "discount")},
               count(*) AS num_bills
        FROM lineitem GROUP BY 1 ORDER BY 1 NULLS FIRST
    """,
    "summary_fine_amounts": """
        SELECT l_returnflag, round(sum(l_tax / 1000), 8) AS total_rate, round(avg(l_tax / 1000), 8) AS avg_rate,
               round(sum(l_tax / 1e6), 8) AS total_fine, round(avg(l_tax / 1e6), 8) AS avg_fine, count(*) AS num_rows
        FROM lineitem GROUP BY 1
    """,
    "summary_mixed_scale": """
        SELECT l_returnflag, round(sum(l_quantity) / 1048576, 9) AS total_amount,
               round(sum(l_quantity) / 1048576 / (3 * count(*)), 9) AS avg_amount, 3 * count(*) AS num_rows
        FROM lineitem GROUP BY 1
    """,
    "summary_average_once_rounded": """
        WITH n AS (SELECT count(*) AS n, count(*) FILTER (WHERE l_orderkey = (SELECT min(l_orderkey) FROM lineitem)) AS odd FROM lineitem)
        SELECT CAST(1 AS INT) AS k, round(CAST((10049 * odd + 10050 * (n - odd)) AS DOUBLE) / 10000, 2) AS total_amount,
               CASE WHEN odd > 0 THEN 1.0 ELSE 1.01 END::DOUBLE AS avg_amount, n AS num_rows FROM n
    """,
    "net_amount": f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, period, net FROM ({_NET}) AS n",
    "topk_net": f"""
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, period, net FROM ({_NET}) AS n
        WHERE period = 2000 AND l_discount = 0.0
        ORDER BY net DESC NULLS LAST, l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 20
    """,
    "topk_orders": """
        SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'
        ORDER BY o_totalprice DESC NULLS LAST, o_orderkey NULLS FIRST LIMIT 20
    """,
    "run_comparison": """
        WITH runs AS (
            SELECT event_type AS env, count(*) AS num_events,
                   round((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6, 3) AS elapsed
            FROM events GROUP BY event_type
        )
        SELECT env, num_events, elapsed,
               round((SELECT elapsed FROM runs WHERE env = 'click') / elapsed, 9) AS speedup
        FROM runs
    """,
    "stacked_metrics": """
        SELECT CASE l_linestatus WHEN 'F' THEN 'local' ELSE 'cluster' END AS env,
               'by_quantity' AS model,
               round(sqrt(avg((l_quantity * 2000 - l_extendedprice) ** 2)), 6) AS rmse,
               round(avg(abs(l_quantity * 2000 - l_extendedprice)), 6) AS mae,
               round(1 - avg((l_quantity * 2000 - l_extendedprice) ** 2) / var_pop(l_extendedprice), 6) AS r2
        FROM lineitem WHERE l_linestatus IN ('F', 'O') GROUP BY 1
    """,
}
