"""Scans, sinks, cleaning, dimension and fact tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from levyflow.catalog.inputs import table
from levyflow.functions.numbers import clean_number, malformed, to_integer
from levyflow.operators.metrics import regression_metrics
from levyflow.operators.ranking import dedupe_by, latest_by
from levyflow.operators.summaries import row_counts
from levyflow.sources.readers import read_delimited, read_rejects, read_table
from levyflow.sources.scratch import scratch_path
from levyflow.sources.writers import write_metrics, write_table

_MONEY = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
_WHOLE = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
_TEXT = ("l_returnflag", "l_linestatus")


def csv_scan_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    lines = table(spark, sf_dir, "lineitem").select(
        *[F.col(c).cast("string").alias(c) for c in (*_WHOLE, *_TEXT)],
        *[F.format_number(c, 2).alias(c) for c in _MONEY],
    )
    lines.write.mode("overwrite").option("header", True).option("sep", ";").csv(path)
    raw = read_delimited(spark, path, ";")
    return raw.select(
        *[to_integer(F.col(c)).alias(c) for c in _WHOLE],
        *_TEXT,
        *[clean_number(F.col(c)).alias(c) for c in _MONEY],
    )


def clean_reject_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text that is no number: null in lenient mode, and counted."""
    amount = (
        F.when(F.col("l_linenumber") == 1, F.lit("n/a"))
        .when(F.col("l_linenumber") == 2, F.lit(""))
        .when(F.col("l_linenumber") == 3, F.lit(None))
        .otherwise(F.format_number("l_extendedprice", 2))
    )
    text = table(spark, sf_dir, "lineitem").select("l_returnflag", amount.alias("amount"))
    return text.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("num_rows"),
        F.count(clean_number(F.col("amount"), on_error="null")).alias("num_numbers"),
        F.count_if(malformed(F.col("amount"))).alias("num_rejected"),
    )


# Lines of text with what can be wrong about them, in the SQL that both engines share.
_ROUGH_LINES = """
SELECT CASE l_linenumber
         WHEN 5 THEN concat_ws(';', CAST(l_orderkey AS STRING), 'cut')
         WHEN 6 THEN concat_ws(';', CAST(l_orderkey AS STRING), l_returnflag, CAST(CAST(l_quantity AS INT) AS STRING), '5', 'more')
         ELSE concat_ws(';', CAST(l_orderkey AS STRING), l_returnflag,
                        CASE l_linenumber WHEN 4 THEN '' WHEN 7 THEN '12x4' ELSE CAST(CAST(l_quantity AS INT) AS STRING) END,
                        CASE WHEN l_linenumber IN (3, 7) THEN 'today' ELSE CAST(l_partkey AS STRING) END) END AS line
FROM lineitem
"""


def csv_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines cut short, lines too long, and fields that are no numbers."""
    path, names = scratch_path(spark, "rough"), ["orderkey", "flag", "amount", "day"]
    lines = spark.sql(_ROUGH_LINES.replace("FROM lineitem", "FROM {lineitem}"), lineitem=table(spark, sf_dir, "lineitem"))
    # One column, whose name is the header line; nothing is quoted, as the separator does not occur.
    lines.toDF(";".join(names)).write.mode("overwrite").option("header", True).option("sep", "\x01").csv(path)
    rejects = read_rejects(spark, path, names, numbers=["amount"], integers=["day"])
    return rejects.groupBy("line", "column", "reason").agg(F.count("*").alias("num"), F.bool_and(F.contains("file", F.lit(path.rsplit("/", 1)[-1]))).alias("named"))


def json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "json")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
        F.date_format("o_orderdate", "yyyyMMdd").cast("int").alias("o_orderday"), "o_orderpriority",
    )
    write_table(orders, path, "json")
    return read_table(spark, path, orders.schema, "json")


def metrics_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Single-file metric sink: write, read back with the schema."""
    out = scratch_path(spark, "metrics")
    lines = table(spark, sf_dir, "lineitem").select(
        "l_extendedprice", (F.col("l_quantity") * 1000).alias("by_quantity"),
        F.lit(52000.0).alias("constant"),
    )
    metrics = regression_metrics(
        lines, {"by_quantity": "by_quantity", "constant": "constant"}, "l_extendedprice"
    )
    rounded = metrics.select("model", *[F.round(c, 6).alias(c) for c in ("rmse", "mae", "r2")])
    write_metrics(rounded, out, "regression_metrics")
    return read_table(spark, f"{out}/metrics/regression_metrics.json", rounded.schema, "json")


_DIM_KEYS, _FACT_KEYS = ["o_custkey"], ["l_orderkey", "l_linenumber"]


def dim_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return latest_by(orders, _DIM_KEYS, ["o_orderdate"], ["o_orderpriority"], ties=["o_orderkey"])


def fact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").withColumn(
        "l_shipday", F.date_format("l_shipdate", "yyyyMMdd").cast("int")
    )
    return dedupe_by(lines.drop("l_shipdate"), _FACT_KEYS, ["l_partkey", "l_suppkey"])


def etl_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_counts(
        {
            "raw": table(spark, sf_dir, "lineitem"),
            # A row for each key is kept: counting keys needs no other column.
            "dimension": table(spark, sf_dir, "orders").select(*_DIM_KEYS).distinct(),
            "fact": table(spark, sf_dir, "lineitem").select(*_FACT_KEYS).distinct(),
        }
    )


QUERIES = {
    "csv_scan_clean": csv_scan_clean,
    "clean_reject_counts": clean_reject_counts,
    "csv_rejects": csv_rejects,
    "json_roundtrip": json_roundtrip,
    "metrics_roundtrip": metrics_roundtrip,
    "dim_latest": dim_latest,
    "fact_dedup": fact_dedup,
    "etl_row_counts": etl_row_counts,
}

ORACLES = {
    "csv_scan_clean": """
        SELECT CAST(l_orderkey AS INT) AS l_orderkey, CAST(l_partkey AS INT) AS l_partkey,
               CAST(l_suppkey AS INT) AS l_suppkey, l_linenumber, l_returnflag, l_linestatus,
               l_quantity, l_extendedprice, l_discount, l_tax
        FROM lineitem
    """,
    "clean_reject_counts": """
        SELECT l_returnflag, count(*) AS num_rows,
               count(*) FILTER (WHERE l_linenumber > 3) AS num_numbers,
               count(*) FILTER (WHERE l_linenumber = 1) AS num_rejected
        FROM lineitem GROUP BY l_returnflag
    """,
    "csv_rejects": f"""
        WITH lines AS ({_ROUGH_LINES}), fields AS (SELECT line, string_split(line, ';') AS f FROM lines),
        found AS (
            SELECT line, NULL::VARCHAR AS "column", 'fields' AS reason FROM fields WHERE len(f) <> 4
            UNION ALL SELECT line, 'amount', 'number' FROM fields WHERE len(f) = 4 AND f[3] <> '' AND try_cast(f[3] AS DOUBLE) IS NULL
            UNION ALL SELECT line, 'day', 'integer' FROM fields WHERE len(f) = 4 AND try_cast(f[4] AS INT) IS NULL)
        SELECT line, "column", reason, count(*) AS num, true AS named FROM found GROUP BY ALL
    """,
    "json_roundtrip": """
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
               CAST(strftime(o_orderdate, '%Y%m%d') AS INT) AS o_orderday, o_orderpriority
        FROM orders
    """,
    "metrics_roundtrip": """
        WITH p AS (
            SELECT l_extendedprice AS y, 'by_quantity' AS model, l_quantity * 1000 AS f FROM lineitem
            UNION ALL
            SELECT l_extendedprice, 'constant', 52000.0::DOUBLE FROM lineitem
        )
        SELECT model, round(sqrt(avg((f - y) * (f - y))), 6) AS rmse, round(avg(abs(f - y)), 6) AS mae,
               round(1 - avg((f - y) * (f - y)) / var_pop(y), 6) AS r2
        FROM p GROUP BY model
    """,
    "dim_latest": """
        SELECT o_custkey, o_orderpriority FROM (
            SELECT *, row_number() OVER (
                PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, o_orderkey DESC NULLS LAST
            ) AS rn FROM orders
        ) AS ranked WHERE rn = 1
    """,
    "fact_dedup": """
        SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount,
               l_tax, l_returnflag, l_linestatus,
               CAST(strftime(l_shipdate, '%Y%m%d') AS INT) AS l_shipday
        FROM (
            SELECT *, row_number() OVER (
                PARTITION BY l_orderkey, l_linenumber
                ORDER BY l_partkey NULLS FIRST, l_suppkey NULLS FIRST, l_quantity NULLS FIRST,
                         l_extendedprice NULLS FIRST, l_discount NULLS FIRST, l_tax NULLS FIRST,
                         l_returnflag NULLS FIRST, l_linestatus NULLS FIRST, l_shipdate NULLS FIRST
            ) AS rn FROM lineitem
        ) AS ranked WHERE rn = 1
    """,
    "etl_row_counts": """
        SELECT 'raw' AS "table", count(*) AS "rows" FROM lineitem
        UNION ALL SELECT 'dimension', count(DISTINCT o_custkey) FROM orders
        UNION ALL SELECT 'fact', count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem) AS k
    """,
}
