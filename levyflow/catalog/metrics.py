"""Error metrics of fixed predictors, where the right values are known from SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from levyflow.catalog.inputs import table
from levyflow.operators.metrics import (
    classification_metrics,
    confusion_table,
    majority_metrics,
    stack_runs,
)
from levyflow.operators.metrics import regression_metrics as metrics_of

_REGRESSION_ROUNDED = ("rmse", "mse", "mae", "r2")
_CLASS_ROUNDED = ("accuracy", "precision", "recall", "f1")


def _regression(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    price, discount, tax = F.col("l_extendedprice"), F.col("l_discount"), F.col("l_tax")
    return table(spark, sf_dir, "lineitem").select(
        *more, "l_returnflag",
        (price * (1 - discount) * (1 + tax) / 1000).alias("net"),
        (price * 0.99 / 1000).alias("linear"),
        (price * (1 - discount) / 1000).alias("untaxed"),
    )


def regression_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = metrics_of(_regression(spark, sf_dir), {"linear": "linear", "untaxed": "untaxed"}, "net")
    return metrics.select("model", *[F.round(c, 6).alias(c) for c in _REGRESSION_ROUNDED])


def regression_metrics_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = metrics_of(_regression(spark, sf_dir), {"linear": "linear"}, "net", by=["l_returnflag"])
    return metrics.select(
        "l_returnflag", "model", *[F.round(c, 6).alias(c) for c in _REGRESSION_ROUNDED]
    )


def regression_metrics_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One model has no prediction for some rows: they count for nothing in its row."""
    partly = F.when(F.col("l_returnflag") != "A", F.col("untaxed"))
    rows = _regression(spark, sf_dir).withColumn("untaxed", partly)
    metrics = metrics_of(rows, {"linear": "linear", "untaxed": "untaxed"}, "net")
    return metrics.select("model", *[F.round(c, 6).alias(c) for c in _REGRESSION_ROUNDED])


def _classified(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    """Three price classes, guessed from the quantity; class 2 is never guessed."""
    label = F.when(F.col("l_extendedprice") > 75000, 2).when(F.col("l_extendedprice") > 30000, 1).otherwise(0)
    guess = F.when(F.col("l_quantity") > 20, 1).otherwise(0)
    return table(spark, sf_dir, "lineitem").select(*more, label.alias("label"), guess.alias("prediction"))


def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return confusion_table(_classified(spark, sf_dir))


def class_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rule's metrics and those of the majority class it has to beat."""
    confusion = confusion_matrix(spark, sf_dir)
    both = stack_runs(
        {"rule": classification_metrics(confusion, "rule"), "base": majority_metrics(confusion)}, "run"
    )
    return both.select("model", *[F.round(c, 6).alias(c) for c in _CLASS_ROUNDED])


QUERIES = {
    "regression_metrics": regression_metrics,
    "regression_metrics_by_group": regression_metrics_by_group,
    "regression_metrics_gaps": regression_metrics_gaps,
    "confusion_matrix": confusion_matrix,
    "classification_metrics": class_metrics,
}

_MODELS = """
    SELECT l_returnflag, l_extendedprice * (1 - l_discount) * (1 + l_tax) / 1000 AS y,
           'linear' AS model, l_extendedprice * 0.99::DOUBLE / 1000 AS f
    FROM lineitem
    UNION ALL
    SELECT l_returnflag, l_extendedprice * (1 - l_discount) * (1 + l_tax) / 1000,
           'untaxed', l_extendedprice * (1 - l_discount) / 1000
    FROM lineitem
"""
_ERRORS = """
    round(sqrt(avg((f - y) * (f - y))), 6) AS rmse, round(avg((f - y) * (f - y)), 6) AS mse,
    round(avg(abs(f - y)), 6) AS mae, round(1 - avg((f - y) * (f - y)) / var_pop(y), 6) AS r2
"""
_CELLS = """
    SELECT CAST(CASE WHEN l_extendedprice > 75000 THEN 2 WHEN l_extendedprice > 30000 THEN 1 ELSE 0 END
                AS DOUBLE) AS label,
           CAST(CASE WHEN l_quantity > 20 THEN 1 ELSE 0 END AS DOUBLE) AS prediction, count(*) AS "rows"
    FROM lineitem GROUP BY 1, 2
"""

ORACLES = {
    "regression_metrics": f"SELECT model, {_ERRORS} FROM ({_MODELS}) AS p GROUP BY model",
    "regression_metrics_by_group": f"""
        SELECT l_returnflag, model, {_ERRORS} FROM ({_MODELS}) AS p WHERE model = 'linear'
        GROUP BY l_returnflag, model
    """,
    "regression_metrics_gaps": f"""
        SELECT model, {_ERRORS} FROM ({_MODELS}) AS p WHERE model = 'linear' OR l_returnflag <> 'A' GROUP BY model
    """,
    "confusion_matrix": _CELLS,
    "classification_metrics": f"""
        WITH cells AS ({_CELLS}),
        actual AS (SELECT label AS class, sum("rows") AS actual FROM cells GROUP BY 1),
        guessed AS (SELECT prediction AS class, sum("rows") AS guessed FROM cells GROUP BY 1),
        hits AS (SELECT label AS class, sum("rows") AS hits FROM cells WHERE label = prediction GROUP BY 1),
        scores AS (
            SELECT actual, coalesce(hits, 0) AS hits,
                   coalesce(hits / CAST(guessed AS DOUBLE), 0) AS p,
                   coalesce(hits / CAST(actual AS DOUBLE), 0) AS r
            FROM actual LEFT JOIN guessed USING (class) LEFT JOIN hits USING (class)
        ),
        share AS (SELECT max(actual) / CAST(sum(actual) AS DOUBLE) AS m FROM actual)
        SELECT 'rule' AS model, round(CAST(sum(hits) AS DOUBLE) / sum(actual), 6) AS accuracy,
               round(sum(p * actual) / sum(actual), 6) AS precision,
               round(sum(r * actual) / sum(actual), 6) AS recall,
               round(sum(CASE WHEN p + r = 0 THEN 0 ELSE 2 * p * r / (p + r) END * actual) / sum(actual), 6)
                   AS f1
        FROM scores
        UNION ALL
        SELECT 'MajorityClass', round(m, 6), round(m * m, 6), round(m, 6), round(2 * m * m / (1 + m), 6)
        FROM share
    """,
}
