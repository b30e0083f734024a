"""The Spark ML classifiers: short fits that SQL can follow, and long ones whose sizes it knows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from levyflow.catalog.features import bucket_sql
from levyflow.catalog.inputs import table
from levyflow.models.classifiers import fit_forest, fit_perceptron
from levyflow.operators.features import assemble
from levyflow.plans.classification import FOREST_NAME, PERCEPTRON_NAME, ClassificationRun, compare_classifiers

KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def _net():
    return F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))


_CLASS_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber", "ship_year"]


def _priced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines labelled by whether the net price passes 50000."""
    return table(spark, sf_dir, "lineitem").select(
        *KEYS, "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        F.year("l_shipdate").alias("ship_year"),
        F.when(_net() > 50000, "high").otherwise("low").alias("price_class"),
    )


def learning(run: ClassificationRun, name: str) -> DataFrame:
    """``(model, train_rows, test_rows, learns)``: a long fit has no twin in SQL, but its sizes have, and
    it should not fall behind the class that is most frequent."""
    level = run.metrics.where(F.col("model") == "MajorityClass").select(F.col("accuracy").alias("level"))
    fitted = run.metrics.where(F.col("model") == name)
    return fitted.crossJoin(F.broadcast(level)).select(
        "model", F.lit(run.rows["train"]).cast("long").alias("train_rows"),
        F.lit(run.rows["test"]).cast("long").alias("test_rows"),
        (F.col("accuracy") >= F.col("level")).alias("learns"),
    )


def _class_metrics(spark: SparkSession, sf_dir: str, model: str, standardized: bool) -> DataFrame:
    run = compare_classifiers(
        _priced(spark, sf_dir), "price_class", _CLASS_FEATURES, KEYS,
        standardized=standardized, with_baseline=True, models=[model],
    )
    return learning(run, model)


def rf_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _class_metrics(spark, sf_dir, FOREST_NAME, standardized=False)


def mlpc_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unscaled features can leave the perceptron at the majority class or below: sizes only."""
    return _class_metrics(spark, sf_dir, PERCEPTRON_NAME, standardized=False).drop("learns")


def mlpc_metrics_standardized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _class_metrics(spark, sf_dir, PERCEPTRON_NAME, standardized=True)


def rf_stump(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One tree of one split on all rows: ``(value, prediction, rows)``. It has to find the threshold of
    the least Gini impurity, and to name the majority on either side."""
    value = F.round(F.col("l_discount") * 100).cast("int")
    label = F.when(value + F.round(F.col("l_tax") * 100) > 9, 1.0).otherwise(0.0)
    rows = table(spark, sf_dir, "lineitem").select(value.alias("value"), label.alias("label"))
    rows = assemble(rows, ["value"])
    model = fit_forest(rows, trees=1, depth=1, bootstrap=False, featureSubsetStrategy="all")
    return model.transform(rows).groupBy("value", "prediction").agg(F.count(F.lit(1)).alias("rows"))


STEP_RATE = 0.5
# Two inputs, two sigmoid units, two classes: by layer the weights input by input, then the biases.
STEP_START = (0.4, -0.3, 0.2, 0.6, 0.1, -0.1, 0.7, -0.5, 0.3, 0.2, 0.05, -0.05)


def mlpc_one_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The perceptron's weights ``(slot, weight)`` after one step of gradient descent from given ones."""
    rows = table(spark, sf_dir, "lineitem").select(
        (F.col("l_extendedprice") / 50000 - 1).alias("x1"), (F.col("l_discount") * 20 - 1).alias("x2"),
        F.when(_net() > 50000, 1.0).otherwise(0.0).alias("label"),
    )
    model = fit_perceptron(
        assemble(rows, ["x1", "x2"]), 2, 2, hidden=[2], iterations=1, initialWeights=list(STEP_START),
        solver="gd", stepSize=STEP_RATE, blockSize=1, tol=0.0,
    )
    weights = [(i, round(float(w), 6)) for i, w in enumerate(model.weights)]
    return spark.createDataFrame(weights, "slot int, weight double")


QUERIES = {
    "rf_metrics": rf_metrics,
    "mlpc_metrics": mlpc_metrics,
    "mlpc_metrics_standardized": mlpc_metrics_standardized,
    "rf_stump": rf_stump,
    "mlpc_one_step": mlpc_one_step,
}


def _sizes(model: str, last: str) -> str:
    bucket = bucket_sql(KEYS)
    return f"""
        SELECT '{model}' AS model, count(*) FILTER (WHERE {bucket} < 80) AS train_rows,
               count(*) FILTER (WHERE {bucket} >= 80) AS test_rows{last} FROM lineitem
    """


def _step() -> str:
    """Softmax cross-entropy behind sigmoid units, one slot after the other."""
    w = STEP_START
    units = [f"1 / (1 + exp(-({w[k]} * x1 + {w[2 + k]} * x2 + {w[4 + k]})))" for k in (0, 1)]
    logits = [f"{w[6 + j]} * h0 + {w[8 + j]} * h1 + {w[10 + j]}" for j in (0, 1)]
    back = [f"(d0 * {w[6 + 2 * k]} + d1 * {w[7 + 2 * k]}) * h{k} * (1 - h{k})" for k in (0, 1)]
    gradients = [f"avg(({back[k]}) * {x})" for x in ("x1", "x2") for k in (0, 1)]
    gradients += [f"avg({back[k]})" for k in (0, 1)]
    gradients += [f"avg(d{j} * h{k})" for k in (0, 1) for j in (0, 1)] + ["avg(d0)", "avg(d1)"]
    rows = " UNION ALL ".join(
        f"SELECT CAST({i} AS INT) AS slot, round({w[i]} - {STEP_RATE} * {g}, 6) AS weight FROM errors"
        for i, g in enumerate(gradients)
    )
    return f"""
        WITH samples AS (
            SELECT l_extendedprice / 50000 - 1 AS x1, l_discount * 20 - 1 AS x2,
                   CASE WHEN l_extendedprice * (1 - l_discount) * (1 + l_tax) > 50000 THEN 1 ELSE 0 END AS y
            FROM lineitem),
        hidden AS (SELECT *, {units[0]} AS h0, {units[1]} AS h1 FROM samples),
        scored AS (SELECT *, 1 / (1 + exp(({logits[0]}) - ({logits[1]}))) AS p1 FROM hidden),
        errors AS (SELECT *, (1 - p1) - (1 - y) AS d0, p1 - y AS d1 FROM scored)
        {rows}
    """


ORACLES = {
    "rf_metrics": _sizes(FOREST_NAME, ", true AS learns"),
    "mlpc_metrics": _sizes(PERCEPTRON_NAME, ""),
    "mlpc_metrics_standardized": _sizes(PERCEPTRON_NAME, ", true AS learns"),
    "rf_stump": """
        WITH cells AS (
            SELECT CAST(round(l_discount * 100) AS INT) AS value, count(*) AS n,
                   count(*) FILTER (WHERE round(l_discount * 100) + round(l_tax * 100) > 9) AS ones
            FROM lineitem GROUP BY 1),
        sides AS (
            SELECT t.value AS threshold, c.value <= t.value AS low, sum(c.n) AS n, sum(c.ones) AS ones
            FROM cells AS t CROSS JOIN cells AS c GROUP BY 1, 2),
        impurity AS (
            SELECT threshold, sum(2.0 * ones * (n - ones) / n) AS gini FROM sides
            GROUP BY 1 HAVING count(*) = 2),
        best AS (SELECT threshold FROM impurity ORDER BY gini LIMIT 1)
        SELECT cells.value, CAST(CASE WHEN 2 * sides.ones > sides.n THEN 1 ELSE 0 END AS DOUBLE) AS prediction,
               cells.n AS "rows"
        FROM cells CROSS JOIN best
        JOIN sides ON sides.threshold = best.threshold AND sides.low = (cells.value <= best.threshold)
    """,
    "mlpc_one_step": _step(),
}
