import math

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.sql import functions as F

from levyflow.operators import (
    classification_metrics,
    compare_to_base,
    confusion_table,
    majority_metrics,
    regression_metrics,
    stack_runs,
)


def test_regression_metrics_agree_with_the_evaluator(spark, sf_dir):
    scored = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        F.col("l_extendedprice").alias("label"), (F.col("l_quantity") * 2000).alias("prediction")
    )
    ours = regression_metrics(scored, {"m": "prediction"}, "label").first()
    evaluator = RegressionEvaluator(labelCol="label", predictionCol="prediction")
    for name in ("rmse", "mse", "mae", "r2"):
        theirs = evaluator.evaluate(scored, {evaluator.metricName: name})
        assert ours[name] == pytest.approx(theirs, rel=1e-9)
    assert ours["mse"] == pytest.approx(ours["rmse"] ** 2)


def test_r2_of_a_constant_label(spark):
    df = spark.createDataFrame([(2.0, 2.0, 3.0)] * 3, "y double, exact double, off double")
    got = {r["model"]: r for r in regression_metrics(df, {"exact": "exact", "off": "off"}, "y").collect()}
    assert math.isnan(got["exact"]["r2"]) and got["exact"]["rmse"] == 0
    assert got["off"]["r2"] == -math.inf and got["off"]["mae"] == 1


@pytest.mark.parametrize(
    "pairs",
    [
        [(0, 0), (0, 1), (1, 1), (2, 1), (2, 2), (2, 0), (1, 1)],
        [(0, 0), (0, 0), (1, 0)],  # class 1 is never predicted
        [(0, 3), (1, 1)],  # class 3 is predicted but never occurs
        [(1, 1), (0, 0)],
    ],
)
def test_classification_metrics_agree_with_the_evaluator(spark, pairs):
    scored = spark.createDataFrame([(float(a), float(b)) for a, b in pairs], "label double, prediction double")
    ours = classification_metrics(confusion_table(scored), "m").first()
    evaluator = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction")
    names = {"accuracy": "accuracy", "precision": "weightedPrecision", "recall": "weightedRecall", "f1": "f1"}
    for mine, theirs in names.items():
        assert ours[mine] == pytest.approx(evaluator.evaluate(scored, {evaluator.metricName: theirs})), mine
    assert ours["recall"] == pytest.approx(ours["accuracy"])


def test_majority_metrics_are_those_of_a_constant_predictor(spark):
    labels = [0.0] * 7 + [1.0] * 3
    scored = spark.createDataFrame([(v, 0.0) for v in labels], "label double, prediction double")
    constant = classification_metrics(confusion_table(scored), "m").first()
    majority = majority_metrics(confusion_table(scored)).first()
    assert tuple(majority)[1:] == pytest.approx(tuple(constant)[1:])
    assert majority["model"] == "MajorityClass"


def test_runs_stack_by_name_and_compare_with_the_base(spark):
    one = spark.createDataFrame([("m", 120.0)], "model string, elapsed double")
    two = spark.createDataFrame([(480.0, "m")], "elapsed double, model string")
    runs = compare_to_base(stack_runs({"one": one, "three": two}), "one")
    assert {r["env"]: r["speedup"] for r in runs.collect()} == {"one": 1.0, "three": 0.25}
    with pytest.raises(ValueError):
        compare_to_base(stack_runs({"one": one}), "missing")


def test_rows_without_a_prediction_do_not_count(spark):
    rows = [(1.0, 1.1), (2.0, 2.1), (3.0, 2.9), (100.0, None), (None, 5.0)]
    df = spark.createDataFrame(rows, "y double, p double")
    row = regression_metrics(df, {"m": "p"}, "y").first()
    alone = regression_metrics(df.dropna(), {"m": "p"}, "y").first()
    assert all(row[c] == pytest.approx(alone[c]) for c in ("rmse", "mse", "mae", "r2"))
