import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from levyflow.models import classifiers, fit_packed_perceptron, fit_perceptron, perceptron
from levyflow.models.perceptron import ClassLoss, _add_up, _partial, minimize
from levyflow.operators.features import assemble
from levyflow.plans.classification import PERCEPTRON_NAME, compare_classifiers


def rows(spark, count=1280, parts=1):
    x = [(F.rand(i) * 2 - 1).alias(f"x{i}") for i in range(2)]
    return spark.range(0, count, 1, 1).select("id", *x).withColumn(
        "label", F.when(F.col("x0") > F.col("x1"), 2.0).when(F.col("x0") > -0.5, 1.0).otherwise(0.0)
    ).repartition(parts, "id")


def test_steps_are_those_of_spark_ml(spark):
    data = rows(spark)
    own, count = fit_packed_perceptron(data, ["x0", "x1"], 3, hidden=[4, 3], iterations=12)
    # 1,280 rows make ten whole blocks, over which Spark ML takes the mean of means.
    theirs = fit_perceptron(assemble(data, ["x0", "x1"]), 2, 3, hidden=[4, 3], iterations=12)
    assert count == 1280
    assert np.allclose(own.weights.toArray(), theirs.weights.toArray(), rtol=1e-6, atol=1e-6)
    scored = own.transform(assemble(data, ["x0", "x1"]))
    assert scored.where("prediction = label").count() > 0.6 * 1280


def test_partitions_do_not_change_the_fit(spark):
    one, other = (
        fit_packed_perceptron(rows(spark, parts=parts), ["x0", "x1"], 3, hidden=[4], iterations=5)[0].weights.toArray()
        for parts in (1, 3)
    )
    assert np.allclose(one, other, rtol=1e-9, atol=1e-9)


def test_plan_trains_over_blocks_and_counts_its_rows(spark, monkeypatch):
    made = []

    def spy(train, *args, **settings):
        made.append((train.count(), settings["iterations"]))
        return classifiers.fit_perceptron(train, *args, **settings)

    monkeypatch.setattr(perceptron, "fit_perceptron", spy)
    run = compare_classifiers(
        rows(spark).withColumn("kind", F.col("label").cast("string")), "kind", ["x0", "x1"], ["id"],
        models=[PERCEPTRON_NAME], iterations=3, with_baseline=True,
    )
    # Spark ML only gives the first weights, and holds the last.
    assert made == [(1, 0), (1, 0)]
    assert run.rows["train"] > 900 and run.rows["train"] + run.rows["test"] == 1280 and run.rows["dropped"] == 0


def test_gradient_is_that_of_the_loss():
    loss = ClassLoss((2, 4, 3))
    rng = np.random.default_rng(0)
    theta, x, y = rng.normal(size=loss.size), rng.normal(size=(2, 9)), np.arange(9.0) % 3
    gradient, _ = loss.sums(theta, x, y)
    for i, step in enumerate(np.eye(loss.size) * 1e-6):
        slope = (loss.sums(theta + step, x, y)[1] - loss.sums(theta - step, x, y)[1]) / 2e-6
        assert math.isclose(slope, gradient[i], rel_tol=1e-5, abs_tol=1e-6)


def test_large_inputs_stay_finite():
    loss = ClassLoss((2, 4, 2))
    gradient, value = loss.sums(np.full(loss.size, -50.0), np.array([[1e6, -1e6], [1e6, -1e6]]), np.array([0.0, 1.0]))
    assert np.isfinite(gradient).all() and math.isclose(value, 2 * math.log(2))


def test_wide_layers_see_fewer_rows_at_a_time(monkeypatch):
    loss = ClassLoss((2, 3, 2))
    rng = np.random.default_rng(1)
    theta = rng.normal(size=loss.size)
    block = np.vstack([rng.normal(size=(2, 50)), np.arange(50.0) % 2])
    [(_, whole)] = _partial(loss, theta)(0, iter([block.tobytes()]))
    monkeypatch.setattr(perceptron, "LAYER_BYTES", 7 * 8 * 3)
    [(part, sliced)] = _partial(loss, theta)(4, iter([block.tobytes()]))
    assert part == 4 and np.allclose(whole, sliced, rtol=1e-12)


def test_sums_of_many_partitions_meet_in_groups(spark):
    vectors = spark.sparkContext.parallelize([(i, np.array([i, 1.0])) for i in range(11)], 11)
    assert _add_up(vectors, 11, fan_in=3).tolist() == [55.0, 11.0]


def test_search_finds_the_minimum_of_a_bent_valley():
    def valley(p):
        x, y = p
        return (1 - x) ** 2 + 100 * (y - x * x) ** 2, np.array([2 * (x - 1) - 400 * x * (y - x * x), 200 * (y - x * x)])

    found, losses = minimize(valley, [-1.2, 1.0], 200, tolerance=1e-12)
    assert np.allclose(found, 1.0, atol=1e-4) and losses == sorted(losses, reverse=True)
    assert minimize(valley, [-1.2, 1.0], 0)[0].tolist() == [-1.2, 1.0]
    assert len(minimize(valley, [-1.2, 1.0], 7)[1]) == 8


@pytest.mark.parametrize("value, slope", [(1.0, 0.0), (math.nan, math.nan), (1.0, 1.0)])
def test_search_ends_where_there_is_no_way_down(value, slope):
    # Flat, lost, and a gradient that does not belong to the loss.
    found, losses = minimize(lambda p: (value, np.array([slope])), [3.0], 50)
    assert found.tolist() == [3.0] and len(losses) == 1


def test_gaps_are_refused(spark):
    gap = spark.createDataFrame([(1.0, 0.0), (None, 1.0)], "x double, label double")
    with pytest.raises(Exception, match="null or NaN"):
        fit_packed_perceptron(gap, ["x"], 2, iterations=1)
