import os
import subprocess
import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from levyflow.models import MlpLoss, SvrLoss, Task, descend, pack_blocks
from levyflow.models.caching import cache_spread, task_count
from levyflow.models.descent import FAN_IN, gradient_sums, ordered_sum, tree_sum
from levyflow.models.mlp import mlp_expression, mlp_vectorized
from levyflow.models.svr import svr_gradient, svr_predict
from levyflow.operators import regression_metrics

MIB = 1024**2
LOSSES = [SvrLoss(3, epsilon=0.1, l2=1e-2), MlpLoss(3, hidden=4)]


def numeric_gradient(loss, theta, x, y, step=1e-6):
    def value(t):
        return loss.sums(t, x, y)[1] / len(y) + loss.penalty(t)[1]

    unit = np.eye(len(theta)) * step
    return np.array([(value(theta + u) - value(theta - u)) / (2 * step) for u in unit])


@pytest.mark.parametrize("loss", LOSSES, ids=["svr", "mlp"])
def test_gradient_agrees_with_finite_differences(loss):
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=(3, 200)), rng.normal(size=200)
    theta = loss.start(3)
    gradient, _ = loss.sums(theta, x, y)
    assert theta.shape == (loss.size,)
    assert np.allclose(gradient / 200 + loss.penalty(theta)[0], numeric_gradient(loss, theta, x, y), atol=1e-5)


def test_svr_is_flat_on_the_edge_of_the_tube():
    loss = SvrLoss(1, epsilon=0.5, l2=0.0)
    gradient, value = loss.sums(np.array([0.0, 0.0]), np.array([[1.0, 1.0]]), np.array([0.5, -0.5]))
    assert gradient.tolist() == [0.0, 0.0] and value == 0.0


def test_network_saturates_quietly():
    loss = MlpLoss(1, hidden=1)
    with np.errstate(over="raise", invalid="raise", divide="raise"):
        active, _ = loss.forward([1.0, 0.0, 1.0, 0.0], np.array([[-1e6, -1.0, 0.0, 1e-9, 1.0, 1e6]]))
    assert np.allclose(active[0], np.tanh([-1e6, -1.0, 0.0, 1e-9, 1.0, 1e6]), atol=1e-15)


def test_svr_penalty_leaves_the_bias_alone():
    pull, penalty = SvrLoss(2, l2=0.5).penalty(np.array([1.0, 2.0, 9.0]))
    assert pull.tolist() == [0.5, 1.0, 0.0] and penalty == 1.25


def line(spark, rows=4000, partitions=3):
    x1, x2 = F.col("id") % 17 / 8 - 1, F.col("id") % 23 / 11 - 1
    frame = spark.range(rows, numPartitions=partitions)
    return frame.select(x1.alias("x1"), x2.alias("x2"), (0.7 * x1 - 0.3 * x2 + 0.2).alias("y"))


def test_packed_gradient_agrees_with_numpy_and_with_the_aggregate(spark):
    df = line(spark)
    data = np.array(df.collect())
    theta = np.array([0.1, 0.4, -0.2])
    loss = SvrLoss(2)
    blocks = pack_blocks(df, ["x1", "x2"], "y")
    try:
        [(gradient, value)] = gradient_sums(blocks, [loss], [theta])
    finally:
        blocks.release()
    expected, expected_value = loss.sums(theta, data[:, :2].T, data[:, 2])
    assert np.allclose(gradient, expected) and value == pytest.approx(expected_value)
    one_pass = svr_gradient(df, ["x1", "x2"], "y", theta, loss.epsilon).first()
    assert np.allclose(list(one_pass), np.append(expected, expected_value) / len(data))


@pytest.mark.parametrize(
    "size, blocks, partitions, cores, expected",
    [
        (300_000, 7, 7, 8, 1),  # tiny: one task
        (34 * MIB, 48, 8, 8, 5),  # less than the cores could take
        (900 * MIB, 1300, 1, 8, 8),  # one file, all cores
        (900 * MIB, 1300, 20, 8, 20),  # as scanned
        (900 * MIB, 1300, 1000, 8, 113),  # many small files
        (40 * 1024**2 * MIB, 10**8, 800_000, 4000, 800_000),  # large: as scanned
        (900 * MIB, 3, 1, 8, 3),  # no more tasks than blocks
    ],
)
def test_task_count_follows_size(size, blocks, partitions, cores, expected):
    assert task_count(size, blocks, partitions, cores) == expected


def test_cache_spreads_a_partition_that_holds_most_rows(spark):
    hot = spark.range(100_000, numPartitions=1).unionAll(spark.range(700, numPartitions=7))
    cached = cache_spread(hot, F.lit(1), 1024)  # as if a row were a kilobyte: enough for every core
    try:
        sizes = [r["count"] for r in cached.data.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        cached.release()
    assert cached.samples == sum(sizes) == 100_700
    assert len(sizes) == cached.partitions == 8 and max(sizes) < 2 * min(sizes)


def test_one_epoch_is_the_same_for_every_partitioning(spark):
    fits = []
    for n in (1, 3, 7):
        blocks = pack_blocks(line(spark).repartition(n), ["x1", "x2"], "y")
        fits.append(descend(blocks, [Task("m", MlpLoss(2, 3), 2, 0.1)])[0])
        blocks.release()
    assert all(np.allclose(f.theta, fits[0].theta, rtol=1e-12) for f in fits)
    assert all(np.allclose(f.history, fits[0].history, rtol=1e-12) for f in fits)


def test_training_is_repeatable_to_the_bit(spark):
    blocks = pack_blocks(line(spark), ["x1", "x2"], "y")
    try:
        one, two = (descend(blocks, [Task("m", SvrLoss(2), 3, 0.2)])[0] for _ in range(2))
    finally:
        blocks.release()
    assert one.theta.tolist() == two.theta.tolist() and one.history == two.history


def test_shared_passes_give_the_same_models_as_separate_ones(spark):
    tasks = [Task("svr", SvrLoss(2), 4, 0.2), Task("mlp", MlpLoss(2, 3), 2, 0.1)]
    blocks = pack_blocks(line(spark), ["x1", "x2"], "y")
    try:
        together = descend(blocks, tasks)
        apart = [descend(blocks, [t])[0] for t in tasks]
    finally:
        blocks.release()
    for a, b in zip(together, apart):
        assert a.theta.tolist() == b.theta.tolist() and a.history == b.history
    assert [len(f.history) for f in together] == [4, 2]


def test_tree_sum_merges_in_levels(spark):
    parts = spark.range(50).select(
        F.col("id").alias("part"), F.array(F.col("id").cast("double"), F.lit(1.0)).alias("sums")
    )
    assert tree_sum(parts, 50, fan_in=4).tolist() == [1225.0, 50.0]
    assert tree_sum(parts, 50, fan_in=FAN_IN).tolist() == [1225.0, 50.0]


def test_ordered_sum_ignores_arrival_order():
    parts = [(0, [1e16]), (1, [1.0]), (2, [-1e16]), (3, [0.5])]
    assert ordered_sum(parts).tolist() == ordered_sum(parts[::-1]).tolist() == [1.5]


def test_adaptive_setting_is_restored(spark):
    before = spark.conf.get("spark.sql.adaptive.enabled")
    blocks = pack_blocks(line(spark, 100), ["x1", "x2"], "y")
    descend(blocks, [Task("m", SvrLoss(2), 1, 0.1)])
    blocks.release()
    assert spark.conf.get("spark.sql.adaptive.enabled") == before


def test_empty_and_invalid_training_rows_are_refused(spark):
    with pytest.raises(ValueError):
        pack_blocks(line(spark, 0), ["x1", "x2"], "y")
    gaps = line(spark, 10).withColumn("y", F.when(F.col("x1") > 0, F.col("y")))
    with pytest.raises(PySparkException, match="null or NaN"):
        pack_blocks(gaps, ["x1", "x2"], "y")


def test_partitions_without_rows_do_no_harm(spark):
    df = line(spark).where(F.spark_partition_id() == 1)
    blocks = pack_blocks(df, ["x1", "x2"], "y")
    try:
        fit = descend(blocks, [Task("m", SvrLoss(2), 1, 0.1)])[0]
    finally:
        blocks.release()
    assert blocks.rows == df.count() and len(fit.history) == 1


def test_both_forms_of_the_network_agree(spark):
    loss = MlpLoss(2, hidden=3)
    theta = loss.start(5)
    df = line(spark, 500)
    got = df.select("x1", "x2", mlp_expression(loss, ["x1", "x2"], theta), mlp_vectorized(loss, ["x1", "x2"], theta))
    rows = np.array(got.collect())
    assert np.allclose(rows[:, 2], rows[:, 3])
    assert np.allclose(rows[:, 2], loss.forward(theta, rows[:, :2].T)[1])


def test_both_regressors_learn_a_line(spark):
    df = line(spark)
    blocks = pack_blocks(df, ["x1", "x2"], "y")
    mlp = MlpLoss(2, 6)
    try:
        svr_fit, mlp_fit = descend(
            blocks, [Task("svr", SvrLoss(2, 0.01, 1e-4), 120, 0.1), Task("mlp", mlp, 120, 0.1)]
        )
    finally:
        blocks.release()
    scored = df.select(
        "y", svr_predict(["x1", "x2"], svr_fit.theta).alias("svr"),
        mlp_expression(mlp, ["x1", "x2"], mlp_fit.theta).alias("mlp"),
    )
    r2 = {r["model"]: r["r2"] for r in regression_metrics(scored, {"svr": "svr", "mlp": "mlp"}, "y").collect()}
    assert r2["svr"] > 0.97 and r2["mlp"] > 0.9
    losses = [loss for _, loss in mlp_fit.curve]
    assert all(b < a for a, b in zip(losses, losses[1:]))
    assert [e for e, _ in svr_fit.curve] == list(range(1, 121)) and svr_fit.curve[-1][1] < svr_fit.curve[0][1]


def test_gaps_give_the_same_answers_in_both_forms(spark):
    loss, odd = MlpLoss(2, hidden=3), [None, float("nan"), float("inf"), float("-inf"), 0.5]
    df = spark.createDataFrame([(a, b) for a in odd for b in odd], "x1 double, x2 double")
    theta = loss.start(5)
    got = df.select(mlp_expression(loss, ["x1", "x2"], theta).alias("a"), mlp_vectorized(loss, ["x1", "x2"], theta).alias("b"))
    rows = got.collect()
    assert all((r.a is None) == (r.b is None) for r in rows) and any(r.a is None for r in rows)
    known = np.array([r for r in rows if r.a is not None], dtype=float)
    assert np.isnan(known).any() and np.allclose(known[:, 0], known[:, 1], equal_nan=True)


def test_training_goes_on_from_stored_weights(spark, tmp_path):
    def tasks(epochs):
        return [Task("svr", SvrLoss(2), epochs, 0.2), Task("mlp", MlpLoss(2, 3), min(epochs, 5), 0.1)]

    blocks = pack_blocks(line(spark, 500), ["x1", "x2"], "y")
    try:
        whole = descend(blocks, tasks(8))
        descend(blocks, tasks(3), str(tmp_path / "w"), every=2)
        (tmp_path / "w" / "epoch-000009").mkdir()  # cut off while it was written
        resumed = descend(blocks, tasks(8), str(tmp_path / "w"), every=2)
        again = descend(blocks, tasks(8), str(tmp_path / "w"), every=2)
    finally:
        blocks.release()
    for a, b, c in zip(whole, resumed, again):
        assert a.theta.tolist() == b.theta.tolist() == c.theta.tolist() and a.history == tuple(map(tuple, b.history))


def _fit(spark, rows, store=None, partitions=3, epochs=6, rate=0.2, loss=SvrLoss(2), **task):
    blocks = pack_blocks(rows.repartition(partitions), ["x1", "x2"], "y")
    try:
        return descend(blocks, [Task("m", loss, epochs, rate, **task)], store, every=2)[0]
    finally:
        blocks.release()


def test_weights_of_other_rows_or_settings_are_left_alone(spark, tmp_path):
    store, df = str(tmp_path / "w"), line(spark, 600)
    other = df.withColumn("y", -F.col("y"))
    _fit(spark, df, store)
    changed = [(other, {}), (df, {"rate": 0.1}), (df, {"loss": SvrLoss(2, epsilon=0.3)}), (df, {"seed": 7}), (df, {"theta": (0.1, 0.2, 0.3)}),
               (df.limit(599), {}), (df.select("x1", F.col("y").alias("x2"), F.col("x2").alias("y")), {})]
    for rows, settings in changed:
        assert np.allclose(_fit(spark, rows, store, **settings).theta, _fit(spark, rows, **settings).theta, rtol=1e-12)


def test_stored_weights_beyond_the_epochs_are_not_taken(spark, tmp_path):
    store, df = str(tmp_path / "w"), line(spark, 600)
    _fit(spark, df, store, epochs=6)
    fewer = _fit(spark, df, store, epochs=3)
    assert len(fewer.history) == 3 and np.allclose(fewer.theta, _fit(spark, df, epochs=3).theta, rtol=1e-12)


def test_stored_weights_are_found_from_another_partitioning(spark, tmp_path):
    store, df = str(tmp_path / "w"), line(spark, 600)
    _fit(spark, df, store, epochs=4, partitions=2)
    spoilt = spark.read.parquet(f"{store}/*").withColumn("losses", F.transform("losses", lambda v: v + 1))
    spoilt.write.parquet(f"{store}/epoch-000099")
    spoilt.unpersist()
    found = _fit(spark, df.orderBy("x2"), store, epochs=5, partitions=7)
    assert len(found.history) == 5 and found.history[4][1] < 1


def test_a_lost_worker_changes_nothing(tmp_path):
    """A task whose worker dies in the middle of an epoch runs again, with the same outcome."""
    script = tmp_path / "lost.py"
    script.write_text(f"""
import os
from dataclasses import dataclass
from pyspark import TaskContext
from pyspark.sql import SparkSession, functions as F
from levyflow.models import SvrLoss, Task, descend, pack_blocks

@dataclass(frozen=True)
class Mortal(SvrLoss):
    mark: str = ""

    def sums(self, theta, x, y):
        if self.mark and TaskContext.get().attemptNumber() == 0 and TaskContext.get().partitionId() == 0:
            try:
                os.mkdir(self.mark)
            except FileExistsError:
                pass
            else:
                os._exit(1)
        return super().sums(theta, x, y)

spark = SparkSession.builder.master("local[3,4]").config("spark.ui.enabled", "false").getOrCreate()
df = spark.range(900, numPartitions=3).select((F.col("id") % 17 / 8).alias("x"), (F.col("id") % 17 / 4 - 1).alias("y"))
blocks = pack_blocks(df, ["x"], "y")
fits = [descend(blocks, [Task("m", Mortal(1, mark=m), 5, 0.2)])[0] for m in ("", {str(tmp_path / "died")!r})]
assert os.path.isdir({str(tmp_path / "died")!r})
assert fits[0].theta.tolist() == fits[1].theta.tolist() and fits[0].history == fits[1].history
print("same")
""")
    done = subprocess.run([sys.executable, str(script)], cwd=Path(__file__).parents[1], capture_output=True, text=True, timeout=300,
                          env=os.environ | {"PYTHONPATH": str(Path(__file__).parents[1])})
    assert done.stdout.strip().endswith("same"), done.stderr[-3000:]


def test_small_partitions_are_read_together_without_a_shuffle(spark):
    df = line(spark, 4000).repartition(40)
    cached = cache_spread(df, F.lit(1), 8)
    try:
        assert cached.partitions == cached.data.rdd.getNumPartitions() == 1 and cached.data.count() == 4000
        assert "Exchange" not in cached.data._jdf.queryExecution().executedPlan().toString().split("InMemoryRelation")[0]
    finally:
        cached.release()
