"""Scores, gradients and loss curves from fixed starting weights."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from levyflow.catalog.inputs import table
from levyflow.catalog.training_sql import TrainingSql
from levyflow.models.blocks import pack_blocks
from levyflow.models.descent import Fit, Task, descend, gradient_sums
from levyflow.models.mlp import MlpLoss, mlp_predict
from levyflow.models.svr import SvrLoss, svr_predict
from levyflow.models.svr import svr_gradient as svr_step
from levyflow.sources.readers import read_table
from levyflow.sources.scratch import scratch_path
from levyflow.sources.writers import LOSS_SCHEMA, write_loss_curve

KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
FEATURES = ["x1", "x2"]

SVR_START = (0.5, -0.2, 0.1)
SVR = SvrLoss(2, epsilon=0.1, l2=1e-3)
SVR_RATE = 0.2

MLP_START = (0.4, -0.3, 0.2, 0.6, 0.1, -0.1, 0.7, -0.5, 0.05)
MLP = MlpLoss(2, hidden=2)
MLP_RATE = 0.05

EPOCHS = 3


def _net() -> Column:
    return F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))


def _samples(spark: SparkSession, sf_dir: str, keys: Sequence[str] = ()) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        *keys,
        (F.col("l_extendedprice") / 50000 - 1).alias("x1"),
        (F.col("l_discount") * 20 - 1).alias("x2"),
        (_net() / 50000 - 1).alias("y"),
    )


def svr_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Nine places: with these weights the exact score has eight, so six would round ties.
    prediction = svr_predict(FEATURES, SVR_START)
    return _samples(spark, sf_dir, KEYS).select(*KEYS, F.round(prediction, 9).alias("prediction"))


def mlp_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    prediction = mlp_predict(MLP, FEATURES, MLP_START)
    return _samples(spark, sf_dir, KEYS).select(*KEYS, F.round(prediction, 6).alias("prediction"))


def svr_gradient(spark: SparkSession, sf_dir: str) -> DataFrame:
    step = svr_step(_samples(spark, sf_dir), FEATURES, "y", SVR_START, SVR.epsilon)
    return step.select(*[F.round(c, 6).alias(c) for c in step.columns])


def mlp_gradient(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One distributed gradient: ``(slot, gradient)`` with slot 9 holding the loss."""
    blocks = pack_blocks(_samples(spark, sf_dir), FEATURES, "y")
    try:
        [(gradient, loss)] = gradient_sums(blocks, [MLP], [MLP_START])
    finally:
        blocks.release()
    slots = [(i, round(float(v) / blocks.rows, 6)) for i, v in enumerate([*gradient, loss])]
    return spark.createDataFrame(slots, "slot int, gradient double")


def _train(spark: SparkSession, sf_dir: str, tasks: Sequence[Task]) -> list[Fit]:
    blocks = pack_blocks(_samples(spark, sf_dir), FEATURES, "y")
    try:
        return descend(blocks, tasks)
    finally:
        blocks.release()


_SVR_TASK = Task("svr", SVR, EPOCHS, SVR_RATE, theta=SVR_START)
_MLP_TASK = Task("mlp", MLP, EPOCHS, MLP_RATE, theta=MLP_START)


def _stored_curve(spark: SparkSession, sf_dir: str, task: Task) -> DataFrame:
    """Train, write the loss curve the way the jobs do, and read it back."""
    [fit] = _train(spark, sf_dir, [task])
    out = scratch_path(spark, "curve")
    write_loss_curve(spark, task.name, fit.curve, out)
    curve = read_table(spark, f"{out}/loss_curves/{task.name}_loss.json", LOSS_SCHEMA, "json")
    return curve.select("epoch", F.round("loss", 6).alias("loss"))


def loss_curve_svr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored_curve(spark, sf_dir, _SVR_TASK)


def loss_curve_mlp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored_curve(spark, sf_dir, _MLP_TASK)


def loss_curves_shared_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both models trained on the same passes, with the regularised objective beside the loss."""
    rows = [
        (fit.name, epoch, round(loss, 6), round(objective, 6))
        for fit in _train(spark, sf_dir, [_SVR_TASK, _MLP_TASK])
        for epoch, loss, objective in fit.history
    ]
    return spark.createDataFrame(rows, "model string, epoch int, loss double, objective double")


# A network as wide as the levy job's, with weights by rule, on eight inputs with gaps.
WIDE = MlpLoss(8, hidden=16)
WIDE_TASK = Task("wide", WIDE, 1, 0.1, theta=tuple(round(math.sin(1 + 7 * i) / 3, 6) for i in range(WIDE.size)))
WIDE_FEATURES = tuple(f"x{i}" for i in range(8))


def mlp_predict_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null features give null, NaN ones NaN. Scores are rounded; NaN is shown as text."""
    columns = ("l_quantity / 50", "l_discount * 10", "l_tax * 10", "l_linenumber / 7", "l_extendedprice / 100000",
               "l_orderkey % 13 / 13", "l_partkey % 11 / 11", "l_suppkey % 7 / 7")
    lines = table(spark, sf_dir, "lineitem")
    inputs = lines.select(*KEYS, *[F.expr(c).cast("double").alias(n) for n, c in zip(WIDE_FEATURES, columns)])
    gaps = inputs.withColumn("x0", F.when(F.col("l_linenumber") != 3, F.col("x0"))).withColumn(
        "x1", F.when(F.col("l_linenumber") == 5, float("nan")).otherwise(F.col("x1")))
    score = mlp_predict(WIDE, WIDE_FEATURES, WIDE_TASK.theta)
    scored = gaps.select(*KEYS, score.alias("score"))
    return scored.select(
        *KEYS, F.when(~F.isnan("score"), F.round("score", 6)).alias("prediction"),
        F.when(F.isnan("score"), "NaN").when(F.col("score").isNull(), "null").otherwise("number").alias("kind"),
    )


QUERIES = {
    "svr_predict": svr_scores,
    "mlp_predict": mlp_scores,
    "mlp_predict_wide": mlp_predict_wide,
    "svr_gradient": svr_gradient,
    "mlp_gradient": mlp_gradient,
    "loss_curve_svr": loss_curve_svr,
    "loss_curve_mlp": loss_curve_mlp,
    "loss_curves_shared_pass": loss_curves_shared_pass,
}

_KEYS_SQL = ", ".join(KEYS)
_D = f"""
    SELECT {_KEYS_SQL}, l_extendedprice / 50000 - 1 AS x1, l_discount * 20 - 1 AS x2,
           l_extendedprice * (1 - l_discount) * (1 + l_tax) / 50000 - 1 AS y
    FROM lineitem
"""
_SVR_SQL = TrainingSql("s", _SVR_TASK, tuple(FEATURES))
_MLP_SQL = TrainingSql("m", _MLP_TASK, tuple(FEATURES))


def _scores(model: TrainingSql, places: int) -> str:
    return f"""
        WITH d AS ({_D}), w AS ({model.start()})
        SELECT {_KEYS_SQL}, round(prediction, {places}) + 0.0 AS prediction FROM ({model.scored("d", "w")}) AS scored
    """


_WIDE_D = f"""
    SELECT {_KEYS_SQL}, CASE WHEN l_linenumber <> 3 THEN l_quantity / 50 END AS x0,
           CASE WHEN l_linenumber = 5 THEN CAST('NaN' AS DOUBLE) ELSE l_discount * 10 END AS x1,
           l_tax * 10 AS x2, l_linenumber / 7 AS x3, l_extendedprice / 100000 AS x4,
           l_orderkey % 13 / 13 AS x5, l_partkey % 11 / 11 AS x6, l_suppkey % 7 / 7 AS x7
    FROM lineitem
"""
_WIDE_SQL = TrainingSql("wide", WIDE_TASK, WIDE_FEATURES)

ORACLES = {
    "mlp_predict_wide": f"""
        WITH d AS ({_WIDE_D}), w AS ({_WIDE_SQL.start()})
        SELECT {_KEYS_SQL}, CASE WHEN NOT isnan(prediction) THEN round(prediction, 6) + 0.0 END AS prediction,
               CASE WHEN isnan(prediction) THEN 'NaN' WHEN prediction IS NULL THEN 'null' ELSE 'number' END AS kind
        FROM ({_WIDE_SQL.scored("d", "w")}) AS scored
    """,
    "svr_predict": _scores(_SVR_SQL, 9),
    "mlp_predict": _scores(_MLP_SQL, 6),
    "svr_gradient": f"""
        WITH d AS ({_D}), w AS ({_SVR_SQL.start()})
        SELECT {", ".join(
            f"round({g}, 6) AS g_{s}" for s, g in zip(["x1", "x2", "bias"], _SVR_SQL.gradients())
        )}, round({_SVR_SQL.loss()}, 6) AS loss
        FROM ({_SVR_SQL.scored("d", "w")}) AS scored
    """,
    "mlp_gradient": f"""
        WITH d AS ({_D}), w AS ({_MLP_SQL.start()}), scored AS ({_MLP_SQL.scored("d", "w")})
    """
    + " UNION ALL ".join(
        f"SELECT CAST({i} AS INT) AS slot, round({g}, 6) AS gradient FROM scored"
        for i, g in enumerate([*_MLP_SQL.gradients(), _MLP_SQL.loss()])
    ),
    "loss_curve_svr": f"""
        WITH d AS ({_D}), {_SVR_SQL.chain()} SELECT epoch, loss FROM ({_SVR_SQL.curve()}) AS curve
    """,
    "loss_curve_mlp": f"""
        WITH d AS ({_D}), {_MLP_SQL.chain()} SELECT epoch, loss FROM ({_MLP_SQL.curve()}) AS curve
    """,
    "loss_curves_shared_pass": f"""
        WITH d AS ({_D}), {_SVR_SQL.chain()}, {_MLP_SQL.chain()}
        {_SVR_SQL.curve()} UNION ALL {_MLP_SQL.curve()}
    """,
}
