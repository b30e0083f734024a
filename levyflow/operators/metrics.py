"""Error metrics as aggregates, and comparison of runs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _r2(mse: Column, variance: Column) -> Column:
    # A constant label has no variance to explain: 0/0 is NaN, x/0 is minus infinity.
    flat = F.when(mse == 0, F.lit(float("nan"))).otherwise(F.lit(float("-inf")))
    return F.when(variance == 0, flat).otherwise(1 - F.try_divide(mse, variance))


def regression_metrics(
    df: DataFrame, predictions: Mapping[str, str], label: str, by: Sequence[str] = ()
) -> DataFrame:
    """``(model, rmse, mse, mae, r2)`` for every prediction column, all from one pass.

    ``predictions`` maps a model's name to its column. With ``by``, one row per model
    and group. Rows without a label or without a model's prediction count for nothing in
    that model's row.
    """
    y = F.col(label).cast("double")
    wanted = []
    for i, column in enumerate(predictions.values()):
        error = F.col(column) - y
        explained = F.when(F.col(column).isNotNull(), y)
        wanted += [F.avg(error * error).alias(f"mse{i}"), F.avg(F.abs(error)).alias(f"mae{i}"),
                   F.var_pop(explained).alias(f"variance{i}")]
    totals = df.groupBy(*by).agg(*wanted)
    per_model = F.array(
        *[
            F.struct(
                F.lit(name).alias("model"),
                F.sqrt(f"mse{i}").alias("rmse"),
                F.col(f"mse{i}").alias("mse"),
                F.col(f"mae{i}").alias("mae"),
                _r2(F.col(f"mse{i}"), F.col(f"variance{i}")).alias("r2"),
            )
            for i, name in enumerate(predictions)
        ]
    )
    return totals.select(*by, F.inline(per_model))


def confusion_table(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """``(label, prediction, rows)``: the only pass over the data that classification metrics need."""
    return df.groupBy(
        F.col(label).cast("double").alias("label"), F.col(prediction).cast("double").alias("prediction")
    ).agg(F.count(F.lit(1)).alias("rows"))


def classification_metrics(confusion: DataFrame, model: str | None = None, by: Sequence[str] = ()) -> DataFrame:
    """``(model, accuracy, precision, recall, f1)``, the last three weighted by class size.

    A class that is never predicted has precision 0. With ``by``, one row per group and its columns first;
    without a ``model`` the column of that name is left to ``by``.
    """
    by = list(by)
    hit = F.when(F.col("label") == F.col("prediction"), F.col("rows")).otherwise(0)
    zero = F.lit(0).cast("bigint")
    # Each cell counts once for its label and once for its prediction.
    sides = F.array(
        F.struct(F.col("label").alias("class"), F.col("rows").alias("actual"), zero.alias("predicted"),
                 hit.alias("hits")),
        F.struct(F.col("prediction").alias("class"), zero.alias("actual"), F.col("rows").alias("predicted"),
                 zero.alias("hits")),
    )
    classes = (
        confusion.select(*by, F.inline(sides))
        .groupBy(*by, "class")
        .agg(*[F.sum(c).alias(c) for c in ("actual", "predicted", "hits")])
    )
    precision = F.coalesce(F.try_divide("hits", "predicted"), F.lit(0.0))
    recall = F.coalesce(F.try_divide("hits", "actual"), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2 * precision * recall, precision + recall), F.lit(0.0))

    def weighted(value: Column) -> Column:
        return F.try_divide(F.sum(value * F.col("actual")), F.sum("actual"))

    scores = classes.groupBy(*by).agg(
        F.try_divide(F.sum("hits"), F.sum("actual")).alias("accuracy"),
        weighted(precision).alias("precision"),
        weighted(recall).alias("recall"),
        weighted(f1).alias("f1"),
    )
    named = [] if model is None else [F.lit(model).alias("model")]
    return scores.select(*by, *named, "accuracy", "precision", "recall", "f1")


def majority_metrics(confusion: DataFrame, model: str = "MajorityClass") -> DataFrame:
    """The same metrics for a predictor that always answers the most frequent label.

    With ``p`` the share of that label they are p, p^2, p and 2p^2/(1+p): the level a
    classifier has to beat.
    """
    actual = confusion.groupBy("label").agg(F.sum("rows").alias("rows"))
    p = F.col("p")
    return actual.agg(F.try_divide(F.max("rows"), F.sum("rows")).alias("p")).select(
        F.lit(model).alias("model"),
        p.alias("accuracy"),
        (p * p).alias("precision"),
        p.alias("recall"),
        (2 * p * p / (1 + p)).alias("f1"),
    )


def stack_runs(runs: Mapping[str, DataFrame], name: str = "env") -> DataFrame:
    """Tables of several runs under each other, matched by column name, tagged with the run."""
    tagged = [df.withColumn(name, F.lit(run)) for run, df in runs.items()]
    return reduce(DataFrame.unionByName, tagged)


def compare_to_base(
    runs: DataFrame, base: str, elapsed: str = "elapsed", name: str = "env"
) -> DataFrame:
    """Add ``speedup``: elapsed time of the base run over that of each run."""
    base_time = runs.where(F.col(name) == base).agg(F.max(elapsed)).first()[0]
    if base_time is None:
        raise ValueError(f"no run named {base!r} with a time in {elapsed!r}")
    return runs.withColumn("speedup", F.try_divide(F.lit(float(base_time)), F.col(elapsed)))
