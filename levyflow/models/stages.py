"""Fitted models as Spark ML stages, which are stored with a pipeline and loaded in another session.

All a stage knows is in its params, so Spark ML's own writer keeps it: a metadata file each, in any file
system Hadoop knows. A stored pipeline scores raw features: it scales them, predicts and takes the scaling of
the label back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from levyflow.functions.scaling import scale, unscale
from levyflow.models.descent import Fit
from levyflow.models.mlp import MlpLoss, mlp_predict
from levyflow.models.svr import SvrLoss, svr_predict
from levyflow.operators.features import Scaling


class _Stage(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    inputCols = Param(Params._dummy(), "inputCols", "feature columns", TypeConverters.toListString)

    def _value(self, name: str):
        return self.getOrDefault(name)


class ScalerStage(_Stage):
    """Adds a standardised copy of each input column, its name with ``suffix``."""

    means = Param(Params._dummy(), "means", "mean of each column", TypeConverters.toListFloat)
    deviations = Param(Params._dummy(), "deviations", "deviation of each column", TypeConverters.toListFloat)
    suffix = Param(Params._dummy(), "suffix", "ending of the new names", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCols=None, means=None, deviations=None, suffix="_z"):
        super().__init__()
        self._setDefault(suffix="_z")
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        stats = zip(self._value("inputCols"), self._value("means"), self._value("deviations"))
        ending = self._value("suffix")
        return dataset.withColumns({f"{c}{ending}": scale(F.col(c).cast("double"), m, d) for c, m, d in stats})


class _Predictor(_Stage):
    """Predicts from scaled columns; the prediction is in the units of the label."""

    weights = Param(Params._dummy(), "weights", "fitted weights", TypeConverters.toListFloat)
    predictionCol = Param(Params._dummy(), "predictionCol", "new column", TypeConverters.toString)
    labelMean = Param(Params._dummy(), "labelMean", "mean of the label", TypeConverters.toFloat)
    labelDeviation = Param(Params._dummy(), "labelDeviation", "deviation of the label", TypeConverters.toFloat)

    def _start(self, given) -> None:
        self._setDefault(predictionCol="prediction", labelMean=0.0, labelDeviation=1.0)
        self._set(**given)

    def _in_units(self, scaled):
        return unscale(scaled, self._value("labelMean"), self._value("labelDeviation"))


class SvrStage(_Predictor):
    @keyword_only
    def __init__(self, *, inputCols=None, weights=None, predictionCol="prediction", labelMean=0.0, labelDeviation=1.0):
        super().__init__()
        self._start(self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        scaled = svr_predict(self._value("inputCols"), self._value("weights"))
        return dataset.withColumn(self._value("predictionCol"), self._in_units(scaled))


class MlpStage(_Predictor):
    hidden = Param(Params._dummy(), "hidden", "hidden units", TypeConverters.toInt)

    @keyword_only
    def __init__(
        self, *, inputCols=None, weights=None, hidden=None, predictionCol="prediction", labelMean=0.0, labelDeviation=1.0
    ):
        super().__init__()
        self._start(self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        columns = self._value("inputCols")
        scaled = mlp_predict(MlpLoss(len(columns), self._value("hidden")), columns, self._value("weights"))
        return dataset.withColumn(self._value("predictionCol"), self._in_units(scaled))


def regression_stages(fits: Sequence[Fit], scaling: Scaling, features: Sequence[str]) -> list[Transformer]:
    """Scaling and a predictor for each fit, whose column has the name of the fit."""
    means, deviations = zip(*[scaling.features[c] for c in features])
    stages: list[Transformer] = [
        ScalerStage(inputCols=list(features), means=list(means), deviations=list(deviations), suffix="_z")]
    mean, deviation = scaling.label
    for fit in fits:
        common = dict(
            inputCols=[f"{c}_z" for c in features], weights=[float(w) for w in fit.theta], predictionCol=fit.name,
            labelMean=float(mean), labelDeviation=float(deviation),
        )
        svr = isinstance(fit.loss, SvrLoss)
        stages.append(SvrStage(**common) if svr else MlpStage(hidden=fit.loss.hidden, **common))
    return stages


def save_stages(stages: Sequence[Transformer], path: str) -> None:
    """Store the stages as one pipeline, over an older one."""
    PipelineModel(list(stages)).write().overwrite().save(path)


def load_stages(path: str) -> PipelineModel:
    return PipelineModel.load(path)
