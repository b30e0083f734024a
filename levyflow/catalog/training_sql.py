"""SQL twins of the regressors: every epoch of full-batch descent is two common table expressions.

All of them read a table ``d`` that has the features and the label ``y``. For a prefix
``p``, ``p_w<i>`` holds the one row of parameters before epoch ``i + 1`` and ``p_g<i>``
the mean gradient and mean loss found there.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from levyflow.models.descent import Task
from levyflow.models.mlp import MlpLoss


def _sum(terms: Sequence[str]) -> str:
    return " + ".join(terms)


@dataclass(frozen=True)
class TrainingSql:
    """One model as SQL: its slots in the order of its parameter vector."""

    prefix: str
    task: Task
    features: tuple[str, ...]

    @property
    def is_mlp(self) -> bool:
        return isinstance(self.task.loss, MlpLoss)

    @property
    def slots(self) -> list[str]:
        inputs = range(len(self.features))
        if not self.is_mlp:
            return [*(f"w{i}" for i in inputs), "b"]
        units = range(self.task.loss.hidden)
        return [*(f"w{h}_{i}" for h in units for i in inputs), *(f"b{h}" for h in units),
                *(f"v{h}" for h in units), "c"]

    def start(self) -> str:
        return "SELECT " + ", ".join(f"{v}::DOUBLE AS {s}" for s, v in zip(self.slots, self.task.theta))

    def scored(self, source: str, weights: str) -> str:
        """Rows of ``source`` with the parameters, the ``prediction`` and, for an MLP, ``h<unit>``."""
        if not self.is_mlp:
            value = _sum([f"w{i} * {f}" for i, f in enumerate(self.features)])
            return f"SELECT *, {value} + b AS prediction FROM {source} CROSS JOIN {weights}"
        units = range(self.task.loss.hidden)
        active = ", ".join(
            f"tanh({_sum([f'w{h}_{i} * {f}' for i, f in enumerate(self.features)])} + b{h}) AS h{h}"
            for h in units
        )
        output = _sum([f"v{h} * h{h}" for h in units])
        inner = f"SELECT *, {active} FROM {source} CROSS JOIN {weights}"
        return f"SELECT *, {output} + c AS prediction FROM ({inner}) AS active"

    def gradients(self) -> list[str]:
        """Mean gradient per slot over scored rows."""
        if not self.is_mlp:
            loss = self.task.loss
            side = f"CASE WHEN abs(y - prediction) > {loss.epsilon} THEN -sign(y - prediction) ELSE 0 END"
            return [*(f"avg(({side}) * {f})" for f in self.features), f"avg(CAST({side} AS DOUBLE))"]
        slope = "2 * (prediction - y)"
        units = range(self.task.loss.hidden)
        back = [f"{slope} * v{h} * (1 - h{h} * h{h})" for h in units]
        return [*(f"avg({back[h]} * {f})" for h in units for f in self.features),
                *(f"avg({back[h]})" for h in units), *(f"avg({slope} * h{h})" for h in units),
                f"avg({slope})"]

    def loss(self) -> str:
        if self.is_mlp:
            return "avg((prediction - y) * (prediction - y))"
        return f"avg(greatest(abs(y - prediction) - {self.task.loss.epsilon}, 0))"

    def objective(self) -> str:
        if self.is_mlp:
            return "loss"
        squares = _sum([f"w{i} * w{i}" for i in range(len(self.features))])
        return f"loss + {self.task.loss.l2 / 2} * ({squares})"

    def chain(self, source: str = "d") -> str:
        """The common table expressions of all epochs; the last one is the trained model."""
        p, rate = self.prefix, self.task.rate
        parts = [f"{p}_w0 AS ({self.start()})"]
        for i in range(self.task.epochs):
            sums = ", ".join(f"{g} AS g_{s}" for s, g in zip(self.slots, self.gradients()))
            rows = self.scored(source, f"{p}_w{i}")
            parts.append(f"{p}_g{i} AS (SELECT {sums}, {self.loss()} AS loss FROM ({rows}) AS scored)")
            moved = ", ".join(f"{s} - {rate} * ({self._step(s)}) AS {s}" for s in self.slots)
            parts.append(f"{p}_w{i + 1} AS (SELECT {moved} FROM {p}_w{i} CROSS JOIN {p}_g{i})")
        return ", ".join(parts)

    def _step(self, slot: str) -> str:
        regularised = not self.is_mlp and slot != "b"
        return f"g_{slot} + {self.task.loss.l2} * {slot}" if regularised else f"g_{slot}"

    def curve(self) -> str:
        p = self.prefix
        return " UNION ALL ".join(
            f"SELECT '{self.task.name}' AS model, CAST({i + 1} AS INT) AS epoch, round(loss, 6) AS loss, "
            f"round({self.objective()}, 6) AS objective FROM {p}_g{i} CROSS JOIN {p}_w{i}"
            for i in range(self.task.epochs)
        )
