"""Full-batch gradient descent over blocks.

Per epoch every task reduces its blocks to one vector of sums. The vectors are added
in a tree of bounded fan-in, so what reaches the driver does not grow with the number
of partitions. Several models with the same inputs share each pass over the data.

An epoch is a job of its own. A barrier stage that keeps the blocks and gathers the sums was tried: it gives
the same bits, but ``allGather`` waits in steps of a second, several times what a job takes.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from levyflow.models.blocks import Blocks, matrix

# A built type: a DDL string would be parsed again by every epoch.
SUMS_SCHEMA = T.StructType(
    [T.StructField("part", T.LongType()), T.StructField("sums", T.ArrayType(T.DoubleType()))]
)
FAN_IN = 256
# Blocks handed to a Python worker at a time: a batch is put together in memory before any of it is sent.
BATCH_BLOCKS = 4


class Loss(Protocol):
    """A model's loss; its parameters are one flat vector."""

    @property
    def size(self) -> int: ...

    def start(self, seed: int) -> np.ndarray: ...

    def sums(self, theta: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
        """Gradient and loss, each summed over the rows; ``x`` has one line per feature."""

    def penalty(self, theta: np.ndarray) -> tuple[np.ndarray, float]:
        """Gradient and value of the regularisation term."""


@dataclass(frozen=True)
class Task:
    name: str
    loss: Loss
    epochs: int
    rate: float
    seed: int = 42
    theta: Sequence[float] | None = None


@dataclass(frozen=True)
class Fit:
    """Final parameters and ``(epoch, loss, objective)``, both taken before the epoch's step."""

    name: str
    loss: Loss
    theta: np.ndarray
    history: tuple[tuple[int, float, float], ...]

    @property
    def curve(self) -> list[tuple[int, float]]:
        return [(epoch, loss) for epoch, loss, _ in self.history]


def _sums(blocks: Iterator[np.ndarray], losses: Sequence[Loss], thetas: Sequence[np.ndarray]) -> np.ndarray | None:
    """Gradients and losses of all models, one behind the other, summed over a task's blocks."""
    total = None
    for lines in blocks:
        x, y = lines[:-1], lines[-1]
        parts = []
        for loss, theta in zip(losses, thetas):
            gradient, value = loss.sums(theta, x, y)
            parts += [gradient, [value]]
        sums = np.concatenate(parts)
        total = sums if total is None else total + sums
    return total


def _split(total: np.ndarray, losses: Sequence[Loss]) -> list[tuple[np.ndarray, float]]:
    pieces = np.split(total, np.cumsum([loss.size + 1 for loss in losses])[:-1])
    return [(piece[:-1], float(piece[-1])) for piece in pieces]


def _matrices(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[np.ndarray]:
    for batch in batches:
        for block in batch.column(0):
            yield matrix(block.as_buffer(), width)


def _partial(
    losses: Sequence[Loss], thetas: Sequence[np.ndarray], width: int
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def reduce_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = _sums(_matrices(batches, width), losses, thetas)
        if total is not None:
            yield _one_row(TaskContext.get().partitionId(), total)

    return reduce_partition


def _one_row(part: int, sums: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([part], pa.int64()), pa.array([sums.tolist()], pa.list_(pa.float64()))],
        names=["part", "sums"],
    )


def ordered_sum(parts: Sequence[tuple[int, Sequence[float]]]) -> np.ndarray:
    """Exactly rounded sum per slot, so the order of arrival leaves no trace."""
    return np.array([math.fsum(slot) for slot in zip(*(sums for _, sums in sorted(parts)))])


def _merge(table: pa.Table) -> pa.Table:
    parts = list(zip(table["part"].to_pylist(), table["sums"].to_pylist()))
    return pa.Table.from_batches([_one_row(table["group"][0].as_py(), ordered_sum(parts))])


def tree_sum(partials: DataFrame, partitions: int, fan_in: int = FAN_IN) -> np.ndarray:
    """Add up one vector per partition; at most ``fan_in`` of them meet in any one place."""
    while partitions > fan_in:
        group = F.floor(F.col("part") / fan_in).alias("group")
        partials = (
            partials.select(group, "part", "sums").groupBy("group").applyInArrow(_merge, SUMS_SCHEMA)
        )
        partitions = math.ceil(partitions / fan_in)
    return ordered_sum([(r["part"], r["sums"]) for r in partials.collect()])


def gradient_sums(
    blocks: Blocks, losses: Sequence[Loss], thetas: Sequence[np.ndarray], fan_in: int = FAN_IN
) -> list[tuple[np.ndarray, float]]:
    """Summed gradient and loss of every model, from one pass over the blocks."""
    partials = blocks.data.select("block").mapInArrow(
        _partial(losses, thetas, blocks.width), SUMS_SCHEMA
    )
    return _split(tree_sum(partials, blocks.partitions, fan_in), losses)


@contextmanager
def fixed_plans(spark: SparkSession) -> Iterator[None]:
    """Adaptive planning off: a pass over cached blocks has nothing to adapt, and the extra
    job that looks up the cached table would be paid in every epoch. Blocks go to Python in small batches."""
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.execution.arrow.maxRecordsPerBatch": str(BATCH_BLOCKS)}
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def descend(blocks: Blocks, tasks: Sequence[Task], store: str | None = None, every: int = 50) -> list[Fit]:
    """Train all ``tasks``; an epoch of every unfinished one is a single Spark job.

    With ``store``, a folder, the weights and losses so far are written there after each ``every`` epochs and at
    the end. A call with the same rows and settings goes on from the last of them that is not beyond its own
    epochs; weights of other rows, rates, losses or starts are left alone. The rows are the same if their values
    are, in whatever order and partitions.
    """
    with fixed_plans(blocks.data.sparkSession):
        return _descend(blocks, tasks, store, every)


STATE_SCHEMA = "name string, stamp string, epoch int, theta array<double>, losses array<double>, objectives array<double>"
State = tuple[np.ndarray, list[tuple[int, float, float]]]


def stamp(blocks: Blocks, task: Task) -> str:
    """Stands for everything that the weights after an epoch depend on: rows, model, rate and start."""
    start = task.loss.start(task.seed) if task.theta is None else task.theta
    parts = (blocks.digest, blocks.rows, blocks.width, repr(task.loss), float(task.rate), [float(v).hex() for v in start])
    return hashlib.sha256(repr(parts).encode()).hexdigest()


def load_weights(spark: SparkSession, store: str, wanted: dict[str, tuple[str, int]]) -> dict[str, State]:
    """By model the weights and the history of the last stored epoch, for ``wanted`` stamps and most epochs."""
    path = spark._jvm.org.apache.hadoop.fs.Path(store)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        return {}
    # A folder without the success mark was being written when its driver was lost.
    done = [str(s.getPath()) for s in files.listStatus(path)
            if files.exists(spark._jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS"))]
    found: dict[str, State] = {}
    for r in spark.read.schema(STATE_SCHEMA).parquet(*done).collect() if done else []:
        mark, epochs = wanted.get(r["name"], (None, 0))
        if r["stamp"] == mark and r["epoch"] <= epochs and r["epoch"] > len(found.get(r["name"], ((), ()))[1]):
            history = list(zip(range(1, r["epoch"] + 1), r["losses"], r["objectives"]))
            found[r["name"]] = (np.array(r["theta"]), history)
    return found


def _save(spark: SparkSession, store: str, epoch: int, stamps: dict[str, str], states: dict[str, State]) -> None:
    rows = [
        (name, stamps[name], len(history), theta.tolist(), [h[1] for h in history], [h[2] for h in history])
        for name, (theta, history) in states.items()
    ]
    table = spark.createDataFrame(rows, STATE_SCHEMA).coalesce(1)
    own = hashlib.sha256(repr(sorted(stamps.items())).encode()).hexdigest()[:12]
    table.write.mode("overwrite").parquet(f"{store}/epoch-{epoch:06d}-{own}")


def _live(tasks: Sequence[Task], states: dict[str, State], epoch: int) -> list[Task]:
    return [t for t in tasks if len(states[t.name][1]) < epoch <= t.epochs]


def _step(live: Sequence[Task], states: dict[str, State], sums: Sequence[tuple[np.ndarray, float]], epoch: int, rows: int) -> None:
    for task, (gradient, value) in zip(live, sums):
        theta, history = states[task.name]
        pull, penalty = task.loss.penalty(theta)
        mean_loss = value / rows
        history.append((epoch, mean_loss, mean_loss + penalty))
        states[task.name] = (theta - task.rate * (gradient / rows + pull), history)


def _descend(blocks: Blocks, tasks: Sequence[Task], store: str | None, every: int) -> list[Fit]:
    spark = blocks.data.sparkSession
    states: dict[str, State] = {
        t.name: (np.array(t.loss.start(t.seed) if t.theta is None else t.theta, dtype=np.float64), []) for t in tasks
    }
    stamps = {t.name: stamp(blocks, t) for t in tasks} if store else {}
    if store:
        states |= load_weights(spark, store, {t.name: (stamps[t.name], t.epochs) for t in tasks})
    last = max(t.epochs for t in tasks)
    for epoch in range(1, last + 1):
        live = _live(tasks, states, epoch)
        if not live:
            continue
        _step(live, states, gradient_sums(blocks, [t.loss for t in live], [states[t.name][0] for t in live]), epoch, blocks.rows)
        if store and (epoch % every == 0 or epoch == last):
            _save(spark, store, epoch, stamps, states)
    return [Fit(t.name, t.loss, states[t.name][0], tuple(states[t.name][1])) for t in tasks]
