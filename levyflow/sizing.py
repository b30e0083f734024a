"""Shuffle width from the size of the input."""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame

SETTING = "spark.sql.shuffle.partitions"
# Stored columns are compressed, shuffled rows are hardly so.
EXPANSION = 3
TASK_BYTES = 512 * 1024**2
# Map tasks times reduce tasks is the number of blocks to keep track of: beyond this
# width, larger tasks that spill are the cheaper way.
WIDEST = 50_000
# A task that sorts its rows and writes them, and the least size of the files it should leave.
WRITE_BYTES = 256 * 1024**2
FILE_BYTES = 4 * 1024**2


def stored_bytes(df: DataFrame) -> int:
    """Spark's own estimate of what a plan reads: file sizes, less the pruned columns."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def shuffle_width(stored: int, current: int) -> int:
    return max(current, min(WIDEST, math.ceil(stored * EXPANSION / TASK_BYTES)))


def dealt_width(stored: int, parts: int, cores: int) -> int | None:
    """How many tasks to deal rows to by key, if each of them is to write to all ``parts`` partitions of a
    table; None if that would leave files under ``FILE_BYTES``."""
    width = max(cores, min(WIDEST, math.ceil(stored * EXPANSION / WRITE_BYTES)))
    return width if stored >= width * max(1, parts) * FILE_BYTES else None


@contextmanager
def sized_shuffles(df: DataFrame, width: int | None = None) -> Iterator[None]:
    """Widen the session's shuffles for jobs that send all of ``df`` through one.

    Never narrows them: adaptive execution merges partitions that turn out small, but it
    cannot split what a too narrow shuffle has already written. A ``width`` that has been
    worked out from the input is taken as it is.
    """
    conf = df.sparkSession.conf
    before = conf.get(SETTING)
    conf.set(SETTING, str(width or shuffle_width(stored_bytes(df), int(before))))
    try:
        yield
    finally:
        conf.set(SETTING, before)
