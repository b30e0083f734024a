from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession

LOSS_SCHEMA = "epoch int, loss double"
# Text tables repeat names and separators in every row; readers tell the codec from the file's ending.
_GZIP = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}
COMPRESSION = {"json": _GZIP, "csv": _GZIP, "parquet": {"compression": "zstd"}}
# One task reads a whole gzip file.
TEXT_FILE_ROWS = 1_000_000


def write_table(
    df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = (), rebalance: bool = True
) -> None:
    """Overwrite a table with compressed files, one per task, text tables of at most ``TEXT_FILE_ROWS`` rows each.

    With ``partition_by`` the rows are dealt to tasks by those columns first: large partitions are
    split and small ones share a task, so the number of files follows the data and not the width
    of whatever shuffle came before. Without ``rebalance`` they stay in the tasks they are in.
    """
    if partition_by and rebalance:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode("overwrite").format(fmt).options(**COMPRESSION.get(fmt, {}))
    if fmt in ("json", "csv"):
        writer = writer.option("maxRecordsPerFile", TEXT_FILE_ROWS)
    writer.partitionBy(*partition_by).save(path)


def write_delimited(df: DataFrame, path: str, sep: str = ";") -> None:
    """Overwrite delimited text with a header line in every file, compressed as above."""
    writer = df.write.mode("overwrite").option("header", True).option("sep", sep)
    writer.options(**COMPRESSION["csv"]).option("maxRecordsPerFile", TEXT_FILE_ROWS).csv(path)


def write_single_file(
    df: DataFrame, path: str, fmt: str = "json", order: Sequence[str | Column] = ()
) -> None:
    """One part file, for report-sized results, sorted by ``order``.

    ``repartition`` and not ``coalesce``: the work upstream keeps its parallelism and
    only the finished rows meet in one task. They are sorted there, as rows that come through a
    shuffle have no order.
    """
    met = df.repartition(1)
    (met.sortWithinPartitions(*order) if order else met).write.mode("overwrite").format(fmt).save(path)


def write_metrics(df: DataFrame, out: str, name: str) -> None:
    write_single_file(df, f"{out}/metrics/{name}.json")


def write_loss_curve(
    spark: SparkSession, model: str, curve: Iterable[tuple[int, float]], out: str
) -> None:
    """``(epoch, loss)`` rows of one model under ``loss_curves/<model>_loss.json``."""
    rows = [(int(epoch), float(loss)) for epoch, loss in curve]
    write_single_file(spark.createDataFrame(rows, LOSS_SCHEMA), f"{out}/loss_curves/{model}_loss.json")
