"""What several operators need: tables that cut lineage, their sizes, and what rows are told apart by."""

from __future__ import annotations

import gc

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from levyflow.shipping import ship_package
from levyflow.sources.scratch import drop_path, scratch_path

__all__ = ["Scratch", "free_name", "place_key", "ship_package", "stored", "text_hash", "unsigned_hex"]

# Where a null key stands in an order of keys: behind all others.
LAST_KEY = (1 << 63) - 1


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared scratch folder and read back: later jobs, and those that run
    again after an executor is lost, start from the table."""
    path = scratch_path(df.sparkSession, label)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """Stored tables of one run, which go when what was made of them is stored itself."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def store(self, df: DataFrame, label: str) -> DataFrame:
        path = scratch_path(self.spark, label)
        df.write.mode("overwrite").parquet(path)
        self.paths.append(path)
        free_shuffles(self.spark)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self) -> None:
        for path in self.paths:
            drop_path(self.spark, path)
        self.paths.clear()
        free_shuffles(self.spark)


def free_shuffles(spark: SparkSession) -> None:
    """Executors keep the files of finished shuffles until the driver collects its garbage, which a
    driver with little to do may put off for half an hour."""
    gc.collect()
    spark._jvm.System.gc()


def place_key(key: str) -> Column:
    """A key as a long that has an order for every row: null stands behind all others."""
    return F.coalesce(F.col(key).cast("long"), F.lit(LAST_KEY))


def text_hash(text: str) -> Column:
    """With the key, what tells rows apart wherever they are read again; null is an empty text."""
    return F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit("")))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def unsigned_hex(column: str):
    """A long as 16 lower-case hex digits."""
    return F.lower(F.lpad(F.hex(column), 16, "0"))
