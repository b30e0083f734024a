"""Further billing files into tables that are stored already.

A load reads the files that no load before it has read, and merges them by key. Which row a key keeps is
the first of a total order, so it does not matter in how many loads the files came: the tables are those
of one load of all. Only the periods that occur in the new files are read and written again.

Everything is put together beside the tables before any of them is touched, and the manifest of read
files is written last. A load that is lost on the way is run again, and merging rows twice changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from levyflow.config import LevyConfig
from levyflow.plans.etl import COUNTS_SCHEMA, clean, dimension_schema, fact_schema, newest_bills, write_width
from levyflow.sizing import sized_shuffles
from levyflow.sources.readers import read_delimited, read_table
from levyflow.sources.scratch import drop_path, path_exists, scratch_path
from levyflow.sources.writers import COMPRESSION, write_table

MANIFEST_SCHEMA = "path string, length bigint, modified timestamp"
# Beside the tables: what the dimension's rows are compared by, and the files read.
STATE, MANIFEST = "state", "manifest"


def read_manifest(spark: SparkSession, out: str) -> DataFrame:
    """``(path, length, modified)`` of the files that loads below ``out`` have read."""
    path = f"{out}/{MANIFEST}"
    if not path_exists(spark, path):
        return spark.createDataFrame([], MANIFEST_SCHEMA)
    return spark.read.schema(MANIFEST_SCHEMA).parquet(path)


def new_files(spark: SparkSession, path: str, out: str) -> DataFrame:
    """The files below ``path`` that no load has read. One that was read and has changed since is an
    error: what it brought then cannot be told from what other files brought."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    found = listed.select("path", "length", F.col("modificationTime").alias("modified")).where(F.col("length") > 0)
    known = read_manifest(spark, out).withColumnsRenamed({"length": "old_length", "modified": "old_modified"})
    matched = found.join(known, "path", "left")
    changed = matched.where((F.col("length") != F.col("old_length")) | (F.col("modified") != F.col("old_modified")))
    first = changed.select("path").orderBy("path").first()
    if first is not None:
        raise ValueError(f"a file that was loaded before has changed: {first['path']}")
    return matched.where(F.col("old_length").isNull()).select("path", "length", "modified")


def _state_schema(config: LevyConfig) -> T.StructType:
    kinds = {config.cut_date: T.IntegerType(), config.period: T.IntegerType()}
    names = (config.taxpayer, config.taxpayer_name, config.period, config.cut_date)
    return T.StructType([T.StructField(c, kinds.get(c, T.StringType())) for c in names])


def latest_state(rows: DataFrame, config: LevyConfig) -> DataFrame:
    """One row per taxpayer, with the period and cut date that make it the latest."""
    order = [F.desc_nulls_last(c) for c in (config.period, config.cut_date, config.taxpayer_name)]
    window = Window.partitionBy(config.taxpayer).orderBy(*order)
    ranked = rows.select(*_state_schema(config).names).withColumn("__rank", F.row_number().over(window))
    return ranked.where(F.col("__rank") == 1).drop("__rank")


def _replace(spark: SparkSession, ready: str, target: str) -> None:
    """Put a finished folder in the place of another. Between the two steps the finished one can be found
    beside it, and the next load takes it from there."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(target).getFileSystem(spark._jsc.hadoopConfiguration())
    files.delete(path(target), True)
    files.mkdirs(path(target).getParent())
    if not files.rename(path(ready), path(target)):
        raise OSError(f"cannot move {ready} to {target}")


def _recover(spark: SparkSession, target: str) -> None:
    """Take over a finished folder whose place is still empty; one beside a full place is an older try."""
    ready = f"{target}.ready"
    if path_exists(spark, f"{ready}/_SUCCESS") and not path_exists(spark, target):
        _replace(spark, ready, target)


def load_increment(
    spark: SparkSession,
    path: str,
    out: str,
    config: LevyConfig = LevyConfig(table_formats=("parquet",)),
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Merge the new files below ``path`` into the tables below ``out/tables``; return ``(table, rows)``.

    ``raw`` counts the lines of the new files, ``periods`` the partitions of the fact table that were written
    again, and the tables their rows afterwards. Without new files nothing is written. Tables are Parquet, the
    fact table partitioned by period; one that another job has written is not merged with, as its files are in no
    manifest. A null period is a partition of its own. Empty files are passed over.
    """
    if tuple(config.table_formats) != ("parquet",):
        raise ValueError("incremental loads keep Parquet tables only")
    fact_path = f"{out}/tables/{config.fact_table}.parquet"
    dimension_path, state_path = f"{out}/tables/{config.dimension_table}.parquet", f"{out}/{STATE}"
    for target in (state_path, dimension_path, f"{out}/{MANIFEST}"):
        _recover(spark, target)
    files = new_files(spark, path, out).collect()  # the driver lists them anyway
    names = [r["path"] for r in files]
    fresh = not path_exists(spark, state_path)
    if fresh and not read_manifest(spark, out).isEmpty():
        raise ValueError(f"{out} has a manifest and no state")
    if fresh and path_exists(spark, fact_path) and not path_exists(spark, f"{out}/loading"):
        raise ValueError(f"{fact_path} was not written by an incremental load")
    if not names:
        return _counts(spark, out, config, 0, 0)

    raw = read_delimited(spark, names, config.delimiter, columns)
    needed = list(dict.fromkeys((*config.fact_columns, config.taxpayer_name)))
    staged_path, merged_path = scratch_path(spark, "clean"), scratch_path(spark, "merged")
    try:
        write_table(clean(raw, config).select(*needed), staged_path)
        staged = spark.read.parquet(staged_path)
        lines = staged.count()
        # One row a period, of which the table has a folder each.
        periods = [r[0] for r in staged.select(config.period).distinct().collect()]
        fact = staged.select(*config.fact_columns)
        state = staged
        if path_exists(spark, fact_path):
            touched = F.col(config.period).isin([p for p in periods if p is not None])
            if None in periods:
                touched = touched | F.col(config.period).isNull()
            # The condition is on the partition column: folders of other periods are not listed to be read.
            fact = read_table(spark, fact_path, fact_schema(config)).where(touched).unionByName(fact)
        if not fresh:
            state = read_table(spark, state_path, _state_schema(config)).unionByName(
                staged.select(*_state_schema(config).names))
        width = write_width(fact, len(periods))
        with sized_shuffles(fact, width):
            write_table(newest_bills(fact, config), merged_path, "parquet", [config.period], rebalance=width is None)
        with sized_shuffles(fact):
            write_table(latest_state(state, config), f"{state_path}.ready")
        # From here on the tables change; all that goes into them is stored.
        spark.createDataFrame([(len(names),)], "files int").write.mode("overwrite").parquet(f"{out}/loading")
        merged = read_table(spark, merged_path, fact_schema(config))
        # Its files are of the right size by now: they are copied as they are, without a shuffle.
        (merged.write.mode("overwrite").options(**COMPRESSION["parquet"])
         .option("partitionOverwriteMode", "dynamic").partitionBy(config.period).parquet(fact_path))
        write_table(
            read_table(spark, f"{state_path}.ready", _state_schema(config)).select(config.taxpayer, config.taxpayer_name),
            f"{dimension_path}.ready",
        )
        _replace(spark, f"{dimension_path}.ready", dimension_path)
        _replace(spark, f"{state_path}.ready", state_path)
        read = read_manifest(spark, out).unionByName(spark.createDataFrame(files, MANIFEST_SCHEMA))
        write_table(read, f"{out}/{MANIFEST}.ready")
        _replace(spark, f"{out}/{MANIFEST}.ready", f"{out}/{MANIFEST}")
    finally:
        drop_path(spark, staged_path)
        drop_path(spark, merged_path)
    return _counts(spark, out, config, lines, len(periods))


def _counts(spark: SparkSession, out: str, config: LevyConfig, lines: int, periods: int) -> DataFrame:
    counts = [("raw", lines), ("periods", periods)]
    schemas = {config.dimension_table: dimension_schema(config), config.fact_table: fact_schema(config)}
    for name, schema in schemas.items():  # a table without rows may have no file to tell its columns
        path = f"{out}/tables/{name}.parquet"
        counts.append((name, read_table(spark, path, schema).count() if path_exists(spark, path) else 0))
    return spark.createDataFrame(counts, COUNTS_SCHEMA)
