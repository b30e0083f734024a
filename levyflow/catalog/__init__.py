"""Checked queries: each name maps to a Spark function ``(spark, sf_dir) -> DataFrame`` and,
where SQL can say the same, to the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from levyflow.catalog import classifiers, features, jobs, keyed, loads, metrics, models, reports, resampled, tables

Query = Callable[[SparkSession, str], DataFrame]

_PARTS = (tables, reports, features, metrics, models, classifiers, resampled, jobs, loads, keyed)


def queries() -> dict[str, Query]:
    return {name: query for part in _PARTS for name, query in part.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for part in _PARTS for name, sql in part.ORACLES.items()}
