"""Shared helpers: a local session, the test tables in DuckDB, and an exact comparison."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

import duckdb
import pandas as pd
from pyspark.sql import SparkSession


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master("local[8]")
        .appName("levyflow-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@contextmanager
def scratch_below(spark: SparkSession, root: str) -> Iterator[None]:
    """Another shared folder for a while. The setting is fixed once a session has begun, so that it is
    written past the session's check."""
    name, settings = "spark.checkpoint.dir", spark._jsparkSession.sessionState().conf()
    before = spark.conf.get(name, None)
    settings.setConfString(name, root)
    try:
        yield
    finally:
        settings.unsetConf(name) if before is None else settings.setConfString(name, before)


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        db.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return db


def compare(frame: pd.DataFrame, db: duckdb.DuckDBPyConnection, sql: str) -> str:
    """``ok (n rows)``, or what differs: names, row count, types or the first differing rows."""
    expected = db.execute(sql).fetch_df()
    if sorted(frame.columns) != sorted(expected.columns):
        return f"columns {sorted(frame.columns)} != {sorted(expected.columns)}"
    if len(frame) != len(expected):
        return f"rows {len(frame)} != {len(expected)}"
    names = sorted(frame.columns)
    kinds = {n: (frame[n].dtype, expected[n].dtype) for n in names if frame[n].dtype != expected[n].dtype}
    if kinds:
        return f"types {kinds}"

    def rows(table: pd.DataFrame) -> list[tuple]:
        return sorted(table[names].astype(object).itertuples(index=False, name=None), key=repr)

    wrong = [(a, b) for a, b in zip(rows(frame), rows(expected)) if repr(a) != repr(b)]
    return f"{len(wrong)} rows differ: {wrong[:2]}" if wrong else f"ok ({len(frame)} rows)"
