"""The tables that come of several loads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from levyflow.catalog.inputs import LEVY_SQL, levy_text
from levyflow.catalog.jobs import _FACT, _KEY
from levyflow.operators.metrics import stack_runs
from levyflow.plans.etl import dimension_schema, fact_schema
from levyflow.plans.incremental import load_increment
from levyflow.sources.readers import read_table
from levyflow.sources.scratch import scratch_path
from levyflow.sources.writers import write_delimited

# The second load brings some taxpayers' bills of the last periods, as text and in SQL.
_LATE = "CAST(PERIODO AS INT) >= 2000 AND COD_CONTRIBUYENTE LIKE '%7'"


def _two_loads(spark: SparkSession, sf_dir: str) -> tuple[str, dict[str, DataFrame]]:
    source, out = scratch_path(spark, "levy"), scratch_path(spark, "loads")
    text, counts = levy_text(spark, sf_dir), {}
    for name, part in (("first", ~F.expr(_LATE)), ("second", F.expr(_LATE))):
        write_delimited(text.where(part), f"{source}/{name}")
        counts[name] = load_increment(spark, source, out)
    counts["third"] = load_increment(spark, source, out)
    return out, counts


def etl_in_two_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact table after a second load has been merged into it."""
    out, _ = _two_loads(spark, sf_dir)
    return read_table(spark, f"{out}/tables/emisiones.parquet", fact_schema())


def etl_in_two_loads_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, _ = _two_loads(spark, sf_dir)
    return read_table(spark, f"{out}/tables/contribuyentes.parquet", dimension_schema())


def etl_load_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(load, table, rows)``: the third load finds no new file, and touches no period."""
    _, counts = _two_loads(spark, sf_dir)
    return stack_runs(counts, "load")


QUERIES = {
    "etl_in_two_loads": etl_in_two_loads,
    "etl_in_two_loads_dimension": etl_in_two_loads_dimension,
    "etl_load_counts": etl_load_counts,
}


def _load_sql(name: str, read: str, part: str) -> str:
    def row(table: str, rows: str) -> str:
        return f"SELECT '{name}' AS load, '{table}' AS \"table\", {rows} AS \"rows\""

    return " UNION ALL ".join([
        f"{row('raw', 'count(*)')} FROM levy WHERE {read}",
        f"{row('periods', 'count(DISTINCT PERIODO)')} FROM levy WHERE {read}",
        f"{row('contribuyentes', 'count(DISTINCT COD_CONTRIBUYENTE)')} FROM levy WHERE {part}",
        f"{row('emisiones', 'count(*)')} FROM (SELECT DISTINCT {', '.join(_KEY)} FROM levy WHERE {part}) AS k",
    ])


ORACLES = {
    "etl_in_two_loads": f"WITH levy AS ({LEVY_SQL}) {_FACT}",
    "etl_in_two_loads_dimension": f"""
        WITH levy AS ({LEVY_SQL})
        SELECT COD_CONTRIBUYENTE, NOM_CONTRIBUYENTE FROM (
            SELECT *, row_number() OVER (
                PARTITION BY COD_CONTRIBUYENTE
                ORDER BY PERIODO DESC NULLS LAST, FECHA_CORTE DESC NULLS LAST, NOM_CONTRIBUYENTE DESC NULLS LAST
            ) AS rn FROM levy
        ) AS ranked WHERE rn = 1
    """,
    "etl_load_counts": f"""
        WITH levy AS ({LEVY_SQL})
        {_load_sql("first", f"NOT ({_LATE})", f"NOT ({_LATE})")} UNION ALL {_load_sql("second", _LATE, "true")}
        UNION ALL {_load_sql("third", "false", "true")}
    """,
}
