"""The shared test tables, and the levy data set derived from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from levyflow.config import RAW_COLUMNS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# One bill per line item: supplier as taxpayer, part as property, ship date as cut date.
# A line without discount is a solely owned property. Written in the SQL that both
# engines share; the rounding is on decimals, where they agree on ties.
LEVY_SQL = """
SELECT CAST(year(l_shipdate) * 10000 + month(l_shipdate) * 100 + day(l_shipdate) AS INT) AS FECHA_CORTE,
       CAST(year(l_shipdate) AS INT) AS PERIODO,
       concat('T', CAST(l_suppkey AS STRING)) AS COD_CONTRIBUYENTE,
       concat(l_returnflag, l_linestatus, ' ', CAST(l_orderkey AS STRING)) AS NOM_CONTRIBUYENTE,
       concat('P', CAST(l_partkey AS STRING)) AS COD_PREDIO,
       CAST(CASE WHEN l_discount = 0 THEN 100 ELSE 60 - 4 * l_linenumber END AS DOUBLE)
           AS PORCENTAJE_CONDOMINIO,
       CAST(l_quantity AS DOUBLE) AS MONTO_PARQUE_JARDIN,
       CAST(round(price * (1 - discount) * (1 + tax), 2) AS DOUBLE) AS MONTO_SERENAZGO,
       CAST(price AS DOUBLE) AS MONTO_RESIDUO_SOLIDO,
       CAST(round(price * tax, 2) AS DOUBLE) AS MONTO_BARRIDO_CALLE,
       CAST(round(l_quantity / 4, 2) AS DOUBLE) AS DESCUENTO_TOPE_PARQUE_JARDIN,
       CAST(round(price * tax * discount, 2) AS DOUBLE) AS DESCUENTO_TOPE_SERENAZGO,
       CAST(round(price * discount, 2) AS DOUBLE) AS MONTO_TOPE_RESIDUO_SOLIDO,
       CAST(l_linenumber AS DOUBLE) AS DESCUENTO_TOPE_BARRIO_CALLE,
       'D1' AS DEPARTAMENTO, 'P1' AS PROVINCIA, 'X1' AS DISTRITO,
       lpad(CAST(l_linenumber AS STRING), 6, '0') AS UBIGEO
FROM (SELECT *, CAST(l_extendedprice AS DECIMAL(12, 2)) AS price,
             CAST(l_discount AS DECIMAL(4, 2)) AS discount,
             CAST(l_tax AS DECIMAL(4, 2)) AS tax FROM lineitem) AS lines
"""

# A full year of the derived data set stands in for the report period.
LEVY_PERIOD = 2000


def levy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The levy data set as a typed table."""
    lines = table(spark, sf_dir, "lineitem")
    return spark.sql(LEVY_SQL.replace("FROM lineitem", "FROM {lineitem}"), lineitem=lines)


def levy_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as it would stand in the source file: text, money like ``1,257.60``."""
    typed = levy(spark, sf_dir)

    def as_text(name: str, kind: str):
        return F.format_number(name, 2) if kind == "double" else F.col(name).cast("string")

    return typed.select(*[as_text(n, k).alias(n) for n, k in typed.dtypes]).select(*RAW_COLUMNS)
