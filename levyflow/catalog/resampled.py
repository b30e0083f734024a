"""Resampling by key: intervals of metrics, and forests that SQL can grow along."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from levyflow.catalog.classifiers import KEYS, _net
from levyflow.catalog.features import bucket_sql
from levyflow.catalog.inputs import table
from levyflow.catalog.metrics import _classified, _regression
from levyflow.models.bagged_forest import fit_bagged_forest
from levyflow.operators.metrics import stack_runs
from levyflow.operators.resampling import (
    CLASSIFICATION,
    REGRESSION,
    SLICES,
    classification_draws,
    draw_weight,
    intervals,
    poisson_limits,
    regression_draws,
)
from levyflow.plans.classification import FOREST_NAME, compare_classifiers

DRAWS = 40
_BAGS = 5
_STUMPS = 3


def _rounded(found: DataFrame) -> DataFrame:
    return found.select("model", "metric", *[F.round(c, 6).alias(c) for c in ("low", "median", "high", "better")])


def metrics_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _regression(spark, sf_dir, *KEYS)
    drawn = regression_draws(rows, {"linear": "linear", "untaxed": "untaxed"}, "net", KEYS, DRAWS)
    return _rounded(intervals(drawn, "linear", REGRESSION))


def class_metrics_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rule by quantity against one that always says class 1."""
    rows = _classified(spark, sf_dir, *KEYS).withColumn("always", F.lit(1))
    drawn = classification_draws(rows, {"rule": "prediction", "always": "always"}, "label", KEYS, DRAWS)
    return _rounded(intervals(drawn, "always", CLASSIFICATION))


def forest_bags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(tree, weight, rows)``: how often each tree of a forest sees how many rows."""
    lines = table(spark, sf_dir, "lineitem").select(*KEYS)
    bags = [
        lines.select(draw_weight(KEYS, tree).alias("weight")).groupBy("weight").agg(F.count(F.lit(1)).alias("rows"))
        for tree in range(_BAGS)
    ]
    return stack_runs({str(tree): bag for tree, bag in enumerate(bags)}, "tree")


def _banded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines by price band, labelled by whether the net price passes 50000."""
    return table(spark, sf_dir, "lineitem").select(
        *KEYS, F.floor(F.col("l_extendedprice") / 5000).cast("int").alias("band"),
        F.when(_net() > 50000, "high").otherwise("low").alias("price_class"),
    )


def forest_stumps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A forest of stumps on all rows: what it answers in each price band, ``(band, prediction, rows)``."""
    rows = _banded(spark, sf_dir).withColumn("label", (F.col("price_class") == "high").cast("double"))
    forest = fit_bagged_forest(rows, ["band"], KEYS, trees=_STUMPS, depth=1, subset="all")
    return forest.transform(rows).groupBy("band", "prediction").agg(F.count(F.lit(1)).alias("rows"))


def forest_held_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metrics of that forest, grown on the training keys, on the others: the whole comparison."""
    run = compare_classifiers(
        _banded(spark, sf_dir), "price_class", ["band"], KEYS, with_baseline=True, trees=_STUMPS, depth=1,
        models=[FOREST_NAME], bagging="key", subset="all",
    )
    return run.metrics.select("model", *[F.round(c, 6).alias(c) for c in CLASSIFICATION])


QUERIES = {
    "metrics_intervals": metrics_intervals,
    "class_metrics_intervals": class_metrics_intervals,
    "forest_bags": forest_bags,
    "forest_stumps": forest_stumps,
    "forest_held_out": forest_held_out,
}

_KEY_LIST = ", ".join(KEYS)


def _weight_sql(number: str) -> str:
    return " + ".join(f"CAST({number} >= {limit} AS INT)" for limit in poisson_limits())


def _draws_sql(draws: int, columns: str) -> str:
    """Rows with ``draw`` and ``w``."""
    number = f"CAST('0x' || substr(md5(concat_ws('|', 42, 'draw', g, {_KEY_LIST})), 1 + 8 * s, 8) AS BIGINT)"
    return f"""
        SELECT {columns}, g * {SLICES} + s AS draw, {_weight_sql(number)} AS w
        FROM lineitem, range({-(-draws // SLICES)}) AS a(g), range({SLICES}) AS b(s)
        WHERE g * {SLICES} + s < {draws}
    """


def _intervals_sql(base: str, metrics: tuple[str, ...], falls: tuple[str, ...]) -> str:
    """From ``scores`` by draw and model."""
    long = " UNION ALL ".join(f"SELECT draw, model, '{m}' AS metric, {m} AS value FROM scores" for m in metrics)
    better = ", ".join(f"'{m}'" for m in falls) or "''"
    return f"""
        , long AS ({long}),
        paired AS (SELECT l.*, b.value AS level FROM long AS l JOIN long AS b USING (draw, metric) WHERE b.model = '{base}')
        SELECT model, metric, round(quantile_cont(value, 0.025), 6) AS low, round(quantile_cont(value, 0.5), 6) AS median,
               round(quantile_cont(value, 0.975), 6) AS high,
               round(avg(CASE WHEN model <> '{base}' THEN
                   CAST(CASE WHEN metric IN ({better}) THEN value < level ELSE value > level END AS INT) END), 6) AS better
        FROM paired GROUP BY 1, 2
    """


_LABEL_SQL = "CAST(l_extendedprice * (1 - l_discount) * (1 + l_tax) > 50000 AS INT)"
_BAND_SQL = "CAST(floor(l_extendedprice / 5000) AS INT)"


def _stumps_sql(rows: str) -> str:
    """``votes (band, p)``: the summed shares of the label 1 by price band, of stumps grown on ``rows``, which have
    band, y, draw and w."""
    return f"""
        drawn_cells AS (SELECT draw, band, sum(w) AS n, sum(w * y) AS ones FROM ({rows}) AS d WHERE w > 0 GROUP BY 1, 2),
        sides AS (
            SELECT t.draw, t.band AS threshold, c.band <= t.band AS low, sum(c.n) AS n, sum(c.ones) AS ones
            FROM drawn_cells AS t JOIN drawn_cells AS c ON t.draw = c.draw GROUP BY 1, 2, 3),
        impurity AS (
            SELECT draw, threshold, sum(2.0 * ones * (n - ones) / n) AS gini FROM sides GROUP BY 1, 2 HAVING count(*) = 2),
        best AS (SELECT draw, arg_min(threshold, gini) AS threshold FROM impurity GROUP BY 1),
        votes AS (
            SELECT band, sum(CAST(ones AS DOUBLE) / n) AS p
            FROM (SELECT DISTINCT {_BAND_SQL} AS band FROM lineitem) AS bands CROSS JOIN best
            JOIN sides ON sides.draw = best.draw AND sides.threshold = best.threshold AND sides.low = (band <= best.threshold)
            GROUP BY 1)
    """


def _grown_on(where: str) -> str:
    drawn = _draws_sql(_STUMPS, f"{_BAND_SQL} AS band, {_LABEL_SQL} AS y, {bucket_sql(KEYS)} AS bucket")
    return f"SELECT * FROM ({drawn}) AS rows_drawn WHERE {where}"


ORACLES = {
    "metrics_intervals": f"""
        WITH drawn AS ({_draws_sql(DRAWS, "l_extendedprice, l_discount, l_tax")}),
        rows_drawn AS (
            SELECT draw, w, l_extendedprice * (1 - l_discount) * (1 + l_tax) / 1000 AS y,
                   unnest(['linear', 'untaxed']) AS model,
                   unnest([l_extendedprice * 0.99::DOUBLE / 1000, l_extendedprice * (1 - l_discount) / 1000]) AS f
            FROM drawn WHERE w > 0),
        centred AS (SELECT *, y - sum(w * y) OVER (PARTITION BY draw, model) / sum(w) OVER (PARTITION BY draw, model) AS c
                    FROM rows_drawn),
        scores AS (
            SELECT draw, model, sqrt(sum(w * (f - y) * (f - y)) / sum(w)) AS rmse, sum(w * (f - y) * (f - y)) / sum(w) AS mse,
                   sum(w * abs(f - y)) / sum(w) AS mae, 1 - sum(w * (f - y) * (f - y)) / sum(w * c * c) AS r2
            FROM centred GROUP BY 1, 2)
        {_intervals_sql("linear", REGRESSION, ("rmse", "mse", "mae"))}
    """,
    "class_metrics_intervals": f"""
        WITH drawn AS ({_draws_sql(DRAWS, "l_extendedprice, l_quantity")}),
        cells AS (
            SELECT draw, model, label, guess, sum(w) AS n FROM (
                SELECT draw, w, CASE WHEN l_extendedprice > 75000 THEN 2 WHEN l_extendedprice > 30000 THEN 1 ELSE 0 END AS label,
                       unnest(['rule', 'always']) AS model, unnest([CASE WHEN l_quantity > 20 THEN 1 ELSE 0 END, 1]) AS guess
                FROM drawn WHERE w > 0) AS r GROUP BY 1, 2, 3, 4),
        classes AS (
            SELECT draw, model, label, sum(n) AS actual, coalesce(sum(n) FILTER (WHERE label = guess), 0) AS hits
            FROM cells GROUP BY 1, 2, 3),
        guesses AS (SELECT draw, model, guess AS label, sum(n) AS guessed FROM cells GROUP BY 1, 2, 3),
        rates AS (
            SELECT draw, model, actual, hits, coalesce(hits / CAST(guessed AS DOUBLE), 0) AS p, hits / CAST(actual AS DOUBLE) AS r
            FROM classes LEFT JOIN guesses USING (draw, model, label)),
        scores AS (
            SELECT draw, model, CAST(sum(hits) AS DOUBLE) / sum(actual) AS accuracy, sum(p * actual) / sum(actual) AS precision,
                   sum(r * actual) / sum(actual) AS recall,
                   sum(CASE WHEN p + r = 0 THEN 0 ELSE 2 * p * r / (p + r) END * actual) / sum(actual) AS f1
            FROM rates GROUP BY 1, 2)
        {_intervals_sql("always", CLASSIFICATION, ())}
    """,
    "forest_bags": f"""
        SELECT CAST(draw AS STRING) AS tree, w AS weight, count(*) AS "rows"
        FROM ({_draws_sql(_BAGS, "l_orderkey")}) AS d GROUP BY 1, 2
    """,
    "forest_stumps": f"""
        WITH {_stumps_sql(_grown_on("true"))}
        SELECT band, CAST(CASE WHEN 2 * p > {_STUMPS} THEN 1 ELSE 0 END AS DOUBLE) AS prediction, count(*) AS "rows"
        FROM (SELECT {_BAND_SQL} AS band FROM lineitem) AS l JOIN votes USING (band) GROUP BY 1, 2
    """,
    "forest_held_out": f"""
        WITH {_stumps_sql(_grown_on("bucket < 80"))},
        cells AS (
            SELECT y, CASE WHEN 2 * p > {_STUMPS} THEN 1 ELSE 0 END AS guess, count(*) AS n
            FROM (SELECT {_BAND_SQL} AS band, {_LABEL_SQL} AS y FROM lineitem WHERE {bucket_sql(KEYS)} >= 80) AS l
            JOIN votes USING (band) GROUP BY 1, 2),
        classes AS (
            SELECT y, sum(n) AS actual, coalesce(sum(n) FILTER (WHERE y = guess), 0) AS hits FROM cells GROUP BY 1),
        rates AS (
            SELECT actual, hits, coalesce(hits / CAST(guessed AS DOUBLE), 0) AS p, hits / CAST(actual AS DOUBLE) AS r
            FROM classes LEFT JOIN (SELECT guess AS y, sum(n) AS guessed FROM cells GROUP BY 1) AS g USING (y)),
        share AS (SELECT max(actual) / CAST(sum(actual) AS DOUBLE) AS m FROM classes)
        SELECT 'RandomForest' AS model, round(CAST(sum(hits) AS DOUBLE) / sum(actual), 6) AS accuracy,
               round(sum(p * actual) / sum(actual), 6) AS precision, round(sum(r * actual) / sum(actual), 6) AS recall,
               round(sum(CASE WHEN p + r = 0 THEN 0 ELSE 2 * p * r / (p + r) END * actual) / sum(actual), 6) AS f1
        FROM rates
        UNION ALL
        SELECT 'MajorityClass', round(m, 6), round(m * m, 6), round(m, 6), round(2 * m * m / (1 + m), 6) FROM share
    """,
}
