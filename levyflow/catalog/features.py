"""Labels, feature preparation, scaling and splitting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from levyflow.catalog.inputs import table
from levyflow.functions.scaling import scale, two_way_label, unscale
from levyflow.operators.features import (
    assemble,
    drop_invalid,
    feature_stats,
    fit_scaling,
    invalid_counts,
    label_frequencies,
    label_stats,
    standardize,
    vector_columns,
    without,
)
from levyflow.operators.splitting import train_test_split

FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = two_way_label(F.col("l_discount"), 0.0, "Exclusive", "Shared")
    return table(spark, sf_dir, "lineitem").withColumn("ownership", label)


def label_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and feature means per label, the labelling column itself left out of the features."""
    features = without(FEATURES, ["l_discount"])
    return _labelled(spark, sf_dir).groupBy("ownership").agg(
        F.count(F.lit(1)).alias("num_rows"), *[F.round(F.avg(c), 6).alias(f"avg_{c}") for c in features]
    )


def label_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return label_frequencies(_labelled(spark, sf_dir), "ownership")


def label_index_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    return label_frequencies(table(spark, sf_dir, "orders"), "o_orderpriority")


def _with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nulls and NaNs put into the features: the tables themselves have none."""
    quantity = F.when(F.col("l_linenumber") != 1, F.col("l_quantity"))
    tax = F.when(F.col("l_linenumber") == 2, F.lit(float("nan"))).otherwise(F.col("l_tax"))
    return table(spark, sf_dir, "lineitem").select(
        *KEYS, quantity.alias("l_quantity"), tax.alias("l_tax"), "l_extendedprice"
    )


def dropna_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_invalid(_with_gaps(spark, sf_dir), ["l_quantity", "l_tax"])


def dropna_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return invalid_counts(_with_gaps(spark, sf_dir), ["l_quantity", "l_tax"])


def feature_scaler_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = feature_stats(table(spark, sf_dir, "lineitem"), FEATURES)
    return stats.select("feature", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"))


def moments_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Means and deviations from exact sums, of features and of a column that is large and hardly moves."""
    lines = table(spark, sf_dir, "lineitem").withColumn("steep", F.col("l_linenumber") + float(2**40))
    stats = feature_stats(lines, [*FEATURES, "steep"], exact=True)
    label = label_stats(lines, "l_extendedprice", exact=True).select(F.lit("label").alias("feature"), "mean", "std")
    return stats.unionByName(label).select("feature", F.round("mean", 8).alias("mean"), F.round("std", 8).alias("std"))


def features_standardized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Includes a column without spread, which becomes 0."""
    lines = table(spark, sf_dir, "lineitem").select(*KEYS, *FEATURES, F.lit(7.0).alias("flat"))
    columns = [*FEATURES, "flat"]
    scaled = standardize(lines, fit_scaling(lines, columns))
    return scaled.select(*KEYS, *[F.round(c, 6).alias(c) for c in columns])


def label_scaler(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = label_stats(table(spark, sf_dir, "lineitem"), "l_extendedprice")
    return stats.select(F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"))


def _scaled_label(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, tuple[float, float]]:
    lines = table(spark, sf_dir, "lineitem").select(*KEYS, "l_extendedprice")
    scaling = fit_scaling(lines, [], "l_extendedprice").label
    return lines.withColumn("scaled", scale(F.col("l_extendedprice"), *scaling)), scaling


def label_scaled(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, _ = _scaled_label(spark, sf_dir)
    return lines.select(*KEYS, F.round("scaled", 6).alias("scaled"))


def label_unscaled(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, scaling = _scaled_label(spark, sf_dir)
    return lines.select(*KEYS, F.round(unscale(F.col("scaled"), *scaling), 4).alias("price"))


def features_assembled(spark: SparkSession, sf_dir: str) -> DataFrame:
    assembled = assemble(_with_gaps(spark, sf_dir), ["l_quantity", "l_tax", "l_extendedprice"])
    return vector_columns(assembled, "features", ["x0", "x1", "x2"], keep=KEYS)


def split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = train_test_split(table(spark, sf_dir, "lineitem"), KEYS)
    sides = train.select("l_shipdate", F.lit("train").alias("side")).unionByName(
        test.select("l_shipdate", F.lit("test").alias("side"))
    )
    return sides.groupBy(F.year("l_shipdate").cast("int").alias("period"), "side").agg(
        F.count(F.lit(1)).alias("num_rows")
    )


def split_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The held-out orders themselves."""
    _, test = train_test_split(table(spark, sf_dir, "orders"), ["o_orderkey"])
    return test.select("o_orderkey", "o_custkey")


QUERIES = {
    "label_binary": label_binary,
    "label_index": label_index,
    "label_index_priority": label_index_priority,
    "dropna_features": dropna_features,
    "dropna_counts": dropna_counts,
    "feature_scaler_stats": feature_scaler_stats,
    "moments_exact": moments_exact,
    "features_standardized": features_standardized,
    "label_scaler": label_scaler,
    "label_scaled": label_scaled,
    "label_unscaled": label_unscaled,
    "features_assembled": features_assembled,
    "split_counts": split_counts,
    "split_keys": split_keys,
}

_KEYS_SQL = ", ".join(KEYS)
_OWNERSHIP = "CASE WHEN l_discount = 0.0 THEN 'Exclusive' ELSE 'Shared' END"
_GAPS = f"""
    SELECT {_KEYS_SQL}, CASE WHEN l_linenumber <> 1 THEN l_quantity END AS l_quantity,
           CASE WHEN l_linenumber = 2 THEN 'nan'::DOUBLE ELSE l_tax END AS l_tax, l_extendedprice
    FROM lineitem
"""
_VALID = "l_quantity IS NOT NULL AND NOT isnan(l_quantity) AND l_tax IS NOT NULL AND NOT isnan(l_tax)"


def bucket_sql(keys: Sequence[str]) -> str:
    return f"CAST('0x' || substr(md5(concat_ws('|', 42, {', '.join(keys)})), 1, 8) AS BIGINT) % 100"


def _frequencies(label: str, source: str) -> str:
    return f"""
        SELECT label, num AS "rows",
               CAST(row_number() OVER (ORDER BY num DESC, label) - 1 AS INT) AS "index"
        FROM (SELECT {label} AS label, count(*) AS num FROM {source} GROUP BY 1) AS counts
    """


# Adding 0.0 makes a plain zero of the negative zero that rounding leaves in DuckDB but not in Spark.
ORACLES = {
    "label_binary": f"""
        SELECT {_OWNERSHIP} AS ownership, count(*) AS num_rows,
               round(avg(l_quantity), 6) AS avg_l_quantity,
               round(avg(l_extendedprice), 6) AS avg_l_extendedprice, round(avg(l_tax), 6) AS avg_l_tax
        FROM lineitem GROUP BY 1
    """,
    "label_index": _frequencies(_OWNERSHIP, "lineitem"),
    "label_index_priority": _frequencies("o_orderpriority", "orders"),
    "dropna_features": f"SELECT * FROM ({_GAPS}) AS g WHERE {_VALID}",
    "dropna_counts": f"""
        SELECT count(*) AS "rows", count(*) FILTER (WHERE {_VALID}) AS kept,
               count(*) - count(*) FILTER (WHERE {_VALID}) AS dropped
        FROM ({_GAPS}) AS g
    """,
    "moments_exact": " UNION ALL ".join(
        f"SELECT '{c}' AS feature, round(avg({c}), 8) AS mean, round(stddev_samp({c}), 8) AS std FROM lineitem" for c in FEATURES
    ) + """
        UNION ALL SELECT 'steep', round(avg(l_linenumber) + 1099511627776.0::DOUBLE, 8), round(stddev_samp(l_linenumber), 8) FROM lineitem
        UNION ALL SELECT 'label', round(avg(l_extendedprice), 8), round(stddev_pop(l_extendedprice), 8) FROM lineitem
    """,
    "feature_scaler_stats": " UNION ALL ".join(
        f"SELECT '{c}' AS feature, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std FROM lineitem"
        for c in FEATURES
    ),
    "features_standardized": f"""
        SELECT {_KEYS_SQL}, {", ".join(f"round(({c} - m_{c}) / s_{c}, 6) + 0.0 AS {c}" for c in FEATURES)},
               0.0::DOUBLE AS flat
        FROM lineitem CROSS JOIN (
            SELECT {", ".join(f"avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}" for c in FEATURES)} FROM lineitem
        ) AS stats
    """,
    "label_scaler": """
        SELECT round(avg(l_extendedprice), 6) AS mean,
               round(greatest(stddev_pop(l_extendedprice), 1e-6), 6) AS std FROM lineitem
    """,
    "label_scaled": f"""
        SELECT {_KEYS_SQL}, round((l_extendedprice - m) / s, 6) + 0.0 AS scaled
        FROM lineitem CROSS JOIN (
            SELECT avg(l_extendedprice) AS m, greatest(stddev_pop(l_extendedprice), 1e-6) AS s FROM lineitem
        ) AS stats
    """,
    "label_unscaled": f"SELECT {_KEYS_SQL}, round(l_extendedprice, 4) AS price FROM lineitem",
    "features_assembled": f"""
        SELECT {_KEYS_SQL}, l_quantity AS x0, l_tax AS x1, l_extendedprice AS x2
        FROM ({_GAPS}) AS g WHERE {_VALID}
    """,
    "split_counts": f"""
        SELECT CAST(year(l_shipdate) AS INT) AS period,
               CASE WHEN {bucket_sql(KEYS)} < 80 THEN 'train' ELSE 'test' END AS side,
               count(*) AS num_rows
        FROM lineitem GROUP BY 1, 2
    """,
    "split_keys": f"""
        SELECT o_orderkey, o_custkey FROM orders WHERE {bucket_sql(["o_orderkey"])} >= 80
    """,
}
